"""Fill-in-the-middle: a text is cut twice, its middle moves to the end, and marks say which part is which.

Cuts are counted in code points, texts are stored in UTF-8. The index between the two is sparse: only characters of more than one
byte are recorded, each by its place and the bytes it has beyond the first, and searchsorted finds how many of them lie before a
cut. Stretches of ASCII need no entry: there a place in code points and one in bytes differ by a constant.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import arrow_rows, in_tasks, slices, two_columns

SLICE_BYTES = 4 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class WideCharacters(NamedTuple):
    """Of the characters of several bytes in a run of UTF-8: the bytes they start at, and the excess bytes before and after each."""

    at: np.ndarray
    excess: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray) -> WideCharacters:
        at = np.flatnonzero(data >= 0xC0)
        lead = data[at]
        excess = np.zeros(len(at) + 1, np.int64)
        np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0), out=excess[1:])
        return cls(at, excess)

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        """The byte at which each code point starts."""
        return points + self.excess[np.searchsorted(self.at - self.excess[:-1], points)]

    def to_points(self, starts: np.ndarray) -> np.ndarray:
        """How many code points start before each byte."""
        return starts - self.excess[np.searchsorted(self.at, starts)]


def _utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each starts; a null text has none."""
    filled = texts.fill_null("").cast(pa.large_binary())
    starts = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def _strings(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(parts), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(parts))])


def fill_middle(
    docs: DataFrame, seed: int = 1, move_percent: int = 90, suffix_first_percent: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, n (code points), form, prefix_chars, middle_chars, prefix_bytes, middle_bytes, output.

    The first four 8-digit groups of the sha256 of "seed:id" are the document's random numbers: two cuts, whether it is rearranged,
    and which of both orders it takes. Form plain keeps the text and has null lengths: texts that are empty, that hold a mark, or
    that are not drawn. Form psm puts prefix, suffix, middle, form spm suffix, prefix, middle, each behind its mark.
    A null text counts as empty, a null id as no digits; repeated rows each get a row, an empty table gives none. Columns beside the
    id and the text are ignored. Tasks hold about 4 MB of texts at a time, or one longer text.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]
    marks, (p, s, m) = (PREFIX, SUFFIX, MIDDLE), (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string())]
        kinds += [(c, pa.int64()) for c in ("prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes")] + [("output", pa.string())]
        schema = pa.schema(kinds)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                data, starts = _utf8(part.column(1))
                wide = WideCharacters.of(data)
                first = wide.to_points(starts)
                n = np.maximum(np.diff(first), 0)
                h1, h2, h3, h4 = (part.column(c).to_numpy() for c in range(2, 6))
                plain = (n == 0) | (h3 % 100 >= move_percent)
                for mark in marks:
                    plain |= pa.compute.match_substring(part.column(1).fill_null(""), mark).to_numpy(zero_copy_only=False)
                a, b = h1 % (n + 1), h2 % (n + 1)
                low, high = np.minimum(a, b), np.maximum(a, b)
                cuts = [np.clip(wide.to_bytes(first[:-1] + c), starts[:-1], starts[1:]) for c in (low, high)]
                raw, outputs, suffix_first = data.tobytes(), [], h4 % 100 < suffix_first_percent
                for kept, turned, start, one, two, end in zip(*(x.tolist() for x in (plain, suffix_first, starts[:-1], *cuts, starts[1:]))):
                    if kept:
                        outputs.append(raw[start:end])
                    elif turned:
                        outputs.append(b"".join((s, raw[two:end], p, raw[start:one], m, raw[one:two])))
                    else:
                        outputs.append(b"".join((p, raw[start:one], s, raw[two:end], m, raw[one:two])))
                form = np.where(plain, "plain", np.where(suffix_first, "spm", "psm"))
                lengths = [low, high - low, cuts[0] - starts[:-1], cuts[1] - cuts[0]]
                yield arrow_rows(schema, [part.column(0), n, form, *(pa.array(x, pa.int64(), mask=plain) for x in lengths), _strings(outputs)])

    schema = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, prefix_bytes bigint, middle_bytes bigint, output string"
    return in_tasks(two_columns(docs, id_col, text_col).select("doc_id", "text", *draws), run, schema)


def restored(form: Column, output: Column) -> Column:
    """The text before fill_middle, from its form and output alone; null where one of them is null.

    The parts hold no mark, and no mark can arise where a part meets one, so the marks split the output into exactly the parts.
    """
    parts = F.split(output, "|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE))), -1)
    in_order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    found = F.when(form == "plain", output)
    for name, places in in_order.items():
        found = found.when(form == name, F.concat(*(F.get(parts, F.lit(i)) for i in places)))
    return found
