"""Order MinHash fingerprints of whole texts, sensitive to edits and to moved passages.

The k-mers of a text's code points are numbered by occurrence, so a repeated k-mer counts as often as it stands there. A hash of
(k-mer, occurrence) deals them into bins, one per component; from each bin the few k-mers with the smallest hashes are
taken, put back into the order in which they stand in the text, and hashed as a tuple. Dealing into bins takes one hash per k-mer in
place of one per k-mer and component. Two texts agree in a component if the same minimal k-mers stand there in the same order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import in_tasks, mix64, quantile_bounds, range_bucket, text_parts, two_columns

K, TUPLE, BINS = 8, 2, 64
EMPTY = 0
_ODD = 0x9E3779B97F4A7C15


def _kmer_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """A hash per k-mer from sums over lengths 1, 2, 4 ... of it; a text shorter than k is one k-mer."""
    k = min(k, len(points))
    with np.errstate(over="ignore"):
        runs, span, total, at, base = points.astype(np.uint64) + np.uint64(1), 1, None, 0, np.uint64(_ODD)
        n = len(points) - k + 1
        while True:
            if k & span:
                part = runs[at : at + n]
                total = part.copy() if total is None else total * base + part
                at += span
            if 2 * span > k:
                return mix64(total)
            runs = runs[:-span] * base + runs[span:]
            base, span = base * base, 2 * span


def _occurrences(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that bring equal hashes together in the order of the text, and for each how often its hash stands before it."""
    n, place = len(hashes), None
    if n < 1 << 24:
        # The leading bits say which k-mer it is, the trailing ones where it stands, so one fast sort does, unless different
        # hashes agree in the leading bits.
        low = np.uint64((1 << 24) - 1)
        order = np.sort((hashes & ~low) | np.arange(n, dtype=np.uint64))
        place = (order & low).astype(np.int64)
        name = hashes[place]
        new = np.r_[True, name[1:] != name[:-1]]
        if (new[1:] & (order[1:] >> np.uint64(24) == order[:-1] >> np.uint64(24))).any():
            place = None
    if place is None:
        place = np.argsort(hashes, kind="stable")
        name = hashes[place]
        new = np.r_[True, name[1:] != name[:-1]]
    first = np.flatnonzero(new)
    return place, np.arange(n) - first[np.cumsum(new) - 1] if len(first) < n else np.zeros(n, np.int64)


def fingerprint(text: str, k: int = K, size: int = TUPLE, bins: int = BINS) -> np.ndarray:
    """One 32-bit component per bin, 0 for a bin without k-mers. bins must be a power of two."""
    out = np.zeros(bins, np.uint32)
    if not text:
        return out
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    with np.errstate(over="ignore"):
        hashes = _kmer_hashes(points, k)
        n = len(hashes)
        place, occurrence = _occurrences(hashes)
        numbered = mix64(hashes[place] + occurrence.astype(np.uint64) * np.uint64(_ODD))
        shift = np.uint64(64 - bins.bit_length() + 1)
        # Only small hashes can be among the smallest of a bin; all are looked at if some bin has too few of them.
        chosen = np.arange(n)
        if n > 24 * bins:
            chosen = np.flatnonzero((numbered << np.uint64(64) - shift) < np.uint64(int(2**64 * 16 * bins / n)))
            if np.bincount((numbered[chosen] >> shift).astype(np.int64), minlength=bins).min() < size:
                chosen = np.arange(n)
        rank = np.lexsort((place[chosen], numbered[chosen]))
        chosen = chosen[rank]
        bin_of = (numbered[chosen] >> shift).astype(np.int64)
        start = np.searchsorted(bin_of, np.arange(bins + 1))
        held = np.minimum(np.diff(start), size)
        at = start[:-1, None] + np.arange(size)
        there = np.arange(size) < held[:, None]
        places = np.where(there, place[chosen[np.minimum(at, len(chosen) - 1)]], n)
        places.sort(axis=1)
        total = np.full(bins, np.uint64(_ODD))
        for i in range(size):
            here = places[:, i] < n
            total = np.where(here, mix64(total * np.uint64(31) + hashes[np.minimum(places[:, i], n - 1)]), total)
        total >>= np.uint64(32)
        return np.where(held > 0, np.maximum(total, np.uint64(1)), np.uint64(EMPTY)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components among those that either text fills; 1 for two empty texts."""
    filled = (a != EMPTY) | (b != EMPTY)
    return float(((a == b) & filled).sum() / filled.sum()) if filled.any() else 1.0


def as_hex(components: np.ndarray) -> str:
    return components.astype(">u4").tobytes().hex()


def edited(text: str, follower: str) -> str:
    """The last half of the text (rounded down) replaced by as many first code points of the follower, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


def with_followers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Each text once per part of the id order that needs it: (part, halo, doc_id, text), halo 1 for the first text of the part
    that follows. The texts are shuffled once; per part one more text travels, and the driver holds one id per part."""
    rows = two_columns(docs, id_col, text_col)
    bounds = quantile_bounds(rows, "doc_id", parts or text_parts(rows))
    rows = rows.withColumn("part", F.lit(len(bounds)) - range_bucket(F.col("doc_id"), bounds))
    heads = sorted((r["part"], r["head"]) for r in rows.groupBy("part").agg(F.max("doc_id").alias("head")).collect())
    if not heads:
        return rows.select("part", F.lit(0).alias("halo"), "doc_id", "text")
    parted = [(heads[i - 1][0], head) for i, (_, head) in enumerate(heads)]
    needed_by = docs.sparkSession.createDataFrame(parted, "to_part int, head bigint")
    both = rows.join(F.broadcast(needed_by), F.col("doc_id").eqNullSafe(F.col("head")), "left")
    copies = F.array(F.struct("part", F.lit(0).alias("halo")), F.struct(F.col("to_part").alias("part"), F.lit(1).alias("halo")))
    one = F.array(F.struct("part", F.lit(0).alias("halo")))
    dealt = both.select("doc_id", "text", F.explode(F.when(F.col("to_part").isNull(), one).otherwise(copies)).alias("to"))
    return (
        dealt.select("to.part", "to.halo", "doc_id", "text")
        .repartitionById(len(bounds) + 1, F.col("part"))
        .sortWithinPartitions("part", "halo", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    )


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, size: int = TUPLE, bins: int = BINS, parts: int | None = None) -> DataFrame:
    """Per document: doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one that follows in falling order of ids (the first after the last; a lone document follows itself); null
    ids stand last, rows with equal ids in the order of their texts. A null text counts as empty; an empty text has an empty
    fingerprint (all components 0), which is like another empty one (1) and unlike all others (0). Other columns are ignored.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, part, closed = None, None, False
        for batch in batches:
            out = []
            for p, halo, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if p != part:
                    before, part, closed = None, p, False
                if closed:  # more rows with the head's id; the first in order is the one that follows
                    continue
                text, doc_id = text.as_py() or "", doc_id.as_py()
                own = fingerprint(text, k, size, bins)
                if before is not None:
                    new = edited(before[1], text)
                    changed = fingerprint(new, k, size, bins)
                    sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append(
                        (before[0], len(before[1]), sha, as_hex(before[2]), as_hex(changed), likeness(before[2], changed), likeness(before[2], own))
                    )
                before, closed = (doc_id, text, own), halo == 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return in_tasks(
        with_followers(docs, id_col, text_col, parts), run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
