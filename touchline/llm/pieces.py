"""SentencePiece encoding by Viterbi over the matches of an Aho-Corasick automaton, and decoding.

The automaton holds all ordinary pieces. It reads a text once; at each place its output links list every piece that ends there,
and each of these may improve the best score of the place. No piece goes on from a letter to a word mark, so the best path of a text is
that of its words one after the other, and words that come again are looked up.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm.common import arrow_rows, in_tasks, slices, two_columns, worker_kept

MARK = "▁"
UNKNOWN_PENALTY = 10.0
SLICE_BYTES = 4 << 20
CACHE_BYTES = 112 << 20  # about, of each worker
LONGEST_KEPT = 64  # letters of a word that is kept; text without blanks is one long word that will hardly come again
_ENTRY_BYTES = 270
_WORDS = re.compile(f"(?<=[^{MARK}])(?={MARK})")
_RUN = f"{MARK}{MARK}"


class Pieces:
    """The pieces of a model file, their automaton, and how single letters without a piece are spelt in bytes."""

    def __init__(self, model_path: str, limit: int = CACHE_BYTES):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.normalize, size = model.normalize, model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.bytes_of = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        ordinary = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if any(MARK in p.lstrip(MARK) for p in map(self.pieces.__getitem__, ordinary)):
            raise ValueError("a piece goes on from a letter to a word mark; words cannot be encoded apart")
        scores = {i: model.get_score(i) for i in ordinary}
        self.unknown_id, self.unknown_score = model.unk_id(), min(scores.values()) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i in ordinary:
            self.automaton.add_word(self.pieces[i], (len(self.pieces[i]), i, scores[i]))
        self.automaton.make_automaton()
        self.letters = {self.pieces[i] for i in ordinary if len(self.pieces[i]) == 1}
        self.raw = [p.replace(MARK, " ").encode() for p in self.pieces]
        for value, i in self.bytes_of.items():
            self.raw[i] = bytes([value])
        self.silent = {i for i in range(size) if model.is_control(i)}
        self._limit, self._cache, self.held = limit, {}, 0

    def best_path(self, text: str) -> tuple[list[int], float]:
        """Ids and score of the best segmentation of a normalised text; of equal ones, that with the longest last piece, and so on
        towards the front. A letter that is no piece by itself may stand alone at the score of an unknown one."""
        n = len(text)
        best, start, piece = [0.0] + [-math.inf] * n, [0] * (n + 1), [-1] * (n + 1)
        strange = iter(()) if self.letters.issuperset(text) else iter([p for p, c in enumerate(text, 1) if c not in self.letters])
        alone = next(strange, None)
        for end, (size, i, score) in self.automaton.iter(text):  # by rising end, and of one end the longest piece first
            end += 1
            while alone is not None and alone < end:  # no more pieces end there, and those that end later may build on it
                if best[alone - 1] + self.unknown_score > best[alone]:
                    best[alone], start[alone], piece[alone] = best[alone - 1] + self.unknown_score, alone - 1, -1
                alone = next(strange, None)
            total = best[end - size] + score
            if total > best[end]:
                best[end], start[end], piece[end] = total, end - size, i
        while alone is not None:
            if best[alone - 1] + self.unknown_score > best[alone]:
                best[alone], start[alone], piece[alone] = best[alone - 1] + self.unknown_score, alone - 1, -1
            alone = next(strange, None)
        ids, at = [], n
        while at:
            if piece[at] >= 0:
                ids.append(piece[at])
            elif self.bytes_of:
                ids += [self.bytes_of[b] for b in reversed(text[start[at] : at].encode("utf-8", "replace"))]
            else:
                ids.append(self.unknown_id)
            at = start[at]
        return ids[::-1], best[n]

    def _word(self, word: str) -> tuple[bytes, float]:
        found = self._cache.get(word)
        if found is None:
            ids, score = self.best_path(word)
            found = array("I", ids).tobytes(), score
            if len(word) <= LONGEST_KEPT:
                self.held += _ENTRY_BYTES + 2 * len(word) + len(found[0])
                if self.held > self._limit:
                    self._cache.clear()
                    self.held = 0
                self._cache[word] = found
        return found

    def encode(self, text: str | None) -> tuple[bytes, float]:
        """Ids as little-endian unsigned 32-bit bytes, and the score of the path. Null counts as empty, which has no ids."""
        normal = self.normalize(text) if text else ""
        if _RUN in normal or not normal.startswith(MARK):
            words = _WORDS.split(normal) if normal else []
        else:
            words = [MARK + w for w in normal[1:].split(MARK)]
        found = [self._word(w) for w in words]
        return b"".join(f[0] for f in found), sum(f[1] for f in found)

    def decode(self, ids: bytes) -> str:
        """The text of ids; the blank put before the first word is taken off."""
        data = b"".join([self.raw[i] for i in memoryview(ids).cast("I") if i not in self.silent])
        text = data.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def worker_pieces(model_path: str) -> Pieces:
    kept = worker_kept()
    if model_path not in kept:
        kept[model_path] = Pieces(model_path)
    return kept[model_path]


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, ids, score (of the best path).

    A null or empty text has no ids and score 0. Null ids and repeated rows each get a row, an empty table gives none. Other columns
    are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_pieces(model_path)
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("score", pa.float64())])
        for part in (part for batch in batches for part in slices(batch, "text", SLICE_BYTES)):
            found = [model.encode(t) for t in part.column(1).to_pylist()]
            offsets = [0]
            for data, _ in found:
                offsets.append(offsets[-1] + len(data) // 4)
            values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(f[0] for f in found))])
            yield arrow_rows(schema, [part.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), [f[1] for f in found]])

    return in_tasks(two_columns(docs, id_col, text_col), run, "doc_id bigint, ids array<int>, score double")


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """Adds text to rows of encode_pieces, by decoding their ids. Null ids give null; an empty table gives no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_pieces(model_path)
        schema = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("score", pa.float64()), ("text", pa.string())])
        for batch in batches:
            ids = [None if x is None else array("I", x).tobytes() for x in (c.as_py() for c in batch.column(1))]
            texts = [None if x is None else model.decode(x) for x in ids]
            counts, crcs = ([None if x is None else f(x) for x in ids] for f in (lambda x: len(x) // 4, zlib.crc32))
            yield arrow_rows(schema, [batch.column(0), counts, crcs, batch.column(2), texts])

    return in_tasks(encoded, run, "doc_id bigint, n_pieces bigint, ids_crc32 bigint, score double, text string")


def encode_and_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What decode_pieces(encode_pieces(...)) gives, in one step, so that a task needs one worker and one model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_pieces(model_path)
        schema = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("score", pa.float64()), ("text", pa.string())])
        for part in (part for batch in batches for part in slices(batch, "text", SLICE_BYTES)):
            columns = [], [], [], []
            for text in part.column(1).to_pylist():
                ids, score = model.encode(text)
                for column, value in zip(columns, (len(ids) // 4, zlib.crc32(ids), score, model.decode(ids))):
                    column.append(value)
            yield arrow_rows(schema, [part.column(0), *columns])

    return in_tasks(two_columns(docs, id_col, text_col), run, "doc_id bigint, n_pieces bigint, ids_crc32 bigint, score double, text string")
