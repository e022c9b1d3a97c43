"""Token ids of documents as files of patched frame-of-reference blocks.

Layout of one segment, all little-endian unsigned 32-bit words:

    magic, block length, number of ids, number of blocks
    per block: minimum | width in bits | number of exceptions | first word of the block (the index of block starts)
    per block: 4 words per bit of width with the packed low bits | positions of exceptions, 4 to a word | their high parts

An id is its block's minimum plus the packed low bits plus, for an exception, the high part shifted by the width. The width is that
of the percentile of the block's reduced values, so the few large ones do not widen all. The last block is filled with its minimum.

Segments are rows of a Parquet table (payload next to the ids and lengths of its documents), so any store that Spark writes to
can hold them and a retried or duplicated task never leaves half a file. Documents stand in rising id order, part by part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import in_tasks, quantile_bounds, range_bucket, text_parts, two_columns
from touchline.llm.tokens import drop_spaces, worker_tokenizer

MAGIC = 0x31524650
LANES, PER_LANE = 4, 32
BLOCK = LANES * PER_LANE
SEGMENT_SCHEMA = "part int, segment int, first_id bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, payload binary"


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 128 values below 2**width to rows of 4 * width words; each of 4 lanes holds 32 values."""
    lanes = values.reshape(-1, PER_LANE, LANES).astype(np.uint64)
    out = np.zeros((len(values), width + 1, LANES), np.uint64)
    for i in range(PER_LANE):
        word, shift = divmod(i * width, 32)
        wide = lanes[:, i] << np.uint64(shift)
        out[:, word] |= wide & np.uint64(0xFFFFFFFF)
        out[:, word + 1] |= wide >> np.uint64(32)
    return out[:, :width].astype("<u4").reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = np.zeros((len(words), width + 1, LANES), np.uint64)
    lanes[:, :width] = words.reshape(-1, width, LANES)
    out = np.empty((len(words), PER_LANE, LANES), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(PER_LANE):
        word, shift = divmod(i * width, 32)
        both = lanes[:, word] | (lanes[:, word + 1] << np.uint64(32))
        out[:, i] = (both >> np.uint64(shift)) & mask
    return out.reshape(len(words), BLOCK)


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.where(values > 0, np.floor(np.log2(np.maximum(values, 1).astype(np.float64))) + 1, 0).astype(np.uint32)


def encode_segment(ids: np.ndarray, percentile: float = 0.9) -> bytes:
    """Unsigned 32-bit ids to one segment; an empty list gives a segment without blocks."""
    ids = np.ascontiguousarray(ids, "<u4")
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    if not n:
        return np.array([MAGIC, BLOCK, 0, 0], "<u4").tobytes()
    values = np.full(blocks * BLOCK, ids[(blocks - 1) * BLOCK :].min(), np.uint32)
    values[:n] = ids
    values = values.reshape(blocks, BLOCK)
    low = values.min(axis=1)
    values = values - low[:, None]
    rank = min(BLOCK - 1, max(0, int(np.ceil(percentile * BLOCK)) - 1))
    width = _bit_length(np.partition(values, rank, axis=1)[:, rank])
    high = (values.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    row, place = np.nonzero(high)
    patched = np.bincount(row, minlength=blocks).astype(np.uint32)
    words = LANES * width + (patched + 3) // 4 + patched
    start = (np.cumsum(words) - words).astype(np.uint32)
    data = np.zeros(int(words.sum()), "<u4")
    for w in np.unique(width[width > 0]).tolist():
        chosen = np.flatnonzero(width == w)
        at = start[chosen].astype(np.int64)[:, None] + np.arange(LANES * w)
        data[at] = _pack(values[chosen] & np.uint32((1 << w) - 1), w)
    first, rank = _exceptions(start, width, patched, row)
    data.view(np.uint8)[first * 4 + rank] = place
    data[first + (patched[row].astype(np.int64) + 3) // 4 + rank] = high[row, place]
    head = np.array([MAGIC, BLOCK, n, blocks], "<u4")
    return b"".join(x.astype("<u4").tobytes() for x in (head, low, width, patched, start)) + data.tobytes()


def _exceptions(start, width, patched, row) -> tuple[np.ndarray, np.ndarray]:
    """For each exception, listed by block: the first word of its block's list and its place in that list."""
    before = np.cumsum(patched.astype(np.int64)) - patched
    return start[row].astype(np.int64) + LANES * width[row], np.arange(len(row)) - before[row]


def decode_segment(payload: bytes, first: int = 0, count: int | None = None) -> np.ndarray:
    """The ids of a segment, or count of them from place first on; only the blocks that hold these are read."""
    words = np.frombuffer(payload, "<u4")
    if len(words) < 4 or words[0] != MAGIC or words[1] != BLOCK:
        raise ValueError("not a segment of patched frame-of-reference blocks")
    n, blocks = int(words[2]), int(words[3])
    last = n if count is None else min(n, first + count)
    if last <= first:
        return np.empty(0, np.uint32)
    a, b = first // BLOCK, -(-last // BLOCK)
    low, width, patched, start = (words[4 + i * blocks + a : 4 + i * blocks + b] for i in range(4))
    data = words[4 + 4 * blocks :]
    out = np.zeros((b - a, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        chosen = np.flatnonzero(width == w)
        out[chosen] = _unpack(data[start[chosen].astype(np.int64)[:, None] + np.arange(LANES * w)], w)
    row = np.repeat(np.arange(b - a), patched)
    at, rank = _exceptions(start, width, patched, row)
    place = data.view(np.uint8)[at * 4 + rank]
    high = data[at + (patched[row].astype(np.int64) + 3) // 4 + rank].astype(np.uint64)
    out[row, place] |= (high << width[row].astype(np.uint64)).astype(np.uint32)
    return (out + low[:, None]).reshape(-1)[first - a * BLOCK : last - a * BLOCK]


def _writer(tokenizer_path: str, end_id: int, percentile: float, segment_ids: int):
    def segment(part, number, first, doc_ids, pieces):
        lengths = [len(p) // 4 for p in pieces]
        payload = encode_segment(np.frombuffer(b"".join(pieces), "<u4"), percentile)
        return {"part": part, "segment": number, "first_id": first, "n_ids": sum(lengths), "doc_ids": doc_ids, "lengths": lengths, "payload": payload}

    schema = pa.schema(
        [("part", pa.int32()), ("segment", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
         ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = worker_tokenizer(tokenizer_path, drop_spaces), np.array([end_id], "<u4").tobytes()
        part, number, first, held, doc_ids, pieces = None, 0, 0, 0, [], []
        for batch in batches:
            for p, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text"))):
                if pieces and (p != part or held >= segment_ids):
                    yield pa.RecordBatch.from_pylist([segment(part, number, first, doc_ids, pieces)], schema)
                    number, first, held, doc_ids, pieces = number + 1, first + held, 0, [], []
                if p != part:
                    part, number, first = p, 0, 0
                ids = tokenizer.ids(text) + end
                doc_ids.append(doc_id)
                pieces.append(ids)
                held += len(ids) // 4
        if pieces:
            yield pa.RecordBatch.from_pylist([segment(part, number, first, doc_ids, pieces)], schema)

    return run


def write_token_blocks(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    percentile: float = 0.9,
    segment_ids: int = 1 << 19,
) -> None:
    """Encode whole texts, add end_id to each, and write segments at path, documents in rising id order.

    A null text counts as empty and gives the end id alone; null ids stand first; rows with equal ids stand in the order of their
    texts and each is written. Other columns are ignored. An empty table gives an empty path. The texts are shuffled once,
    by ranges of the id that hold about equally many rows; a part is one range.
    """
    rows = two_columns(docs, id_col, text_col)
    bounds = quantile_bounds(rows, "doc_id", text_parts(rows))
    dealt = (
        rows.withColumn("part", range_bucket(F.col("doc_id"), bounds))
        .repartitionById(len(bounds) + 1, F.col("part"))
        .sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    )
    in_tasks(dealt, _writer(tokenizer_path, end_id, percentile, segment_ids), SEGMENT_SCHEMA).write.parquet(path)


def read_token_blocks(spark, path: str) -> DataFrame:
    """Per document of a written path, read back from the blocks: doc_id, start (ids of all documents before it), n_tokens (with
    the end id), ids_crc32 (of the ids as little-endian unsigned 32-bit integers) and the segment it stands in.

    The driver adds up one number per part, never one per document.
    """
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    offsets, total = {}, 0
    for row in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        offsets[row["part"]], total = total, total + row["n"]

    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("segment", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in ("part", "segment", "first_id", "doc_ids", "lengths", "payload")}
                data = memoryview(decode_segment(row["payload"].as_buffer()).tobytes())
                lengths = np.array(row["lengths"].as_py(), np.int64)
                ends = np.cumsum(lengths)
                part = row["part"].as_py()
                start = ends - lengths + row["first_id"].as_py() + offsets[part]
                crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                size = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(start), pa.array(lengths), pa.array(crc, pa.int64()),
                     pa.array([part] * size, pa.int32()), pa.array([row["segment"].as_py()] * size, pa.int32())],
                    schema=schema,
                )

    return in_tasks(segments, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, part int, segment int")
