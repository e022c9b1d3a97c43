"""How many rows repeat an earlier one, exactly, while rows that are not repeated hardly travel.

Every row has a 64-bit hash, cut down to about ten bits more than it takes to number the rows. Tasks sort their hashes and send the
gaps between them, packed into as few bits as they need: less than two bytes a row. Merged by ranges they show which hashes come twice.
Only rows with such a hash, which are the repeated ones and about one in a thousand others, are compared by a digest of all values.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.numeric import row_count
from touchline.functions.text import ref

SMALL_BYTES = 512 << 20  # of input; up to that the digests of all rows are shuffled
ROW_BYTES = 8  # of input a row takes at least, about; only the number of hash bits follows from it
RUN_ROWS = 1 << 20  # hashes that a task sorts at a time
RANGE_ROWS = 1 << 22  # hashes of a range, about
BROADCAST_HASHES = 500_000
PLAIN = (T.StringType, T.BooleanType, T.IntegralType, T.DateType, T.DecimalType, T.NullType)


def row_digest(df: DataFrame) -> Column | None:
    """A digest that only equal rows share; None if some column's text would not tell its values apart."""
    parts = []
    for f in df.schema.fields:
        if not isinstance(f.dataType, PLAIN):
            return None
        text = ref(f.name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256)) if parts else None


def repeats(df: DataFrame) -> DataFrame:
    """One row: duplicate_rows, by grouping all rows. NULLs are equal; copies collapse map-side.

    Rows of plain columns are shuffled as a SHA-256 digest of their values, each marked as missing or led by its length.
    """
    key = row_digest(df)
    groups = df.groupBy(*([ref(c) for c in df.columns] if key is None else [key.alias("digest")])).agg(row_count().alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def pack_gaps(values: np.ndarray) -> bytes:
    """Sorted different whole numbers as first value, bit width and the gaps' low bits, bit by bit; what gaps have beyond stands apart.

    The width is the one that makes the whole shortest.
    """
    gaps = np.diff(values)
    if not len(gaps):
        return np.array([*values[:1], 0, 0], "<u8").tobytes()
    bits = np.bincount(np.ceil(np.log2(gaps.astype(np.float64) + 1)).astype(int), minlength=65)
    wider = len(gaps) - np.cumsum(bits)
    width = int(np.argmin(np.arange(len(bits)) * len(gaps) + 128 * wider))
    wide = np.flatnonzero(gaps >= 1 << width)
    planes = [np.packbits(((gaps >> bit) & 1).astype(np.uint8)).tobytes() for bit in range(width)]
    head = np.array([values[0], width | len(gaps) << 8, len(wide)], "<u8")
    return head.tobytes() + wide.astype("<u8").tobytes() + (gaps[wide] >> width).astype("<u8").tobytes() + b"".join(planes)


def unpack_gaps(data: bytes) -> np.ndarray:
    first, shape, n_wide = (int(x) for x in np.frombuffer(data, "<u8", 3))
    width, n = shape & 255, shape >> 8
    if not n:
        return np.array([first], np.int64)
    wide, high = (np.frombuffer(data, "<u8", n_wide, 24 + 8 * n_wide * i).astype(np.int64) for i in (0, 1))
    gaps, at, size = np.zeros(n, np.int64), 24 + 16 * n_wide, -(-n // 8)
    for bit in range(width):
        gaps |= np.unpackbits(np.frombuffer(data, np.uint8, size, at + bit * size), count=n).astype(np.int64) << bit
    gaps[wide] |= high << width
    return first + np.r_[0, np.cumsum(gaps)]


def _runs(range_bits: int):
    """(part, packed): the hashes of a task in runs, by range. Those that a run holds twice are sent a second time."""
    schema = pa.schema([("part", pa.int64()), ("packed", pa.binary())])

    def sent(values: np.ndarray) -> pa.RecordBatch:
        part = values >> range_bits
        edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(values)]
        packed = [pack_gaps(values[a:b]) for a, b in zip(edges, edges[1:])]
        return pa.RecordBatch.from_arrays([pa.array(part[edges[:-1]]), pa.array(packed, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            yield sent(values)
            if (counts > 1).any():
                yield sent(values[counts > 1])

        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy())
                n += batch.num_rows
            if n >= RUN_ROWS:
                yield from flush()
                held, n = [], 0
        if held:
            yield from flush()

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes that come more than once in a range; the runs of a range stand together."""
    last, held = None, []

    def twice() -> pa.RecordBatch:
        values = np.sort(np.concatenate([unpack_gaps(p) for p in held]))
        return pa.RecordBatch.from_arrays([pa.array(np.unique(values[1:][values[1:] == values[:-1]]))], names=["hash"])

    for batch in batches:
        for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if part != last and held:
                yield twice()
                held = []
            last = part
            held.append(packed)
    if held:
        yield twice()


def repeated_hashes(df: DataFrame, rows: int) -> tuple[Column, DataFrame]:
    """The hash of a row, and those hashes (hash) that several rows have, for a frame of about so many rows."""
    bits = min(62, max(16, rows.bit_length() + 10))
    value = F.shiftrightunsigned(F.xxhash64(*[ref(c) for c in df.columns]), 64 - bits)
    range_bits = max(0, bits - (rows // RANGE_ROWS).bit_length())
    runs = df.select(value.alias("hash")).mapInArrow(_runs(range_bits), "part bigint, packed binary")
    together = runs.repartition("part").sortWithinPartitions("part")
    return value, together.mapInArrow(_repeated, "hash bigint")


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files and tables under a frame as Spark knows them without reading."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: duplicate_rows, how many rows repeat an earlier one. NULLs are equal.

    Over small inputs, and for columns other than plain ones, this is one lazy group-by. Over larger ones the repeated hashes are found
    at once, by a job of its own. If they are few, which a count shows, they are broadcast and only rows that have one are grouped;
    else all rows are, whose copies collapse before the shuffle.
    """
    size = input_bytes(df)
    if size <= SMALL_BYTES or not df.columns or not all(isinstance(f.dataType, PLAIN) for f in df.schema.fields):
        return repeats(df)
    value, found = repeated_hashes(df, size // ROW_BYTES)
    few = [r[0] for r in found.limit(BROADCAST_HASHES + 1).toLocalIterator()]
    if len(few) > BROADCAST_HASHES:
        return repeats(df)
    if not few:
        return df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("duplicate_rows"))
    name = f"hash_{uuid.uuid4().hex}"  # no column of the frame
    chosen = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in few], f"{name} bigint"))
    return repeats(df.join(chosen, value == F.col(name), "left_semi"))
