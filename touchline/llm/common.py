"""Helpers shared by the operators: table access, stored intermediate results, ordered dealing and safe broadcasts."""

from __future__ import annotations

import ctypes
import math
import sys
import uuid
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import scratch_path

BUCKET_BYTES = 24 << 20
MOST_PARTS = 20_000  # beyond that parts grow; their tasks sort and stream
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a result to the shared folder of spark.checkpoint.dir and go on from the files, which lost executors cannot take."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names; whatever else the table has cannot clash after this."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def bounded(small: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The table marked for broadcast if a count shows that it is small, else as it is, for a shuffled join.

    The table should be stored or cheap, as it is counted first.
    """
    return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small


def quantile_bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most parts - 1 rising cut values that split the table into about equal ranges of an integer key."""
    if parts < 2:
        return []
    cuts = df.approxQuantile(key, [i / parts for i in range(1, parts)], 1 / (8 * parts))
    return sorted({int(c) for c in cuts})


def range_bucket(key: Column, bounds: list[int]) -> Column:
    """Number of the range that holds the key: 0 up to the first cut, and so on; a null key counts as the smallest.

    The cuts are searched in two levels, so a row looks at about twice the square root of their number.
    """
    if not bounds:
        return F.lit(0)
    run = math.isqrt(len(bounds) - 1) + 1
    ends, cuts = (F.from_json(F.lit(str(c)), "array<bigint>") for c in (bounds[run - 1 :: run], bounds))
    passed = run * F.size(F.filter(ends, lambda c: c < key))
    within = F.transform(F.array(passed), lambda p: p + F.size(F.filter(F.slice(cuts, p + 1, run), lambda c: c < key)))
    return F.when(key.isNull(), 0).otherwise(within[0])


def text_parts(df: DataFrame, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many parts of about bucket_bytes the whole texts fill."""
    total = df.agg(F.sum(F.octet_length(text_col).cast("bigint") + 16)).first()[0] or 0
    return min(MOST_PARTS, max(1, -(-total // bucket_bytes)))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """A batch cut into runs of rows whose texts have about max_bytes together; a longer text is alone."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, used = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if used and used + size > max_bytes:
            yield batch.slice(start, i - start)
            start, used = i, 0
        used += size
    if batch.num_rows > start:
        yield batch.slice(start)


def worker_kept() -> dict:
    """What this Python worker keeps for later tasks of the function that it runs: models and caches."""
    module = sys.modules.setdefault("_kept_by_tasks", ModuleType("_kept_by_tasks"))
    return module.__dict__.setdefault("kept", {})


def give_back() -> None:
    """Freed memory goes back to the system, as the worker may idle next to others or run something else next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def in_tasks(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow. Workers live longer than jobs: what another function kept in this one is dropped before the task begins, and
    memory that the task has freed is given back when it ends."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_kept()
        if kept.get("function") != name:
            kept.clear()
            kept["function"] = name
            give_back()
        try:
            yield from function(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def arrow_rows(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (multiply and shift), so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
