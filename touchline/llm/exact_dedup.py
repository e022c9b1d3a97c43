"""Exact duplicates by counting quotient filters.

A document's fingerprint is a 64-bit hash of its normalised text. Each task builds filters of the fingerprints it sees: the leading
bits are the quotient, which is not stored but marked in a bit map, the trailing bits are the remainder, which stands in a slot in the
run of its quotient, with a count. Filters of all tasks merge without loss, as their runs are sorted. Fingerprints whose merged count
is above one send their documents to a comparison of the texts themselves; all others are unique and never move.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import bounded, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILTER_ROWS = 1 << 18
HOT_SHARE = 1000  # a key is hot if more than one in so many rows hold it, so there are fewer hot keys than that


def normalised(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


@dataclass
class QuotientFilter:
    """Sorted slots of remainders: occupied marks the quotients that have a run, run_end the last slot of each run."""

    quotient_bits: int
    remainder_bits: int
    occupied: np.ndarray
    run_end: np.ndarray
    remainder: np.ndarray
    count: np.ndarray

    @classmethod
    def build(cls, values: np.ndarray, counts: np.ndarray | None = None, bits: int = 64) -> QuotientFilter:
        """From fingerprints of so many bits, in any order and with repeats; counts says how often each occurs (else once)."""
        values = np.asarray(values, np.uint64)
        order = np.argsort(values, kind="stable")
        values = values[order]
        counts = np.ones(len(values), np.int64) if counts is None else np.asarray(counts, np.int64)[order]
        first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)
        counts = np.add.reduceat(counts, first) if len(first) else counts
        values = values[first]
        quotient_bits = max(1, int(len(values)).bit_length())
        shift = np.uint64(bits - quotient_bits)
        quotient = (values >> shift).astype(np.int64)
        occupied = np.zeros(1 << quotient_bits, bool)
        occupied[quotient] = True
        run_end = np.r_[quotient[1:] != quotient[:-1], True] if len(values) else np.empty(0, bool)
        remainder = values & ((np.uint64(1) << shift) - np.uint64(1))
        return cls(quotient_bits, int(shift), occupied, run_end, remainder, counts)

    def fingerprints(self) -> np.ndarray:
        """All of them, sorted, put together again from marks and remainders."""
        run = np.cumsum(np.r_[0, self.run_end[:-1]]) if len(self.run_end) else np.empty(0, np.int64)
        quotient = np.flatnonzero(self.occupied)[run] if len(run) else np.empty(0, np.int64)
        return (quotient.astype(np.uint64) << np.uint64(self.remainder_bits)) | self.remainder

    def merge(self, *others: QuotientFilter) -> QuotientFilter:
        every = [self, *others]
        bits = self.quotient_bits + self.remainder_bits
        return QuotientFilter.build(np.concatenate([f.fingerprints() for f in every]), np.concatenate([f.count for f in every]), bits)

    def to_bytes(self) -> bytes:
        """Bit maps, remainders in whole bytes, counts above one as (slot, count)."""
        width = -(-self.remainder_bits // 8)
        more = np.flatnonzero(self.count > 1)
        head = np.array([self.quotient_bits, self.remainder_bits, len(self.remainder), len(more)], "<i8")
        slots = self.remainder.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        parts = (head, np.packbits(self.occupied), np.packbits(self.run_end), slots, more.astype("<i8"), self.count[more].astype("<i8"))
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        q, r, n, more = np.frombuffer(data, "<i8", 4).tolist()
        width, at = -(-r // 8), 32

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        occupied = np.unpackbits(take(-(-(1 << q) // 8), "u1"), count=1 << q).astype(bool)
        run_end = np.unpackbits(take(-(-n // 8), "u1"), count=n).astype(bool)
        slots = np.zeros((n, 8), np.uint8)
        slots[:, :width] = take(n * width, "u1").reshape(n, width)
        counts = np.ones(n, np.int64)
        places = take(more, "<i8")
        counts[places] = take(more, "<i8")
        return cls(q, r, occupied, run_end, slots.view("<u8").reshape(-1), counts)


def repeated_fingerprints(rows: DataFrame, column: str = "fp") -> DataFrame:
    """(fp, copies) for each 64-bit fingerprint that occurs more than once. Null fingerprints are skipped.

    A task sends one filter per block of leading bits and some hundred thousand rows, so a fingerprint that a third of all rows share
    travels as one slot per filter. Blocks are small whatever the input, as their number grows with it.
    """
    total = rows.count()
    block_bits = max(0, min(40, (total // FILTER_ROWS).bit_length()))

    def filters(values: np.ndarray):
        for block, some in _by_block(values, block_bits):
            yield {"block": block, "filter": QuotientFilter.build(some, bits=64 - block_bits).to_bytes()}

    def build(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            n += len(held[-1])
            if n >= 4 * FILTER_ROWS:
                yield pa.RecordBatch.from_pylist(list(filters(np.concatenate(held))), schema)
                held, n = [], 0
        if n:
            yield pa.RecordBatch.from_pylist(list(filters(np.concatenate(held))), schema)

    def merge(group: pa.Table) -> pa.Table:
        every = [QuotientFilter.from_bytes(f) for f in group.column("filter").to_pylist()]
        merged = every[0].merge(*every[1:])
        many = merged.count > 1
        block = np.uint64(group.column("block")[0].as_py())
        high = block << np.uint64(64 - block_bits) if block_bits else np.uint64(0)
        fps = (merged.fingerprints()[many] | high).view(np.int64)
        return pa.table({"fp": pa.array(fps, pa.int64()), "copies": pa.array(merged.count[many], pa.int64())})

    schema = pa.schema([("block", pa.int64()), ("filter", pa.binary())])
    built = rows.select(column).mapInArrow(build, "block bigint, filter binary")
    return built.groupBy("block").applyInArrow(merge, "fp bigint, copies bigint")


def _by_block(values: np.ndarray, block_bits: int):
    if not block_bits:
        if len(values):
            yield 0, values
        return
    values = np.sort(values)
    block = (values >> np.uint64(64 - block_bits)).astype(np.int64)
    edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(values) else [0]
    low = np.uint64((1 << (64 - block_bits)) - 1)
    for a, b in zip(edges, edges[1:]):
        yield int(block[a]), values[a:b] & low


def join_hot(many: DataFrame, few: DataFrame, keys: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """many joined with few, whose keys are unique and whose column `size` says how many of the `total` rows of many hold each.

    A small table is broadcast. Else both are shuffled, and the rows of a hot key are dealt, by their place in the scan, to as many tasks
    as its share of the rows asks for, each with a copy of its one row. Hot keys are fewer than HOT_SHARE whatever the input, so
    broadcasting which they are is safe.
    """
    small = bounded(few)
    if small is not few:
        return many.join(small, keys, how)
    tag = uuid.uuid4().hex
    tasks, salt = f"tasks_{tag}", f"salt_{tag}"
    parts = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col(size) * HOT_SHARE > total
    counted = few.withColumn(tasks, F.when(is_hot, F.ceil(F.col(size) * parts / total)).otherwise(1))
    hot = F.broadcast(counted.filter(is_hot).select(*keys, tasks))
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce(tasks, F.lit(1)))
    salted = many.join(hot, keys, "left").withColumn(salt, dealt).drop(tasks)
    copies = counted.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(tasks) - 1))).drop(tasks)
    return salted.join(copies, [*keys, salt], how).drop(salt)


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    norm = normalised(F.col(text_col))
    return docs.withColumns({"_norm": norm, "_fp": F.xxhash64(norm), "_sha": F.unhex(F.sha2(norm, 256))})


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows has (doc_id, fp, sha, row_key) for each document; classes has (fp, sha, keep, group_size) for each text
    that occurs more than once, keep being the (doc_id, row_key) of the row that stays. Both are stored.

    Candidates come from the filters; their texts are then grouped byte by byte. The digest only names the groups: if one
    digest ever stood for two different texts the job would fail rather than merge them.
    """
    keyed = _keyed(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("_text")), "_text")
    rows = stored(
        keyed.select("doc_id", F.col("_fp").alias("fp"), F.col("_sha").alias("sha"), F.monotonically_increasing_id().alias("row_key")), "fingerprints"
    )
    total = rows.count()
    repeated = stored(repeated_fingerprints(rows), "repeated")
    texts = keyed.select(F.col("_fp").alias("fp"), F.col("_sha").alias("sha"), F.col("_norm").alias("norm"))
    verified = (
        join_hot(texts, repeated, ["fp"], "copies", total)
        .groupBy("fp", "sha", "norm").agg(F.count("*").alias("n"))
        .groupBy("fp", "sha").agg(F.count("*").alias("variants"), F.sum("n").alias("group_size"))
    )
    kept = join_hot(rows, repeated, ["fp"], "copies", total).groupBy("fp", "sha").agg(F.max(F.struct("doc_id", "row_key")).alias("keep"))
    one_text = F.when(F.col("variants") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest")))
    classes = verified.join(kept, ["fp", "sha"]).select("fp", "sha", "keep", one_text.alias("group_size"))
    return rows, stored(classes.filter("group_size > 1"), "classes")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Texts are equal if they are the same bytes once A-Z is lower-cased; null and empty are equal. Of equal texts the largest doc_id
    stays; null ids lose against others; of rows that repeat an id and a text, one stays. Other columns are ignored.
    An empty table gives no row.
    """
    rows, classes = duplicate_classes(docs, id_col, text_col)
    joined = join_hot(rows, classes, ["fp", "sha"], "group_size", rows.count(), "left")
    return joined.select(
        "doc_id",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (F.col("keep").isNull() | (F.col("keep.row_key") == F.col("row_key"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; an empty table stays empty.

    Of rows that repeat id and text the one whose columns hash lowest stays, equal hashes being equal rows but for a collision. Texts do
    not move unless they belong to a repeated id and text, or the repeated texts are too many for a broadcast.
    """
    rows, classes = duplicate_classes(docs, id_col, text_col)
    norm = normalised(F.col(text_col))
    names = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).cast("bigint").alias("id"), F.xxhash64(norm).alias("fp"), F.unhex(F.sha2(norm, 256)).alias("sha"))
    joined = join_hot(keyed, classes, ["fp", "sha"], "group_size", rows.count(), "left")
    single = joined.filter("keep is null").select("row.*")
    # Usually one row per class. Text and names of columns may be anything, so the hash is of the row's JSON form.
    place = F.xxhash64(F.to_json("row"))
    of_class = joined.filter("keep is not null and keep.doc_id <=> id").groupBy("fp", "sha").agg(F.min_by("row", place).alias("row")).select("row.*")
    return single.unionByName(of_class)
