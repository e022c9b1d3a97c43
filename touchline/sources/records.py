"""Records of CSV files whose quoted fields may hold line breaks, read by many tasks per file.

Whether a line starts a record depends on the quotes before it, back to the start of the file. A first pass counts the quotes of every
block that a task reads; the sums up to each block say whether it starts inside quotes. With that, the second pass puts the lines of a
block together to records wherever the number of quotes is even. What is left at the ends of blocks are the pieces of the few records that
reach over them; these are sorted by block and joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline import contract as C

BROADCAST_BLOCKS = 200_000
WHOLE, ENDING, INSIDE, BEGINNING = range(4)  # a record; pieces that end one, lie inside one, begin one; a block's pieces in this order
_PIECES = "key bigint, kind int, first boolean, record binary"


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The lines of the files as bytes, with the file and the start of the block from which a task reads them."""
    text = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.[cC][sS][vV]").text(paths)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return text.select(*place, F.col("value").cast("binary").alias("line"))


def _quotes(line: Column) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line.cast("string"), F.lit('"'), F.lit("")))


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces from the lines (key, open, start, line) of whole blocks, each block's in their order; a block has a key.

    Lines that are records by themselves are picked by number; only the others are handled one by one.
    """
    schema = pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("record", pa.binary())])
    key, odd, held, heading, at_start = None, 0, [], False, False

    def rows(kind: int, records: list | pa.Array, first: bool) -> pa.RecordBatch:
        n = len(records)
        values = records if isinstance(records, pa.Array) else pa.array(records, pa.binary())
        flags = pa.array(np.arange(n) < int(first))
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, key)), pa.array(np.full(n, kind, np.int32)), flags, values], schema=schema)

    for batch in batches:
        keys = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(edges, edges[1:]):
            if start == end:
                continue
            if keys[start] != key:
                if held:
                    yield rows(INSIDE if heading else BEGINNING, [b"\n".join(held)], at_start)
                key, odd = keys[start], batch.column(1)[start].as_py()
                held, heading, at_start = [], bool(odd), batch.column(2)[start].as_py()
            lines = batch.column(3).slice(start, end - start)
            after = (odd + np.cumsum(pa.compute.count_substring(lines, '"').to_numpy())) & 1
            begins = np.flatnonzero(np.r_[odd, after[:-1]] == 0)
            odd = int(after[-1])
            go_on = int(begins[0]) if len(begins) else len(lines)
            if go_on:  # the lines up to the first that begins a record
                held += lines.slice(0, go_on).to_pylist()
            if len(begins) or not odd:
                if held:
                    yield rows(ENDING if heading else WHOLE, [b"\n".join(held)], at_start)
                    held, heading, at_start = [], False, False
            if not len(begins):
                continue
            if odd:
                held = lines.slice(int(begins[-1])).to_pylist()
                begins = begins[:-1] if len(begins) > 1 else begins[:0]
                stops = np.r_[begins[1:], len(lines) - len(held)]
            else:
                stops = np.r_[begins[1:], len(lines)]
            if len(begins):
                long = np.flatnonzero(stops - begins > 1)
                if at_start and len(long) and long[0] == 0:
                    yield rows(WHOLE, [b"\n".join(lines.slice(int(begins[0]), int(stops[0] - begins[0])).to_pylist())], True)
                    long, at_start = long[1:], False
                short = lines.take(pa.array(begins[stops - begins == 1]))
                if len(short):
                    yield rows(WHOLE, short, at_start)
                    at_start = False
                if len(long):
                    yield rows(WHOLE, [b"\n".join(lines.slice(int(begins[i]), int(stops[i] - begins[i])).to_pylist()) for i in long], False)
    if held:
        yield rows(INSIDE if heading else BEGINNING, [b"\n".join(held)], at_start)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records from their pieces: one begins one, and all up to the next that begins another follow. A file's pieces are at most two a block.
    A record without its end has a quote left open."""
    order = Window.partitionBy("file").orderBy("block", "kind")
    numbered = pieces.withColumn("record_no", F.count_if(F.col("kind") == BEGINNING).over(order))
    ordered = F.sort_array(F.collect_list(F.struct("block", "kind", F.col("record").cast("string").alias("piece"))))
    joined = F.array_join(F.transform(ordered, lambda p: p["piece"]), "\n").cast("binary")
    record = F.when(F.bool_or(F.col("kind") == ENDING), joined).otherwise(F.raise_error(F.lit(C.MSG_OPEN_QUOTE)).cast("binary"))
    return numbered.groupBy("file", "record_no").agg(F.bool_or("first").alias("first"), record.alias("record")).drop("record_no")


def csv_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, first, record): the records of all files as bytes; first marks each file's header. Blank lines are left out.

    Line ends of two characters become one, also inside quotes. The first pass runs at once; it sends one number per block. Blocks
    are as long as spark.sql.files.maxPartitionBytes says; if that changes before the second pass, it fails. The states of the blocks
    are broadcast if a count shows them to be few; else the lines are shuffled by block to meet them, and sorted back into their order.
    """
    lines = _lines(spark, paths)
    blocks = lines.groupBy("file", "block").agg((F.sum(_quotes(F.col("line"))) % 2).alias("odd"))
    file = Window.partitionBy("file")
    before = F.coalesce(F.sum("odd").over(file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    key = F.xxhash64("file", "block")
    states = blocks.select("file", "block", (before % 2).cast("int").alias("open"), (F.sum("odd").over(file) % 2).alias("unclosed"), key.alias("key"))
    known = states.limit(BROADCAST_BLOCKS + 1).collect()
    if len(known) <= BROADCAST_BLOCKS:
        reaching = any(r["open"] or r["unclosed"] for r in known)
        states = F.broadcast(spark.createDataFrame(known, states.schema))
        dealt = lines.join(states, ["file", "block"], "left")
    else:
        reaching = True
        numbered = lines.withColumn("place", F.monotonically_increasing_id()).join(states, ["file", "block"], "left")
        dealt = numbered.repartition("key").sortWithinPartitions("key", "place")
    opened = F.coalesce("open", F.raise_error(F.lit(C.MSG_SPLITS_CHANGED)).cast("int")).alias("open")
    pieces = dealt.select(F.coalesce("key", key).alias("key"), opened, (F.col("block") == 0).alias("start"), "line").mapInArrow(_together, _PIECES)
    whole = pieces.filter(F.col("kind") == WHOLE).select("key", "first", "record")
    whole = whole.join(states.select("key", "file"), "key").select("file", "first", "record")
    if reaching:
        rest = pieces.filter(F.col("kind") != WHOLE).join(states.select("key", "file", "block"), "key")
        whole = whole.unionByName(_joined(rest))
    text = F.col("record").cast("string")
    text = F.when(text.contains("\r"), F.regexp_replace(text, "\r(\n|$)", "$1")).otherwise(text)
    return whole.select("file", "first", text.alias("record")).filter("record <> ''")
