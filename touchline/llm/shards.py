"""Shards of nearly equal size from contiguous runs of ordered groups that must stay together: the smallest possible largest shard.

Groups (rows with equal texts) stand in the order of their smallest id. The capacity is found by binary search; a capacity is checked
by filling shard after shard greedily up to it. The greedy fill only asks for the last group end at or before a position, so the
driver works on a short list of known group ends and has Spark refine, by grouped minima and maxima, just those stretches
in which an answer is still open. All else is DataFrame work: no Python runs on rows.
"""

from __future__ import annotations

from bisect import bisect_right, insort

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import bounded, quantile_bounds, range_bucket, stored

CELLS = 1024
PART_ROWS = 250_000


class GroupEnds:
    """Known group ends, and which stretches between two of them hold ends that are not known yet."""

    def __init__(self, total: int, groups: int):
        self.ends = [0, total]
        self.open = {0} if groups > 1 else set()

    def last_end(self, position: int) -> tuple[int, int, bool]:
        """(at least, at most, known): bounds of the last group end at or before a position."""
        i = bisect_right(self.ends, position) - 1
        low = self.ends[i]
        if low in self.open and position > low:
            return low, min(position, self.ends[i + 1] - 1), False
        return low, low, True

    def fill(self, capacity: int, shards: int, hopeful: bool) -> tuple[bool, list[int], set[int]]:
        """Greedy fill: whether it takes at most so many shards, the cuts, and the open stretches it met."""
        at, cuts, met, total = 0, [], set(), self.ends[-1]
        while at < total and len(cuts) < shards:
            low, high, known = self.last_end(at + capacity)
            if not known:
                met.add(low)
            end = high if hopeful else low
            if end <= at:
                return False, cuts, met
            at = end
            cuts.append(at)
        return at >= total, cuts, met

    def smallest(self, low: int, shards: int, hopeful: bool) -> int:
        high = self.ends[-1]
        while low < high:
            middle = (low + high) // 2
            if self.fill(middle, shards, hopeful)[0]:
                high = middle
            else:
                low = middle + 1
        return low

    def stretch(self, start: int) -> tuple[int, int]:
        return start, self.ends[bisect_right(self.ends, start)]

    def refine(self, start: int, cells: list[tuple[int, int, int]]) -> None:
        """Replace a stretch by its cells (first end, last end, number of ends), in order."""
        self.open.discard(start)
        for first, last, n in cells:
            for end in {first, last}:
                if self.ends[bisect_right(self.ends, end) - 1] != end:
                    insort(self.ends, end)
            if n > 2:
                self.open.add(first)


def minimax_cuts(groups: DataFrame, shards: int) -> list[int]:
    """Ends of the shards (at most `shards` of them, the last is the total) for groups with p_end, the running size, and size."""
    total, most, count = groups.agg(F.max("p_end"), F.max("size"), F.count("*")).first()
    if not count:
        return []
    known, least = GroupEnds(total, count), max(most, -(-total // shards))
    while True:
        hope, sure = known.smallest(least, shards, True), known.smallest(least, shards, False)
        _, cuts, met = known.fill(sure, shards, False)
        if hope == sure and not met:
            return cuts
        stretches = sorted(known.stretch(s) for s in met | known.fill(hope, shards, True)[2])
        cell: Column = F.lit(None).cast("bigint")
        where = F.lit(False)
        for i, (a, b) in enumerate(stretches):
            inside = (F.col("p_end") > a) & (F.col("p_end") < b)
            width = max(1, -(-(b - a) // CELLS))
            cell = F.when(inside, F.lit(i * CELLS * 2) + F.floor((F.col("p_end") - a) / width)).otherwise(cell)
            where = where | inside
        found = groups.filter(where).groupBy(cell.alias("cell")).agg(F.min("p_end").alias("a"), F.max("p_end").alias("b"), F.count("*").alias("n")).collect()
        for i, (a, _) in enumerate(stretches):
            known.refine(a, sorted((r["a"], r["b"], r["n"]) for r in found if r["cell"] // (CELLS * 2) == i))


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot, grown_shard.

    Rows with equal texts share a shard; null and empty texts are equal, with size 1. The largest shard is as small as contiguous runs of
    groups allow, so law is "bytes" and grown_shard is null. Slots count from 0 in the order of (smallest id of the group, id);
    null ids come first, and rows that repeat an id and a text take neighbouring slots. Other columns are ignored.

    Every rank is a sum of counts per part of the id range plus a rank inside one (text, part), so neither a shard nor a text that
    a third of all rows have is ever ordered in one task.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.monotonically_increasing_id().alias("row_key"),
    )
    rows = stored(rows, "sizes")
    bounds = quantile_bounds(rows, "doc_id", max(8, rows.count() // PART_ROWS))
    rows = rows.withColumn("part", range_bucket(F.col("doc_id"), bounds))
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id"))
    of_text = Window.partitionBy("sha").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pairs = rows.groupBy("sha", "part").agg(F.count("*").alias("n"), F.sum("size").alias("size"), first.alias("first"))
    pairs = stored(pairs.withColumn("before", F.coalesce(F.sum("n").over(of_text), F.lit(0))), "text-parts")
    groups = pairs.groupBy("sha").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.sum("size").alias("size"))
    groups = groups.withColumn("part", range_bucket(F.col("first.doc_id"), bounds))
    # one row per part of the id range, so a single task may add them up
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.groupBy("part").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    offsets = offsets.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("size").over(upto), F.lit(0)).alias("size_before"))
    inside = Window.partitionBy("part").orderBy("first", "sha").rowsBetween(Window.unboundedPreceding, 0)
    groups = groups.join(F.broadcast(offsets), "part").select(
        "sha", "size", "n",
        (F.col("size_before") + F.sum("size").over(inside)).alias("p_end"),
        (F.col("rows_before") + F.sum("n").over(inside) - F.col("n")).alias("r_start"),
    )
    groups = stored(groups, "groups")
    cuts = minimax_cuts(groups, shards)
    shard = sum(((F.col("p_end") > c).cast("int") for c in cuts[:-1]), F.lit(0))
    sharded = groups.withColumn("shard", shard)
    starts = sharded.groupBy("shard").agg(F.min("r_start").alias("shard_start"))
    placed = pairs.select("sha", "part", "before").join(bounded(sharded.select("sha", "shard", "r_start")), "sha")
    placed = placed.join(F.broadcast(starts), "shard").select("sha", "part", "shard", (F.col("r_start") - F.col("shard_start") + F.col("before")).alias("base"))
    rank = F.row_number().over(Window.partitionBy("sha", "part").orderBy(F.col("doc_id").asc_nulls_first(), "row_key"))
    return rows.withColumn("rank", rank).join(bounded(placed), ["sha", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("rank") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
