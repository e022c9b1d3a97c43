"""Connected components of a distributed list of links, by alternating large and small stars over minima."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import in_tasks, stored


class Forest:
    """Disjoint sets over any ordered values; the smallest value of a set is its root."""

    def __init__(self):
        self._up: dict = {}

    def root(self, x):
        path = []
        while (y := self._up.get(x, x)) != x:
            path.append(x)
            x = y
        for p in path:
            self._up[p] = x
        return x

    def link(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self._up[b] = a
        return True

    def links(self) -> list[tuple]:
        return [(self.root(x), x) for x in list(self._up)]

    def __len__(self):
        return len(self._up)


def contracted(links: DataFrame, most: int = 500_000) -> DataFrame:
    """The same components with fewer links: each task keeps a forest of what it reads, flushed after `most` nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            schema = batch.schema
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                forest.link(a, b)
            if len(forest) > most:
                yield _as_batch(forest, schema)
                forest = Forest()
        if len(forest):
            yield _as_batch(forest, schema)

    pairs = links.select("a", "b")
    return in_tasks(pairs, run, pairs.schema)


def _as_batch(forest: Forest, schema: pa.Schema) -> pa.RecordBatch:
    pairs = forest.links()
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], type=schema.field(i).type) for i in (0, 1)], schema=schema)


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of the links (a, b), component being the smallest node that can be reached.

    Null ends and loops are left out; repeated links do no harm; no links give no row. Nodes may be of any type that can be ordered.
    Links are first contracted task by task. Then, until nothing changes, every node hands the smallest node next to it to its larger
    neighbours (large star) and to its smaller ones (small star), both as a grouped minimum joined back, so a node with any
    number of links is summed up task by task and never gathered. Every round is stored.
    """
    now = stored(contracted(links.filter("a is not null and b is not null and a <> b")), name)
    now = stored(contracted(now.repartition("a")).distinct(), name)
    before = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("b").alias("x"), "m"), F.struct(F.col("a").alias("x"), "m"))).alias("l"))
        now = stored(small.select(F.col("l.m").alias("a"), F.col("l.x").alias("b")).filter("a <> b").distinct(), name)
        state = _state(now)
        if state == before:
            break
        before = state
    members = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return members.unionByName(roots)
