"""Exact top-k inner products over all vectors, by a uniform threshold in three phases.

A score is a sum over slices of the dimensions, and each slice has a list of part scores. (1) Tasks send the best k entries of
every list with their whole scores; the k-th best whole score is a safe cutoff, as k rows reach it. (2) The cutoff goes to all tasks.
A row that reaches it has a part of at least cutoff / slices in some list, so the entries above that threshold are sufficient.
(3) Whole scores are taken of those entries only, those below the cutoff fall away, and the best k of each task meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import arrow_rows, in_tasks, stored

QUERY_BYTES = 16 << 20  # of query vectors that are at tasks at once
ROWS, QUERIES = 2048, 1024  # of a matrix of scores
NO_CUTOFF = -(1 << 63)
_RESULT = "query_id bigint, vec_id bigint, score bigint"


def _vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector as doubles; null vectors and those with null or non-finite components are left out."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x * 1024.0) < float("inf")))
    return rows.filter(F.col("vector").isNotNull() & finite)


def scaled(vectors: list | pa.Array, width: int) -> np.ndarray:
    """floor(1024 * x) of every component as whole doubles, cut or filled with zeros to the width."""
    lists = vectors if isinstance(vectors, pa.Array) else pa.array(vectors, pa.list_(pa.float64()))
    lengths, values = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), lengths)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out, keep = np.zeros((len(lists), width)), at < width
    out[row[keep], at[keep]] = np.floor(1024 * values[keep].astype(np.float64))
    return out


def part_scores(queries: np.ndarray, rows: np.ndarray, slices: int) -> list[np.ndarray]:
    """A matrix (query, row) of exact integers for every slice: doubles while no sum can leave their whole numbers, else Python's integers."""
    largest = max(np.abs(queries).max(initial=0), 1) * max(np.abs(rows).max(initial=0), 1) * max(queries.shape[1], 1)
    if largest >= 2.0**53:
        queries, rows = (np.array([[int(x) for x in r] for r in m.tolist()], dtype=object).reshape(m.shape) for m in (queries, rows))
    cuts = np.linspace(0, queries.shape[1], slices + 1).astype(int)
    return [queries[:, a:b] @ rows[:, a:b].T if b > a else np.zeros((len(queries), len(rows))) for a, b in zip(cuts, cuts[1:])]


def _whole(scores: np.ndarray) -> np.ndarray:
    """As 64-bit integers; a score beyond them becomes the nearest one."""
    return np.clip(scores, -(1 << 63), (1 << 63) - 1).astype(np.int64) if scores.dtype == object else scores.astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, whether they are null, and matrices of at most ROWS rows; rows with very large components come apart."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            null = part.column(0).is_null().to_numpy(zero_copy_only=False)
            ids, rows = part.column(0).fill_null((1 << 63) - 1).to_numpy(), scaled(part.column(1), width)
            large = np.abs(rows).max(axis=1, initial=0) >= 2.0**24
            for chosen in (~large, large):
                if chosen.any():
                    yield ids[chosen], null[chosen], rows[chosen]


def _entries(ids, matrix, cutoffs, width, slices, k, lists: bool):
    """A task's function. With lists: the best k of each slice with whole scores; else the best k of the sufficient entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        kept: list[list[list[np.ndarray]]] = [[] for _ in range(slices if lists else 1)]

        def reduced(found: list[list[np.ndarray]]) -> list[np.ndarray]:
            """By part score in a list, which travels with the whole score; by whole score among sufficient entries."""
            q, v, null, score, total = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((v, null, -1 - score, q))
            q = q[order]
            order = order[np.arange(len(q)) - np.searchsorted(q, q) < k]
            return [x[order] for x in (np.concatenate([f[0] for f in found]), v, null, score, total)]

        for vec_ids, null, rows in _chunks(batches, width):
            for first in range(0, len(ids), QUERIES):
                own = ids[first : first + QUERIES]
                parts = part_scores(matrix[first : first + QUERIES], rows, slices)
                foreign = (own[:, None] != vec_ids[None, :]) | null[None, :]
                if lists:
                    for s, part in enumerate(parts):
                        part = np.where(foreign, part, -np.inf)
                        near = np.argpartition(-part.astype(np.float64), min(k, part.shape[1]) - 1, axis=1)[:, :k]
                        q = np.repeat(np.arange(len(own)), near.shape[1])
                        r = near.ravel()
                        q, r = q[foreign[q, r]], r[foreign[q, r]]
                        whole = _whole(sum(p[q, r] for p in parts))
                        kept[s].append([q + first, vec_ids[r], null[r], _whole(parts[s][q, r]), whole])
                else:
                    cutoff = cutoffs[first : first + QUERIES]
                    threshold = np.where(cutoff == NO_CUTOFF, NO_CUTOFF, (cutoff + slices - 1) // slices)[:, None]
                    q, r = np.nonzero(np.logical_or.reduce([(p if p.dtype != object else _whole(p)) >= threshold for p in parts]) & foreign)
                    whole = _whole(sum(p[q, r] for p in parts))
                    enough = whole >= cutoff[q]
                    q, r, whole = q[enough], r[enough], whole[enough]
                    kept[0].append([q + first, vec_ids[r], null[r], whole, whole])
            for s, found in enumerate(kept):
                if len(found) > 1:
                    kept[s] = [reduced(found)]
        for found in kept:
            if found:
                q, v, null, _, total = reduced(found)
                yield arrow_rows(schema, [ids[q], pa.array(v, pa.int64(), mask=null), total])

    return run


def _query_blocks(queries: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries by rising id in blocks of about QUERY_BYTES."""
    ids, lists, used = [], [], 0
    for row in queries.toLocalIterator():
        if used and used + 8 * len(row[1]) + 8 > QUERY_BYTES:
            yield np.array(ids, np.int64), scaled(lists, max(map(len, lists)))
            ids, lists, used = [], [], 0
        ids.append(row[0])
        lists.append(row[1])
        used += 8 * len(row[1]) + 8
    if ids:
        yield np.array(ids, np.int64), scaled(lists, max(map(len, lists)))


def top_inner_products(vectors: DataFrame, every: int = 100, k: int = 10, slices: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose id is divisible by `every`, the k other ones of largest inner product.

    Components become floor(1024 * x); scores are exact, ties go to the smaller vec_id (null ids, which are never queries, last).
    Vectors that are null or hold a null or non-finite component (also after the factor) take no part. Of several rows with one id
    all are the query's own, and the largest vector is the query; as candidates of other queries all of them count. A shorter vector
    counts as filled with zeros. Scores beyond 64 bits become the nearest 64-bit integer. Other columns are ignored; an empty table
    gives no rows. Queries go to the tasks in blocks of 16 MB, every block in a pass over the table, and of a query each task
    sends at most k rows and list, however many rows are equal.
    """
    rows = _vectors(vectors, id_col, vector_col)
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max("vector").alias("vector"))
    spark, found = vectors.sparkSession, None
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    for ids, matrix in _query_blocks(stored(queries, "queries").orderBy("vec_id")):
        width = matrix.shape[1]
        lists = in_tasks(rows, _entries(ids, matrix, None, width, slices, k, True), _RESULT).distinct()
        gathered = lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
        cutoffs = np.full(len(ids), NO_CUTOFF)
        for query_id, score in gathered.select("query_id", "score").toLocalIterator():
            cutoffs[np.searchsorted(ids, query_id)] = score
        block = stored(in_tasks(rows, _entries(ids, matrix, cutoffs, width, slices, k, False), _RESULT), "sufficient")
        found = block if found is None else found.unionByName(block)
    if found is None:
        found = spark.createDataFrame([], _RESULT)
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
