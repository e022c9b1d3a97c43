"""Packing of token sequences into windows of a fixed length: non-negative least squares over shallow length combinations.

Each document's ids are cut into full windows and one rest. The histogram of rests has as many bins as a window has places, so
the plan is made from counts alone: combinations of at most a few lengths that fill a window exactly are enumerated, least squares
finds how often each is to be used, the counts are rounded to whole windows, and what is left is packed greedily. Documents then
find their place by their rank among the rests of equal length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import arrow_rows, bounded, in_tasks, stored, two_columns
from touchline.llm.tokens import lead_spaces, worker_tokenizer

# Pieces of one length are ranked in groups of about so many rows, however many there are.
GROUP_ROWS = 50_000
# Added before a repeat count is cut to a whole number; the plan with the fewest windows is kept.
ROUNDINGS = (0.5, 0.25, 0.0, -0.5, -2.0)
PIECES = "doc_id bigint, copy_key bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def combinations_of(lengths: np.ndarray, window: int, limit: int) -> list[tuple[int, ...]]:
    """Sets of one, two or three of the lengths that fill the window exactly, at most about limit triples, spread evenly."""
    there = set(lengths.tolist())
    found = [(window,)] if window in there else []
    found += [(window - a, a) for a in sorted(there) if 2 * a <= window and window - a in there]
    triples = [
        (window - a - b, b, a)
        for a in sorted(there)
        for b in sorted(x for x in there if a <= x)
        if window - a - b >= b and window - a - b in there
    ]
    step = max(1, -(-len(triples) // limit))
    return found + triples[::step]


def least_squares(uses: np.ndarray, wanted: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 that makes uses @ x close to wanted: accelerated projected gradient, each column scaled to its norm.

    The wanted counts are divided by their largest, so the work is the same for small and large histograms.
    """
    scale = max(1.0, float(wanted.max(initial=0)))
    norms = np.sqrt((uses**2).sum(axis=0))
    a, b = uses / norms, wanted / scale
    step = 1.0 / max(1e-12, np.linalg.norm(a, 2) ** 2)
    x = ahead = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, ahead - step * (a.T @ (a @ ahead - b)))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x / norms * scale


def pack_histogram(counts: dict[int, int], window: int, combinations: int = 2000) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order of their offsets) with repeat counts, which use every counted length exactly as often as it occurs.

    Whole windows come from the rounded least squares solution, the rest from taking the largest length left and then, again and
    again, the largest that still fits, many windows of one pattern at a time.
    """
    left = {n: c for n, c in counts.items() if c}
    lengths = np.array(sorted(left), np.int64)
    combos = combinations_of(lengths, window, combinations) if len(lengths) else []
    if not combos:
        return _greedy(left, window)
    index = {n: i for i, n in enumerate(lengths.tolist())}
    uses = np.zeros((len(lengths), len(combos)))
    for j, combo in enumerate(combos):
        for n in combo:
            uses[index[n], j] += 1
    solved = least_squares(uses, np.array([left[n] for n in lengths.tolist()], float))
    plans = [_rounded(left, combos, solved, shift, window) for shift in ROUNDINGS]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def _rounded(counts: dict[int, int], combos: list, solved: np.ndarray, shift: float, window: int) -> list:
    """Repeat counts rounded by adding shift and cutting off, never beyond what is left, then the greedy rest."""
    left, plan = dict(counts), []
    for j in np.argsort(-solved, kind="stable").tolist():
        need = {n: combos[j].count(n) for n in combos[j]}
        times = min(int(np.floor(solved[j] + shift)), *(left[n] // k for n, k in need.items()))
        if times > 0:
            plan.append((combos[j], times))
            for n, k in need.items():
                left[n] -= k * times
    return plan + _greedy(left, window)


def _greedy(counts: dict[int, int], window: int) -> list:
    left, plan = {n: c for n, c in counts.items() if c}, []
    there = sorted(left)
    while there:
        pattern, room, used = [], window, {}
        at = len(there)
        while room > 0 and (at := bisect_right(there, room, 0, at)):
            n = there[at - 1]
            if left[n] > used.get(n, 0):
                used[n] = used.get(n, 0) + 1
                pattern.append(n)
                room -= n
            else:
                at -= 1
        times = min(left[n] // k for n, k in used.items())
        plan.append((tuple(pattern), times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                there.remove(n)
    return plan


def slots_of(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first sequence, offset): pieces of a length by rank, one interval per place in a pattern."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for n in pattern:
            out.append((n, rank.get(n, 0), times, sequence, offset))
            rank[n] = rank.get(n, 0) + times
            offset += n
        sequence += times
    return out


def cut_documents(docs: DataFrame, window: int, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts (null: empty), add end_id, cut into full windows and a rest. copy_key tells apart rows with equal ids."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "copy_key", "start", "length", "ids_crc32", "doc_tokens")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = worker_tokenizer(tokenizer_path, lead_spaces), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, copy_key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "copy_key", "text"))):
                data = memoryview(tokenizer.ids(text) + end)
                total = len(data) // 4
                for start in range(0, total, window):
                    piece = data[4 * start : 4 * (start + window)]
                    out.append((doc_id, copy_key, start, len(piece) // 4, zlib.crc32(piece), total))
            yield arrow_rows(schema, list(zip(*out)) if out else [[]] * 6)

    rows = two_columns(docs, id_col, text_col).withColumn("copy_key", F.monotonically_increasing_id())
    return in_tasks(rows, run, PIECES)


def pack_documents(
    docs: DataFrame, window: int, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", combinations: int = 2000
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padding (of its sequence).

    A null text counts as empty and gives the end id alone. Null ids and repeated rows are packed like any others. Other columns
    are ignored. An empty table gives no row. Ranks among pieces of one length come from counts per (length, hash of the
    id) and a window inside these groups. A length has as many groups as its count asks for, so one that a third of all rows share
    is dealt over many tasks of a fixed size.
    """
    pieces = stored(cut_documents(docs, window, tokenizer_path, end_id, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    groups_of = F.from_json(F.lit(str([-(-counts.get(n, 1) // GROUP_ROWS) for n in range(window + 1)])), "array<bigint>")
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "copy_key", "start"), F.get(groups_of, F.col("length").cast("int"))))
    groups = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    groups = stored(groups.withColumn("before", F.coalesce(before, F.lit(0))), "piece-groups")
    plan = pack_histogram(counts, window, combinations)
    fill = {}
    slots = slots_of(plan)
    for n, _, _, sequence, offset in slots:
        fill[sequence] = max(fill.get(sequence, 0), offset + n)
    spark = docs.sparkSession
    rows = [(n, rank, rank + times, sequence, offset, window - fill[sequence]) for n, rank, times, sequence, offset in slots]
    places = spark.createDataFrame(rows, "length bigint, low bigint, high bigint, first bigint, offset bigint, padding bigint")
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "copy_key", "start")
    ranked = (
        pieces.withColumn("rank_in_group", F.row_number().over(inside) - 1)
        .join(bounded(groups.drop("n")), ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("rank_in_group"))
    )
    # A row per place in a pattern: the plan has some thousand patterns at most, whatever the input.
    by_length = places.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("low", "high", "first", "offset", "padding"))).alias("places"))
    found = F.expr("filter(places, p -> p.low <= rank and rank < p.high)[0]")
    return (
        ranked.join(F.broadcast(by_length), "length")
        .withColumn("place", found)
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("place.first") + F.col("rank") - F.col("place.low")).alias("sequence_id"), F.col("place.offset").alias("offset"),
            F.col("place.padding").alias("padding"),
        )
    )
