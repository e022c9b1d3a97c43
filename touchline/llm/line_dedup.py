"""Near-duplicate lines: an edit-distance join by segments, then one line of each group stays.

Two lines within t edits, split into t + 1 segments, share one segment unchanged (the other line is cut at up to t places off). So
every distinct line is indexed under its segments, by length, segment number and content, and probes, for each length that it may
meet, the substrings of its own that can be the segment. Lines that meet under a key are compared with a banded bit-parallel edit
distance. Equal lines are one line throughout, so a line that a third of all documents repeat is one row. Lines too short for
an edit join can still be grouped exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from touchline.llm.common import arrow_rows, bounded, in_tasks, stored, two_columns
from touchline.llm.components import connected_components

EDITS = 2
LEAST_CHARS = 20
EVERY_LINE = 1


def edit_distance_within(a: str, b: str, limit: int) -> int:
    """Edit distance of two texts, or limit + 1 if it is larger. Columns of the table are bit vectors; only a band of
    2 * limit + 1 cells around the diagonal is kept."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > limit:
        return limit + 1
    start = 0
    shortest = len(b)
    while start < shortest and a[start] == b[start]:
        start += 1
    a, b = a[start:], b[start:]
    while b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not b:
        return len(a)
    # state[d] has bit i set if cell (row i, the current column) can be reached with at most d edits, within the band
    n = len(a)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << (i + 1)
    state = [(1 << (d + 1)) - 1 for d in range(limit + 1)]
    full = (1 << (n + 1)) - 1
    for j, c in enumerate(b, 1):
        band = ((1 << (j + limit + 1)) - 1) & full
        if j > limit:
            band &= ~((1 << (j - limit)) - 1)
        match = places.get(c, 0)
        before, state = state, []
        for d in range(limit + 1):
            now = (before[d] << 1) & match
            if d:
                now |= before[d - 1] | (before[d - 1] << 1) | (state[d - 1] << 1)
            if j <= d:
                now |= 1
            state.append(now & band)
    goal = 1 << n
    return next((d for d in range(limit + 1) if state[d] & goal), limit + 1)


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Start and length of edits + 1 segments of about equal length; the last ones are longer by one where it does not come out even."""
    short, extra = divmod(length, edits + 1)
    out, at = [], 0
    for i in range(edits + 1):
        size = short + (i >= edits + 1 - extra)
        out.append((at, size))
        at += size
    return out


def probe_places(length: int, target: int, edits: int):
    """(segment number, start, size) of the substrings of a line that may equal a segment of a line of the target length."""
    gap = length - target
    for i, (at, size) in enumerate(segments(target, edits)):
        # shifts allowed seen from the left and seen from the right, and what both allow
        low = max(0, at - i, at + gap - (edits - i))
        high = min(length - size, at + i, at + gap + (edits - i))
        for start in range(low, high + 1):
            yield i, start, size


def _cuts(n: int, edits: int) -> tuple[list, list]:
    """For a line of length n: seed, start and end of its own segments, and of the substrings it asks for."""

    def cut(target: int, i: int, start: int, size: int) -> tuple[int, int, int]:
        return target << 3 | i, start, start + size

    own = [cut(n, i, at, size) for i, (at, size) in enumerate(segments(n, edits))]
    asked = [cut(t, *p) for t in range(max(0, n - edits), n + 1) for p in probe_places(n, t, edits)]
    # lines of its own length meet under equal segments and under shifted ones
    return own, [c for c in asked if c not in own]


_KNOWN_CUTS: dict[tuple[int, int], tuple[list, list]] = {}


def _keys(line: str, edits: int) -> tuple[list[int], list[int]]:
    """Keys of 48 bits under which a line stands, and keys that it asks for (lengths up to its own). Keys that agree by chance
    only cost a comparison."""
    if (len(line), edits) not in _KNOWN_CUTS:
        if len(_KNOWN_CUTS) > 4096:
            _KNOWN_CUTS.clear()
        _KNOWN_CUTS[len(line), edits] = _cuts(len(line), edits)
    own, asked = _KNOWN_CUTS[len(line), edits]
    stands = [xxh3_64_intdigest(line[a:b].encode("utf-8", "surrogatepass"), seed) >> 16 for seed, a, b in own]
    return stands, [xxh3_64_intdigest(line[a:b].encode("utf-8", "surrogatepass"), seed) >> 16 for seed, a, b in asked]


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def _counts(line: Column, least_chars: int, exact_chars: int | None) -> Column:
    """Whether a line takes part: it is long enough to be linked, or long enough to be grouped exactly and not only white space."""
    long = F.length(line) >= least_chars
    return long if exact_chars is None else long | ((F.length(line) >= exact_chars) & line.rlike(r"\S"))


def distinct_lines(docs: DataFrame, id_col: str, text_col: str, least_chars: int, exact_chars: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines, distinct): lines has (doc_id, line_no, line_key) for each line that is long enough, the key being a 128-bit digest;
    distinct has each different line once, with first place and number of places. Lines are cut at line feeds and trimmed of blanks."""
    rows = two_columns(docs, id_col, text_col)
    each = rows.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).withColumn("line", F.trim("line"))
    each = each.filter(_counts(F.col("line"), least_chars, exact_chars))
    distinct = each.groupBy("line").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("places"))
    return each.select("doc_id", "line_no", line_key(F.col("line")).alias("line_key")), distinct


_PLACES = np.uint64(4) * np.arange(16, dtype=np.uint64)


def _letter_counts(line: str) -> int:
    """16 counters of 4 bits: how many letters fall into each of 16 classes. One edit changes them by at most 2 in all."""
    letters = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4")
    counts = np.bincount((letters * np.uint32(0x9E37) >> np.uint32(4)) & np.uint32(15), minlength=16)
    return int(((counts.astype(np.uint64) & np.uint64(15)) << _PLACES).sum().view(np.int64))


def _close_counts(a: np.ndarray, b: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of counters that differ by at most 2 * edits in all (a wrapped counter differs by less, never by more)."""
    rows, columns = [], []
    for at in range(0, len(a), 256):
        apart = np.zeros((len(a[at : at + 256]), len(b)), np.uint8)
        for i in range(16):
            shift = np.uint64(4 * i)
            x = ((a[at : at + 256] >> shift) & np.uint64(15)).astype(np.uint8)
            y = ((b >> shift) & np.uint64(15)).astype(np.uint8)
            gap = (x[:, None] - y[None, :]) & np.uint8(15)
            apart += np.minimum(gap, 16 - gap)
        i, j = np.nonzero(apart <= 2 * edits)
        rows.append(i + at)
        columns.append(j)
    return np.concatenate(rows), np.concatenate(columns)


def _meetings(ids: np.ndarray, counters: np.ndarray, asks: np.ndarray, edits: int) -> np.ndarray:
    """Pairs (smaller, larger id) of lines under one key, at least one of which stands there, that their letters allow."""
    there = np.flatnonzero(~asks)
    if not len(there) or len(ids) < 2:
        return np.empty((0, 2), np.int64)
    i, j = _close_counts(counters[there], counters, edits)
    a, b = ids[there[i]], ids[j]
    pairs = np.stack([np.minimum(a, b), np.maximum(a, b)], 1)
    return pairs[a != b]


def line_links(distinct: DataFrame, edits: int = EDITS, most_under_key: int = 4096) -> DataFrame:
    """Pairs (a, b), a < b, of line ids for all different lines within so many edits. distinct has line_id and line.

    Meetings carry the id (the lowest bit of `who` says whether the line asks or stands there), letter counts and the key, whose
    empty bytes come last so that they are squeezed out of the shuffle. The few different pairs that these allow fetch their
    lines and are measured. A key under which more than most_under_key lines meet is passed on and dealt as pairs of blocks
    over all tasks.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("who", pa.int64()), ("counters", pa.int64()), ("key", pa.int64())])
        for batch in batches:
            keys, asks, repeat, counters = [], [], [], []
            for line in batch.column("line").to_pylist():
                own, asked = _keys(line, edits)
                keys += own + asked
                asks += [False] * len(own) + [True] * len(asked)
                repeat.append(len(own) + len(asked))
                counters.append(_letter_counts(line))
            who = np.repeat(batch.column("line_id").to_numpy(zero_copy_only=False), repeat) << 1 | np.array(asks, bool)
            yield arrow_rows(schema, [who, np.repeat(np.array(counters, np.int64), repeat), keys])

    met_schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("asks", pa.bool_()), ("counters", pa.int64())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(table):
            key, who, counters = (table.column(c).to_numpy(zero_copy_only=False) for c in ("key", "who", "counters"))
            ids, asks, counters = who >> 1, (who & 1).astype(bool), counters.view(np.uint64)
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            found, passed = [np.empty((0, 2), np.int64)], []
            for s, e in zip(edge[:-1][np.diff(edge) > 1].tolist(), edge[1:][np.diff(edge) > 1].tolist()):
                if e - s > most_under_key:
                    passed.append((s, e))
                else:
                    found.append(_meetings(ids[s:e], counters[s:e], asks[s:e], edits))
            pairs = np.unique(np.concatenate(found), axis=0)
            none = pa.nulls(len(pairs), pa.int64())
            yield arrow_rows(met_schema, [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, pa.nulls(len(pairs), pa.bool_()), none])
            for s, e in passed:
                yield arrow_rows(met_schema, [pa.array(ids[s:e]), pa.nulls(e - s, pa.int64()), pa.array(key[s:e]), pa.array(asks[s:e]), pa.array(counters[s:e].view(np.int64))])

        held = None
        for batch in batches:  # rows come sorted by key; the last key of a batch may go on in the next one
            held = batch if held is None else pa.concat_batches([held, batch])
            key = held.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if last:
                yield from rows(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from rows(held)

    keyed = in_tasks(distinct.select("line_id", "line"), emit, "who bigint, counters bigint, key bigint")
    together = keyed.repartition("key").sortWithinPartitions("key")
    met = stored(in_tasks(together, meet, "a bigint, b bigint, key bigint, asks boolean, counters bigint"), "line-meetings")
    crowded = met.filter("key is not null").select("key", F.col("a").alias("line_id"), "asks", "counters")
    size = stored(crowded.groupBy("key").agg(F.ceil(F.count("*") / (most_under_key // 2)).alias("blocks")), "crowded-keys")
    dealt = crowded.join(bounded(size), "key").withColumn("own", F.pmod(F.xxhash64("line_id"), "blocks"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    left = dealt.select("key", F.col("own").alias("i"), every.alias("j"), "line_id", "asks", "counters")
    right = dealt.select("key", every.alias("i"), F.col("own").alias("j"), "line_id", "asks", "counters")

    def meet_blocks(group: pa.Table) -> pa.Table:
        columns = (group.column(c).to_numpy(zero_copy_only=False) for c in ("line_id", "counters", "asks"))
        ids, counters, asks = columns
        pairs = np.unique(_meetings(ids, counters.view(np.uint64), asks.astype(bool), edits), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    crowd = left.unionByName(right).filter("i <= j").distinct().groupBy("key", "i", "j").applyInArrow(meet_blocks, "a bigint, b bigint")
    pairs = stored(met.filter("key is null").select("a", "b").unionByName(crowd).distinct(), "line-pairs")
    wanted = bounded(stored(pairs.select(F.explode(F.array("a", "b")).alias("line_id")).distinct(), "line-ids"))
    lines = distinct.select("line_id", "line").join(wanted, "line_id")
    both = pairs.join(lines.toDF("a", "line_a"), "a").join(lines.toDF("b", "line_b"), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [edit_distance_within(x, y, edits) <= edits for x, y in zip(batch.column("line_a").to_pylist(), batch.column("line_b").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return in_tasks(both.select("a", "b", "line_a", "line_b"), verify, "a bigint, b bigint")


def line_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least_chars: int = LEAST_CHARS, exact_chars: int | None = None
) -> DataFrame:
    """Each different line of at least least_chars (or exact_chars) once: line_key (its MD5), line_id, class_id (smallest line_id reachable
    by links of at most `edits` edits, which only lines of least_chars have), first (doc_id, line_no of its first place), keep (that of
    the class) and places (how often it stands)."""
    distinct = distinct_lines(docs, id_col, text_col, least_chars, exact_chars)[1].withColumn("line_id", F.monotonically_increasing_id())
    distinct = stored(distinct, "lines", compression="zstd")
    groups = connected_components(line_links(distinct.filter(F.length("line") >= least_chars), edits), "line-groups")
    classed = distinct.withColumn("line_key", line_key(F.col("line"))).drop("line").join(bounded(groups.withColumnRenamed("node", "line_id")), "line_id", "left")
    classed = classed.withColumn("class_id", F.coalesce("component", "line_id"))
    kept = classed.filter("component is not null").groupBy("component").agg(F.min("first").alias("class_first"))
    joined = classed.join(bounded(kept), "component", "left")
    return joined.select("line_key", "line_id", "class_id", "first", F.coalesce("class_first", "first").alias("keep"), "places")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least_chars: int = LEAST_CHARS, exact_chars: int | None = None
) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, text (without the dropped lines) and dropped (their numbers, rising).

    Of all lines that equal each other or are linked by at most `edits` edits, once blanks at their ends are cut, only the first by
    (doc_id, line_no) stays; null ids come first. Of shorter lines, those of exact_chars or more that equal each other are one line
    likewise (EVERY_LINE for all), and without exact_chars they always stay; blank ones always stay. A null text has no lines and stays
    null, an empty text has one empty line. Rows that repeat an id and a text are one document, given once per row; repeated ids with different texts
    count as separate documents, and a line that both have at the same place stays in both. Other columns are ignored.
    """
    classes = line_classes(docs, id_col, text_col, edits, least_chars, exact_chars)
    # Only lines that stand twice or have a partner can be dropped; the rest needs no second look.
    repeated = stored(classes.filter("places > 1 or keep <> first").select("line_key", "keep"), "repeated-lines")
    rows = two_columns(docs, id_col, text_col)
    each = rows.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_key"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    each = each.withColumn("line", F.trim("line")).filter(_counts(F.col("line"), least_chars, exact_chars))
    each = each.select("doc_id", "text_key", "line_no", line_key(F.col("line")).alias("line_key"))
    place = F.struct("doc_id", "line_no")
    found = each.join(bounded(repeated), "line_key").filter(~place.eqNullSafe(F.col("keep")))
    dropped = found.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))
    dropped = bounded(stored(dropped, "dropped-lines").select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "dropped"))
    key = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    joined = rows.join(dropped, F.col("doc_id").eqNullSafe(F.col("d")) & (key == F.col("k")), "left")
    lines = F.split("text", "\n", -1)
    left = F.filter(lines, lambda _, i: ~F.array_contains("dropped", i))
    return joined.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )
