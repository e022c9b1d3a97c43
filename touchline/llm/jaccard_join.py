"""Near-duplicate texts: an exact Jaccard join of shingle sets under several global orders, and the groups that its links form.

Equal sets are one class throughout. Orders put rare shingles first and break ties by different hashes. Two sets within the
threshold share a shingle among the first few (the prefix) of each order. Shingles that only one class has cannot be shared but
take up places of the prefix, so most texts have no prefix left and drop out before anything is compared. Classes that
meet under the first order form families; inside a family, pairs must meet under every order and have fitting sizes before their
sets are compared, and pairs that are connected already are not compared again, as only the groups are asked for.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import arrow_rows, bounded, in_tasks, mix64, slices, stored, two_columns
from touchline.llm.components import Forest, connected_components
from touchline.llm.shingles import Shingler, set_name

PERCENT = 75
ORDERS = 2
CHUNK_DOCS, CHUNK_TOKENS = 512, 1 << 18
BUCKET_TOKENS = 1 << 18
FAMILY_BLOCK = 2000
_LOW = np.uint64((1 << 48) - 1)
_SEEDS = tuple(np.uint64(s) for s in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89))
_BATCH_BYTES = 4 << 20


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """A set of n shingles within the threshold of another shares at least ceil(n * percent / 100) with it, so one of any
    n - that + 1 of its own."""
    return n - -(-n * percent // 100) + 1


def linked(shared: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (a + b - shared)


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n, node) for rows (doc_id, text): size and 16-byte name of the shingle set, null for none."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for part in slices(batch, "text", _BATCH_BYTES):
                sets = shingler.sets(part.column("text").to_pylist())
                yield arrow_rows(schema, [part.column("doc_id"), [len(s) for s in sets], [set_name(s) for s in sets]])

    return in_tasks(docs, run, "doc_id bigint, n bigint, node binary")


def _six(values: np.ndarray) -> bytes:
    """The low 48 bits of each value in 6 bytes."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").reshape(-1)


_PACKED = "chunk bigint, bucket int, places binary, counts binary, names binary, tokens binary, spread binary"
_PACKED_ARROW = pa.schema(
    [("chunk", pa.int64()), ("bucket", pa.int32()), *((c, pa.binary()) for c in ("places", "counts", "names", "tokens", "spread"))]
)


def _chunks(bits: int):
    """Documents in chunks: a row per chunk and bucket of leading hash bits with all its shingles, and a header row with names and
    sizes. Headers have negative buckets, spread over many, as they only pass through. A task sends each class once."""

    def pack(number: int, sets: list[np.ndarray], names: list[bytes]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], "<u4")
        tokens, place = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
        bucket = (tokens >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(tokens), np.int64)
        order = np.argsort(bucket, kind="stable")
        tokens, place, bucket = tokens[order] & _LOW, place[order], bucket[order]
        edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        short = np.array([np.frombuffer(n[:8], "<u8")[0] for n in names], "<u8")
        header = -1 - int(mix64(np.array([number], np.uint64))[0] % np.uint64(1 << 16))
        rows = [(number, header, b"", sizes.tobytes(), b"".join(names), b"", b"")]
        for a, b in zip(edge.tolist(), edge[1:].tolist()):
            there, counts = np.unique(place[a:b], return_counts=True)
            rows.append((number, int(bucket[a]), there.astype("<u2").tobytes(), counts.astype("<u4").tobytes(), short[there].tobytes(), _six(tokens[a:b]), b""))
        return arrow_rows(_PACKED_ARROW, list(zip(*rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, number = Shingler(), set(), TaskContext.get().partitionId() << 32
        sets, names, held = [], [], 0
        for batch in batches:
            for part in slices(batch, "text", _BATCH_BYTES):
                for tokens in shingler.sets(part.column("text").to_pylist()):
                    name = set_name(tokens)
                    if name is None or name in seen:
                        continue
                    if len(seen) >= 500_000:  # then a class may be sent again, which is found out in the bucket
                        seen.clear()
                    seen.add(name)
                    sets.append(tokens)
                    names.append(name)
                    held += len(tokens)
                    if len(sets) == CHUNK_DOCS or held >= CHUNK_TOKENS:
                        yield pack(number, sets, names)
                        sets, names, held, number = [], [], 0, number + 1
        if sets:
            yield pack(number, sets, names)

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys of a sorted stream, held together one run at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        start = 0
        for i, key in enumerate(rows):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, key
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _count_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bucket: how many classes hold each shingle; sends shingles of two classes or more back to their chunks with that."""
    for group in _groups(batches, ["bucket"]):
        if group.column("bucket")[0].as_py() < 0:
            yield from group.to_batches()
            continue
        rows = group.to_pydict()
        bucket = rows["bucket"][0]
        order = sorted(range(len(rows["chunk"])), key=rows["chunk"].__getitem__)
        places = [np.frombuffer(rows["places"][r], "<u2") for r in order]
        counts = np.concatenate([np.frombuffer(rows["counts"][r], "<u4") for r in order]).astype(np.int64)
        names = np.concatenate([np.frombuffer(rows["names"][r], "<u8") for r in order])
        tokens = np.concatenate([_from_six(rows["tokens"][r]) for r in order])
        starts = np.cumsum(counts) - counts
        # a class that several tasks sent counts once: its first entry in the order of chunks stays
        keep = np.ones(len(counts), bool)
        by_name = np.argsort(names, kind="stable")
        same = np.flatnonzero(names[by_name][1:] == names[by_name][:-1]) + 1
        first_of = {}
        for i in same.tolist():
            entry, before = by_name[i], by_name[i - 1]
            first = first_of.get(before, before)
            a, b = slice(starts[first], starts[first] + counts[first]), slice(starts[entry], starts[entry] + counts[entry])
            if counts[first] == counts[entry] and (tokens[a] == tokens[b]).all():
                keep[entry], first_of[entry] = False, first
        kept = np.repeat(keep, counts)
        _, inverse, spread = np.unique(tokens[kept], return_inverse=True, return_counts=True)
        spread_of = np.zeros(len(tokens), np.int64)
        spread_of[kept] = spread[inverse]
        shared = spread_of > 1
        at = 0
        out = []
        shared_counts = np.add.reduceat(shared.astype(np.int64), starts) if len(starts) else counts
        for r, place in zip(order, places):
            entries = slice(at, at + len(place))
            at += len(place)
            if shared_counts[entries].any():
                run = slice(starts[entries.start], starts[entries.stop - 1] + counts[entries.stop - 1])
                chosen = shared[run]
                there = shared_counts[entries] > 0
                out.append(
                    (rows["chunk"][r], bucket, place[there].tobytes(), shared_counts[entries][there].astype("<u4").tobytes(), b"",
                     _six(tokens[run][chosen]), np.minimum(spread_of[run][chosen], 65535).astype("<u2").tobytes())
                )
        if out:
            yield arrow_rows(_PACKED_ARROW, list(zip(*out)))


def _prefixes(percent: int, bits: int):
    """For each chunk put together again: the shared shingles in each class's prefix under the first order."""
    schema = pa.schema([("token", pa.int64()), ("node", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["chunk"]):
            rows = group.to_pydict()
            head = next(r for r, bucket in enumerate(rows["bucket"]) if bucket < 0)
            sizes = np.frombuffer(rows["counts"][head], "<u4").astype(np.int64)
            names = rows["names"][head]
            others = [r for r in range(len(rows["bucket"])) if r != head]
            if not others:
                continue
            place = np.concatenate(
                [np.repeat(np.frombuffer(rows["places"][r], "<u2"), np.frombuffer(rows["counts"][r], "<u4")) for r in others]
            ).astype(np.int64)
            tokens = np.concatenate([_from_six(rows["tokens"][r]) | np.uint64(rows["bucket"][r] << (64 - bits)) for r in others])
            spread = np.concatenate([np.frombuffer(rows["spread"][r], "<u2") for r in others])
            order = np.lexsort((mix64(tokens ^ _SEEDS[0]), spread, place))
            place, tokens = place[order], tokens[order]
            shared = np.bincount(place, minlength=len(sizes))
            left = np.maximum(0, prefix_length(sizes, percent) - (sizes - shared))
            rank = np.arange(len(place)) - (np.cumsum(shared) - shared)[place]
            chosen = rank < left[place]
            found = place[chosen]
            yield arrow_rows(schema, [pa.array(tokens[chosen].view(np.int64)), [names[16 * i : 16 * i + 16] for i in found.tolist()]])

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest of the classes that share a prefix shingle: each is tied to the first one under its shingle."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    forest, last, first = Forest(), None, b""

    def flush():
        links = forest.links()
        return arrow_rows(schema, [[x[0] for x in links], [x[1] for x in links]])

    for batch in batches:
        for token, node in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if token != last:
                last, first = token, node
            else:
                forest.link(first, node)
        if len(forest) > 500_000:
            yield flush()
            forest = Forest()
    if len(forest):
        yield flush()


def family_links(sets: list[np.ndarray], percent: int = PERCENT, orders: int = ORDERS) -> list[tuple[int, int]]:
    """Links (i, j) that connect exactly what all links among these sets connect.

    The first sets are compared with all others, which connects a group of near copies at once. After that only sets outside the
    largest group look for partners: those that share a prefix shingle under each of the orders, fit in size and belong to another group.
    """
    n = np.array([len(s) for s in sets], np.int64)
    starts = np.cumsum(n) - n
    _, ids, spread = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    mark = np.zeros(len(spread), bool)
    group = np.arange(len(sets))
    links: list[tuple[int, int]] = []

    def tokens_of(i: int) -> np.ndarray:
        return ids[starts[i] : starts[i] + n[i]]

    def compare(i: int, others: np.ndarray) -> None:
        low, high = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
        others = others[(group[others] != group[i]) & (100 * low >= percent * high)]
        if not len(others):
            return
        mark[tokens_of(i)] = True
        counts = n[others]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) + np.repeat(starts[others] - (ends - counts), counts)
        shared = np.add.reduceat(mark[ids[at]].astype(np.int64), ends - counts)
        mark[tokens_of(i)] = False
        for j in others[linked(shared, n[others], n[i], percent)].tolist():
            if group[j] != group[i]:
                links.append((i, j))
                group[group == group[j]] = group[i]

    everyone = np.arange(len(sets))
    for hub in range(min(len(sets), 4)):
        compare(hub, everyone)
    sizes = np.bincount(group, minlength=len(sets))
    if sizes.max() == len(sets):
        return links
    owner = np.repeat(everyone, n)
    prefix, indexes = prefix_length(n, percent), []
    for seed in _SEEDS[:orders]:
        order = np.lexsort((mix64(np.arange(len(spread), dtype=np.uint64) ^ seed)[ids], spread[ids], owner))
        rank = np.arange(len(ids)) - np.repeat(starts, n)
        chosen = (rank < np.repeat(prefix, n)) & (spread[ids[order]] > 1)
        token, holder = ids[order][chosen], owner[order][chosen]
        by_token = np.argsort(token, kind="stable")
        edges = np.searchsorted(token[by_token], np.arange(len(spread) + 1))
        mine = np.searchsorted(holder, np.arange(len(sets) + 1))
        indexes.append((token, holder[by_token], edges, mine))
    largest = sizes.argmax()
    for i in np.flatnonzero(group != largest).tolist():
        others = None
        for token, holders, edges, mine in indexes:
            met = [holders[edges[t] : edges[t + 1]] for t in token[mine[i] : mine[i + 1]].tolist()]
            found = np.unique(np.concatenate(met)) if met else np.empty(0, np.int64)
            others = found if others is None else np.intersect1d(others, found, assume_unique=True)
        if len(others):
            compare(i, others)
    return links


def _verify(percent: int):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for table in _groups(batches, ["family", "i", "j"]):
            nodes, sets = [], []
            for batch in table.to_batches():
                for node, tokens in zip(batch.column("node").to_pylist(), shingler.sets(batch.column("text").to_pylist())):
                    if not nodes or node != nodes[-1]:
                        nodes.append(node)
                        sets.append(tokens)
            links = family_links(sets, percent) if len(sets) > 1 else []
            if links:
                yield arrow_rows(schema, [[nodes[i] for i, _ in links], [nodes[j] for _, j in links]])

    return run


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, node, text) for rows (doc_id, text) whose set is not empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for part in slices(batch, "text", _BATCH_BYTES):
                names = pa.array([set_name(s) for s in shingler.sets(part.column("text").to_pylist())], pa.binary())
                yield arrow_rows(schema, [part.column("doc_id"), names, part.column("text")]).filter(names.is_valid())

    return in_tasks(docs, run, "doc_id bigint, node binary, text string")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id that links lead to, its own included).

    Words are runs of anything but ASCII white space, A-Z lower-cased; shingles are five words, a shorter text is one shingle. Texts link if
    100 * shared >= percent * all. Null and empty texts and those without words have no shingles and no links. Repeated rows are
    linked like any equal texts; a null id counts only where a group has no other. Other columns are ignored; an empty table
    gives no row.

    Texts move once for families; before that only 6 bytes per shingle move, and shingles of one class only do not come back.
    A family of more than FAMILY_BLOCK classes is dealt as pairs of blocks over many tasks.
    """
    texts = two_columns(docs, id_col, text_col)
    rows = stored(document_sets(texts), "sets")
    classes = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes, "classes")

    total = rows.agg(F.sum("n")).first()[0] or 0
    bits = min(30, max(0, (total // BUCKET_TOKENS).bit_length()))
    packed = in_tasks(texts, _chunks(bits), _PACKED).repartition("bucket").sortWithinPartitions("bucket")
    counted = in_tasks(packed, _count_bucket, _PACKED).repartition("chunk").sortWithinPartitions("chunk")
    postings = in_tasks(counted, _prefixes(percent, bits), "token bigint, node binary").repartition("token").sortWithinPartitions("token")
    met = stored(in_tasks(postings, _meet, "a binary, b binary"), "meetings")

    families = connected_components(met, "families").withColumnRenamed("component", "family")
    size = families.groupBy("family").agg(F.ceil(F.count("*") / FAMILY_BLOCK).alias("blocks"))
    members = stored(families.join(size, "family").join(classes, "node").select("node", "family", "blocks", "rep"), "members")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    pair = F.transform(other, lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))
    wanted = _named(texts).join(bounded(members), "node").filter(F.col("doc_id").eqNullSafe(F.col("rep")))
    dealt = wanted.select("family", F.explode(pair).alias("at"), "node", "text").select("family", "at.i", "at.j", "node", "text")
    dealt = dealt.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "node")
    links = stored(in_tasks(dealt, _verify(percent), "a binary, b binary"), "links")

    groups = stored(connected_components(links, "groups").join(classes, "node"), "grouped")
    least = groups.groupBy("component").agg(F.min("rep").alias("least"))
    of_group = groups.join(least, "component").select("node", "least")
    special = classes.filter("copies > 1").select("node", "rep").join(of_group, "node", "full_outer")
    special = stored(special.select("node", F.coalesce("least", "rep").alias("component_id")), "special")
    joined = rows.join(bounded(special), "node", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each group, that with the smallest id, with all columns; documents without links stay, null ids too.

    Repeated rows of one id stay or go together. Null and empty texts stay; an empty table stays empty. Dropped ids are joined as a
    broadcast if a count shows them to be few, else by a shuffle of the documents on their id.
    """
    found = stored(near_duplicates(docs, id_col, text_col, percent), "near-duplicates")
    dropped = bounded(found.filter("doc_id <> component_id").select(F.col("doc_id").alias(f"dropped_{uuid.uuid4().hex}")))
    return docs.join(dropped, docs[id_col].cast("bigint") == F.col(dropped.columns[0]), "left_anti")
