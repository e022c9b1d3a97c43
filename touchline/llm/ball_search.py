"""Exact ranked word search: sparse ball trees over document vectors, searched best-first for the largest inner products.

A document is a vector over the terms that items ask for, an item a vector of term weights; both hold whole numbers, and the score
is their inner product. Tasks build a balanced tree over every few thousand documents. A ball has a whole-number centre and a radius
for each group of terms, so a document inside scores at most item · centre + sum over groups of |item| · radius. Radii and norms
are rounded up, sums of whole numbers below 2^53 are exact in doubles, and bounds are rounded to the next whole number that no score
inside can pass. The most promising subtree is opened first; one whose bound cannot enter the best k is closed unopened.
Groups make the bound close: rare terms that one item asks for are a group, and each term that many documents hold is one by itself.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import arrow_rows, in_tasks, slices, stored

SLICE_BYTES = 4 << 20
ITEMS_AT_ONCE, TERMS_AT_ONCE = 4096, 16_384
BLOCK_DOCS, BLOCK_ENTRIES, LEAF_DOCS = 8192, 2_000_000, 16
COMMON = 0.02  # of the documents hold a term that is a group by itself
CENTRE_CELLS, RADIUS_CELLS = 4 << 20, 1 << 20  # of the centres of one level of a tree, of the distances at hand at once
_LAST = (1 << 63) - 1
_CLASSES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of digits, letters and bytes of non-ASCII characters; only A-Z are lower-cased."""
    return text.translate(_CLASSES).split()


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).fill_null("").cast(pa.large_binary()).to_pylist()


def _item_terms(items: DataFrame) -> DataFrame:
    """The distinct terms of each item id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("item_id", pa.int64()), ("term", pa.binary())])
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                for item, text in zip(part.column(0).to_pylist(), _texts(part, 1)):
                    found = sorted(set(terms(text)))
                    yield arrow_rows(schema, [[item] * len(found), found])

    return in_tasks(items, run, "item_id bigint, term binary").distinct()


def _item_blocks(pairs: DataFrame) -> Iterator[dict[int | None, list[bytes]]]:
    """Items with their terms, so many at once that their number and that of their different terms stay bounded; an item stays whole."""
    block, known, item, own = {}, set(), None, []
    for row in pairs.orderBy("item_id", "term").toLocalIterator():
        if own and row[0] != item:
            block[item], own = own, []
            known.update(block[item])
            if len(block) >= ITEMS_AT_ONCE or len(known) >= TERMS_AT_ONCE:
                yield block
                block, known = {}, set()
        item = row[0]
        own.append(bytes(row[1]))
    if own:
        block[item] = own
    if block:
        yield block


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Documents with at least one term: doc_id, n (all terms with repeats), and the numbers and counts of terms of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]
        schema, known = pa.schema(kinds), vocabulary.keys()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, sizes, numbers, counts = [], [], [], []
                for doc_id, text in zip(part.column(0).to_pylist(), _texts(part, 1)):
                    if found := terms(text):
                        held = Counter(found)
                        asked = sorted((vocabulary[t], held[t]) for t in known & held.keys())
                        ids.append(doc_id)
                        sizes.append(len(found))
                        numbers.append([t for t, _ in asked])
                        counts.append([c for _, c in asked])
                yield arrow_rows(schema, [ids, sizes, numbers, counts])

    return in_tasks(docs, run, "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def term_groups(asked: list[np.ndarray], holding: dict[int, int], documents: int, vocabulary: int) -> np.ndarray:
    """The group of each term: its own if it is common, else that of the first item that asks for it."""
    group, groups = np.full(vocabulary, -1), 0
    for own in asked:
        rare = [t for t in own.tolist() if group[t] < 0 and holding.get(t, 0) <= COMMON * documents]
        if rare:
            group[rare] = groups
            groups += 1
    alone = np.flatnonzero(group < 0)
    group[alone] = groups + np.arange(len(alone))
    return group


def _spread(starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of the chosen rows in that order, and where each row starts among them."""
    lengths = np.diff(starts)[chosen]
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[:-1][chosen] - (ends - lengths), lengths), np.concatenate([[0], ends])


class BallTree:
    """A balanced tree over documents given as rows of sparse whole numbers; two levels of it are kept, half-way down and the leaves."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, group: np.ndarray):
        n, vocabulary, self.group = len(ids), len(group), group
        depth = max(0, math.ceil(math.log2(max(1, n / LEAF_DOCS))))
        self.depth = min(depth, max(0, math.floor(math.log2(max(1, CENTRE_CELLS / max(1, vocabulary))))))
        row, node = np.repeat(np.arange(n), np.diff(starts)), np.zeros(n, np.int64)
        for level in range(self.depth):
            node = self._halved(node, 1 << level, row, terms, values, vocabulary)
        order = np.lexsort((ids, node))
        entries, self.starts = _spread(starts, order)
        self.ids, self.terms, self.values = ids[order], terms[entries], values[entries]
        leaf, row = node[order], np.repeat(np.arange(n), np.diff(self.starts))
        self.half = self.depth // 2
        self.levels = [self._balls(leaf >> (self.depth - at), 1 << at, row, vocabulary) for at in (self.half, self.depth)]

    @staticmethod
    def _halved(node: np.ndarray, nodes: int, row: np.ndarray, terms: np.ndarray, values: np.ndarray, vocabulary: int) -> np.ndarray:
        """Every node's documents in two halves, along the line from its mean to the document furthest from that."""
        size, cell = np.bincount(node, minlength=nodes), node[row] * vocabulary + terms
        mean = np.bincount(cell, values, nodes * vocabulary) / np.repeat(np.maximum(size, 1), vocabulary)
        far = np.bincount(row, values * (values - 2 * mean[cell]), len(node))
        ends = np.cumsum(size)
        furthest = np.lexsort((far, node))[ends[size > 0] - 1]
        pivots = np.zeros(len(node), bool)
        pivots[furthest] = True
        chosen = pivots[row]
        line = -mean
        line[cell[chosen]] += values[chosen]
        along = np.bincount(row, values * line[cell], len(node))
        order = np.lexsort((along, node))
        rank = np.empty(len(node), np.int64)
        rank[order] = np.arange(len(node)) - np.repeat(ends - size, size)
        return 2 * node + (rank >= (size[node] + 1) // 2)

    def _balls(self, node: np.ndarray, nodes: int, row: np.ndarray, vocabulary: int):
        """Per node: the documents' range, smallest id, centre, and a radius per group of terms that no document inside exceeds."""
        size, cell = np.bincount(node, minlength=nodes), node[row] * vocabulary + self.terms
        ends = np.cumsum(size)
        sums = np.bincount(cell, self.values, nodes * vocabulary)
        centre = np.rint(sums / np.repeat(np.maximum(size, 1), vocabulary))
        groups = int(self.group.max()) + 1
        own = np.bincount((np.arange(nodes)[:, None] * groups + self.group[None, :]).ravel(), centre**2, nodes * groups).reshape(nodes, groups)
        radius, step = np.zeros((nodes, groups)), max(1, RADIUS_CELLS // groups)
        for first in range(0, len(node), step):
            docs, cut = node[first : first + step], slice(self.starts[first], self.starts[min(first + step, len(node))])
            spot, values = (row[cut] - first) * groups + self.group[self.terms[cut]], self.values[cut]
            apart = np.bincount(spot, values * (values - 2 * centre[cell[cut]]), len(docs) * groups).reshape(-1, groups)
            square = np.maximum(apart + own[docs], 0)
            weighed = np.bincount(spot, values.astype(np.float64) ** 2, len(docs) * groups).reshape(-1, groups) + own[docs]
            square += np.where(weighed >= 2.0**52, 1e-12 * weighed, 0)  # beyond that, sums of whole numbers are rounded
            begins = np.flatnonzero(np.diff(docs, prepend=-1))
            radius[docs[begins]] = np.maximum(radius[docs[begins]], np.maximum.reduceat(square, begins))
        smallest = np.full(nodes, _LAST)
        full = np.flatnonzero(size)
        if len(full):
            smallest[full] = np.minimum.reduceat(self.ids, (ends - size)[full])
        return ends - size, ends, smallest, centre.reshape(nodes, vocabulary), np.nextafter(np.sqrt(radius), np.inf) * (radius > 0)

    def search(self, wanted: np.ndarray, weights: np.ndarray, best: list[tuple], k: int) -> int:
        """Puts documents that belong there into best, a heap of (score, -id, null id); returns how many were scored."""
        asked, place = np.unique(self.group[wanted], return_inverse=True)
        norms = np.nextafter(np.sqrt(np.bincount(place, weights.astype(np.float64) ** 2)), np.inf)
        dense = np.zeros(len(self.group), np.int64)
        dense[wanted] = weights

        def bounds(level: int, nodes: slice) -> np.ndarray:
            _, _, _, centre, radius = self.levels[level]
            slack = (radius[nodes][:, asked] @ norms) * (1 + 1e-9)
            return np.floor(centre[nodes][:, wanted] @ weights * (1 + 1e-12 * (slack > 0)) + slack + 0.5)

        def opened(level: int, nodes: slice, least: int) -> None:
            bound, smallest = bounds(level, nodes), self.levels[level][2][nodes]
            for i in np.flatnonzero(bound >= max(least, 1)).tolist():
                heapq.heappush(queue, (-bound[i], smallest[i], level, nodes.start + i))

        queue, scored = [], 0
        opened(0, slice(0, 1 << self.half), best[0][0] if len(best) == k else 0)
        while queue:
            bound, smallest, level, at = heapq.heappop(queue)
            least, least_id = (best[0][0], -best[0][1]) if len(best) == k else (0, -math.inf)
            if -bound < least:
                break
            if -bound == least and smallest > least_id:
                continue
            if level == 0:
                fan = self.depth - self.half
                opened(1, slice(at << fan, (at + 1) << fan), least)
                continue
            start, end = self.levels[1][0][at], self.levels[1][1][at]
            if start == end:
                continue
            from_, to = self.starts[start], self.starts[end]
            products = np.concatenate([[0], np.cumsum(dense[self.terms[from_:to]] * self.values[from_:to])])
            scores = products[self.starts[start + 1 : end + 1] - from_] - products[self.starts[start:end] - from_]
            scored += len(scores)
            for i in np.flatnonzero(scores >= max(least, 1)).tolist():
                doc_id = int(self.ids[start + i])
                entry = (int(scores[i]), -doc_id)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return scored


def _searched(vectors: DataFrame, items: dict, holding: dict[int, int], vocabulary: dict[bytes, int], documents: int, length: int, k: int) -> DataFrame:
    """The best k documents of each item among those of a task, the null id as the largest number."""
    weights = {t: weight(documents, n) for t, n in holding.items()}
    asked = [(item, np.array([vocabulary[t] for t in own if vocabulary[t] in weights], np.int64)) for item, own in items.items()]
    asked = [(item, own, np.array([weights[t] for t in own.tolist()], np.int64)) for item, own in asked if len(own)]
    group = term_groups([own for _, own, _ in asked], holding, documents, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
        best = [[] for _ in asked]

        def look(parts: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(parts)
            ids = rows["doc_id"].combine_chunks().fill_null(_LAST).to_numpy()
            m = np.array([10 + 90 * n * documents // length for n in rows["n"].to_pylist()], np.int64)
            lists, counts = rows["terms"].combine_chunks(), rows["counts"].combine_chunks()
            lengths = lists.value_lengths().to_numpy()
            tf, starts = counts.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])
            values = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, lengths))
            tree = BallTree(ids, starts, lists.flatten().to_numpy().astype(np.int64), values, group)
            for (_, own, own_weights), heap in zip(asked, best):
                tree.search(own, own_weights, heap, k)

        waiting, docs, entries = [], 0, 0
        for batch in batches:
            ends = np.cumsum(batch.column(2).value_lengths().to_numpy())
            start = 0
            while start < batch.num_rows:  # as many rows as still fit into the block, one at least
                done = int(ends[start - 1]) if start else 0
                fit = int(np.searchsorted(ends, done + BLOCK_ENTRIES - entries, "right")) - start
                take = max(min(fit, BLOCK_DOCS - docs, batch.num_rows - start), 0 if docs else 1)
                if take:
                    waiting.append(batch.slice(start, take))
                    start += take
                    docs += take
                    entries += int(ends[start - 1]) - done
                if docs and (not take or docs >= BLOCK_DOCS or entries >= BLOCK_ENTRIES):
                    look(waiting)
                    waiting, docs, entries = [], 0, 0
        if waiting:
            look(waiting)
        for (item, _, _), heap in zip(asked, best):
            ids = [-i for _, i in heap]
            yield arrow_rows(schema, [[item] * len(heap), [None if i == _LAST else i for i in ids], [s for s, _ in heap]])

    return in_tasks(vectors, run, "item_id bigint, doc_id bigint, score bigint")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """item_id, rank, doc_id, score: for each item the k documents of highest score above 0, equal scores by ascending id.

    Terms are runs of digits, letters and non-ASCII characters, A-Z lower-cased. With N documents that hold a term, L terms in all of
    them, n in one: a term in df documents weighs w = floor(1000 ln((2N + 2) / (2df + 1))), m = 10 + 90nN div L, and the score sums
    w * (10^9 tf div (1000 tf + 8m)) over the item's different terms. Statistics are of all documents.
    Null and blank texts have no terms and are never found. Rows of one item id are one item with the terms of all; a null item id
    is an id of its own. A document without id ranks after equal scores and comes out with a null id (as would the id 2^63 - 1).
    Repeated rows are ranked one by one. Empty tables give no rows. Other columns are ignored.
    Items go to the tasks in blocks of at most 4,096 or about 16,384 different terms, each block in passes of its own over the
    documents; a task holds one tree of at most 8,192 documents at a time.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    wanted = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    found = None
    for block in _item_blocks(stored(_item_terms(wanted), "item-terms")):
        vocabulary = {t: i for i, t in enumerate(sorted({t for own in block.values() for t in own}))}
        vectors = stored(_counted(rows, vocabulary), "term-counts")
        documents, length = vectors.agg(F.count("*"), F.sum("n")).first()
        holding = dict(vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator())  # at most the block's terms
        block_found = stored(_searched(vectors, block, holding, vocabulary, documents, length, k), "found")
        found = block_found if found is None else found.unionByName(block_found)
    if found is None:
        kinds = [T.StructField(c, T.LongType()) for c in ("item_id", "doc_id", "score")]
        found = docs.sparkSession.createDataFrame([], T.StructType(kinds))
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
