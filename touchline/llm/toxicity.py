"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, found with a block-max inverted index.

Features are lower-cased words and their first letters, so that inflected forms meet. The features kept are those that tell the labels
of a bounded sample of labelled texts apart; how many documents hold each of them is counted over the whole corpus. The examples of
the sample stand in blocks; per feature and block the largest weight is known, so blocks whose bound cannot reach the
neighbours found so far are skipped without losing one. Neighbours vote with their cosine, and an isotonic fit on the sample, each
example left out in turn, makes the vote a probability.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import arrow_rows, in_tasks, stored

SAMPLE = 8000
FEATURES = 1000
LEAST_G = 20.0
NEIGHBOURS = 25
BLOCK = 64
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»¿¡„“”…"


def features_of(chunk: str) -> list[str]:
    """A piece between spaces gives its word, marked as whole, and the word's first letters."""
    word = chunk.strip(SIGNS)
    return [f"{word}$", *(word[:n] for n in PREFIXES if len(word) >= n)] if word else []


class _Known(dict):
    """Piece to the numbers of its kept features; most pieces have none."""

    def __init__(self, vocabulary: dict[str, int], limit: int = 300_000):
        self._vocabulary, self._limit = vocabulary, limit

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        if len(self) >= self._limit:
            self.clear()
        found = tuple(n for n in map(self._vocabulary.get, features_of(chunk)) if n is not None)
        self[chunk] = found
        return found


def term_counts(text: str | None, known: _Known) -> Counter:
    """How often each kept feature stands in the whole text."""
    out: Counter = Counter()
    for found in filter(None, map(known.__getitem__, (text or "").lower().split())):
        out.update(found)
    return out


@dataclass
class BlockMaxIndex:
    """Examples in blocks, each with its postings (feature, place, weight) and, per feature, the largest weight."""

    width: int
    ids: np.ndarray
    toxic: np.ndarray
    postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    most: np.ndarray

    @classmethod
    def build(cls, vectors: list[tuple[np.ndarray, np.ndarray]], ids: list[int], toxic: list[int], width: int) -> BlockMaxIndex:
        """vectors: (feature numbers, weights) per example. Examples whose heaviest features agree share a block."""
        order = sorted(range(len(vectors)), key=lambda i: (vectors[i][0][np.argsort(-vectors[i][1], kind="stable")].tolist(), ids[i]))
        blocks = [order[a : a + BLOCK] for a in range(0, len(order), BLOCK)]
        most, postings = np.zeros((len(blocks), width)), []
        for b, block in enumerate(blocks):
            features = np.concatenate([vectors[i][0] for i in block]).astype(np.int64)
            weights = np.concatenate([vectors[i][1] for i in block]).astype(np.float64)
            places = np.repeat(np.arange(len(block)), [len(vectors[i][0]) for i in block])
            np.maximum.at(most[b], features, weights)
            postings.append((features, places, weights))
        return cls(width, np.array([ids[i] for i in order], np.int64), np.array([toxic[i] for i in order], np.int64), postings, most.T.copy())

    def nearest(self, features: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples with a cosine above 0; ties go to the smaller id."""
        bound = weights @ self.most[features] + 1e-9
        query = np.zeros(self.width)
        query[features] = weights
        places, cosines = np.empty(0, np.int64), np.empty(0)
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 1e-9 or len(cosines) >= k and bound[b] < cosines[-1]:
                break
            f, at, w = self.postings[b]
            scores = np.bincount(at, weights=w * query[f])
            good = np.flatnonzero(scores > 0)
            good = good[b * BLOCK + good != without]
            places, cosines = np.r_[places, b * BLOCK + good], np.r_[cosines, scores[good]]
            keep = np.lexsort((self.ids[places], -np.round(cosines, 12)))[:k]
            places, cosines = places[keep], cosines[keep]
        return places, cosines


@dataclass
class ToxicityModel:
    vocabulary: dict[str, int]
    idf: np.ndarray
    index: BlockMaxIndex
    prior: float
    without_features: float
    steps: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.array([0.0, 1.0]), np.array([0.0, 1.0])))

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        features = np.array(sorted(counts), np.int64)
        weights = np.array([1 + math.log(counts[f]) for f in features.tolist()]) * self.idf[features]
        return features, weights / np.sqrt((weights**2).sum()) if len(weights) else weights

    def vote(self, counts: dict[int, int], without: int = -1) -> tuple[float, np.ndarray]:
        """Share of toxic weight among the neighbours, drawn to the prior by one neighbour's worth, and the neighbours' places."""
        if not counts:
            return self.without_features, np.empty(0, np.int64)
        places, cosines = self.index.nearest(*self.vector(counts), NEIGHBOURS, without)
        weight = cosines**2
        return float((weight @ self.index.toxic[places] + self.prior * 0.5) / (weight.sum() + 0.5)), places

    def calibrated(self, vote: float) -> float:
        """The isotonic value, with a hundredth of the vote itself so that higher votes stay higher."""
        return float(0.99 * np.interp(vote, *self.steps) + 0.01 * vote)


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps closest to the labels (neighbouring groups that fall are pooled), as points to interpolate between."""
    pools: list[list[float]] = []
    for value in np.unique(votes).tolist():
        same = labels[votes == value]
        pools.append([float(same.sum()), float(len(same)), value * len(same)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    x = np.array([p[2] / p[1] for p in pools])
    # Half a case of each kind is added, so that no group of examples counts as certain.
    y = np.array([(p[0] + 0.25) / (p[1] + 0.5) for p in pools])
    return x, np.maximum.accumulate(y)


def learnable(id_col: Column) -> Column:
    """Rows whose labels may be learnt: crc32 of the id as text leaves a remainder other than 1 by 3."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3 != 1


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """Fit on at most `sample` labelled texts (those whose id hashes lowest, equal texts once); the feature counts are over all docs.

    Labels other than 0 and 1, labels of absent documents and null ids are left out. An id with both labels counts as toxic; of equal
    texts (null and empty are equal) the one with the smallest id gives the label. The sample is stored once. Without any usable label every score is 0.5
    times one half. The driver receives the kept features (at most FEATURES) and, per example, its few kept features.
    """
    usable = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("toxic")).filter(
        F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & learnable(F.col("id"))
    )
    chosen = usable.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    sampled = texts.join(F.broadcast(chosen), "id").groupBy(F.coalesce("text", F.lit("")).alias("text"))
    examples = stored(sampled.agg(F.min(F.struct("id", "toxic")).alias("first")).select("first.id", "first.toxic", "text"), "examples")

    def candidates(batches):
        counts: dict[str, list[int]] = {}
        totals = [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                totals[toxic] += 1
                for f in {f for c in set((text or "").lower().split()) for f in features_of(c)}:
                    counts.setdefault(f, [0, 0])[toxic] += 1
        counts[""] = totals
        rows = list(counts.items())
        for a in range(0, len(rows), 20_000):
            some = rows[a : a + 20_000]
            yield arrow_rows(schema, [[r[0] for r in some], [r[1][0] for r in some], [r[1][1] for r in some]])

    schema = pa.schema([("feature", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())])
    found = in_tasks(examples.select("text", "toxic"), candidates, "feature string, clean bigint, toxic bigint").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    totals = examples.groupBy().agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")).first()
    clean, toxic = int(totals["clean"] or 0), int(totals["toxic"] or 0)
    prior = (toxic + 0.5) / (clean + toxic + 1)
    if not clean or not toxic:
        return ToxicityModel({}, np.empty(0), BlockMaxIndex.build([], [], [], 0), prior, prior)
    part = lambda seen, share: F.when(seen > 0, seen * F.log(seen / share)).otherwise(0.0)
    rate = (F.col("clean") + F.col("toxic")) / F.lit(float(clean + toxic))
    g = 2 * (
        part(F.col("toxic"), rate * toxic) + part(toxic - F.col("toxic"), (1 - rate) * toxic)
        + part(F.col("clean"), rate * clean) + part(clean - F.col("clean"), (1 - rate) * clean)
    )
    best = found.filter("feature <> ''").withColumn("g", g).filter(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "feature").limit(FEATURES)
    vocabulary = {r["feature"]: i for i, r in enumerate(best.select("feature").collect())}
    width = len(vocabulary)

    def holders(batches):
        known, counts, total = _Known(vocabulary), np.zeros(width, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += 1
                if there := term_counts(text, known):
                    counts[list(there)] += 1
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(width)], pa.int32()), pa.array([total, *counts.tolist()], pa.int64())], names=["feature", "n"])

    held = {r["feature"]: r["n"] for r in in_tasks(texts.select("text"), holders, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    idf = np.array([math.log((1 + held.get(-1, 0)) / (1 + held.get(i, 0))) + 1 for i in range(width)])

    def sparse(batches):
        known = _Known(vocabulary)
        for batch in batches:
            counts = [term_counts(t, known) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("toxic"), pa.array([list(c) for c in counts], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in counts], pa.list_(pa.int32()))], names=["id", "toxic", "features", "counts"],
            )

    kept = in_tasks(examples.select("id", "toxic", "text"), sparse, "id bigint, toxic int, features array<int>, counts array<int>").collect()
    kept.sort(key=lambda r: (r["id"], sorted(zip(r["features"], r["counts"]))))  # an id may have several texts
    bags = [dict(zip(r["features"], r["counts"])) for r in kept]
    model = ToxicityModel(vocabulary, idf, BlockMaxIndex.build([], [], [], width), prior, prior)
    full = [i for i, bag in enumerate(bags) if bag]
    bare = [r["toxic"] for r, bag in zip(kept, bags) if not bag]
    model.without_features = (sum(bare) + prior) / (len(bare) + 1)
    model.index = BlockMaxIndex.build([model.vector(bags[i]) for i in full], [kept[i]["id"] for i in full], [kept[i]["toxic"] for i in full], width)
    place = {example: p for p, example in enumerate(model.index.ids.tolist())}
    votes = np.array([model.vote(bag, place.get(r["id"], -1))[0] for r, bag in zip(kept, bags)])
    model.steps = isotonic(votes, np.array([r["toxic"] for r in kept], float))
    return model


def toxicity_of(text: Column, model: ToxicityModel) -> Column:
    """A struct per text: score (0 to 1), neighbours (ids of all examples that voted, nearest first) and matched (kept features held)."""
    kind = "score double, neighbours array<bigint>, matched array<string>"
    names = list(model.vocabulary)

    @F.arrow_udf(f"struct<{kind}>")
    def score(texts: pa.Array) -> pa.Array:
        known = _Known(model.vocabulary)
        scores, neighbours, matched = [], [], []
        for t in texts:
            counts = term_counts(t.as_py(), known)
            vote, places = model.vote(counts)
            scores.append(model.calibrated(vote))
            neighbours.append(model.index.ids[places].tolist())
            matched.append([names[f] for f in sorted(counts)][:5])
        return pa.StructArray.from_arrays(
            [pa.array(scores, pa.float64()), pa.array(neighbours, pa.list_(pa.int64())), pa.array(matched, pa.list_(pa.string()))],
            names=["score", "neighbours", "matched"],
        )

    return score(text.cast("string"))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, and as evidence neighbours and matched.

    A null or empty text has no features and gets the score of examples without any. Repeated rows get equal scores, null ids count as
    held out of nothing (false). Other columns are ignored; an empty table gives no row.
    """
    scored = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), toxicity_of(F.col(text_col), model).alias("t"))
    return scored.select(
        "doc_id",
        F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("t.score").alias("score"),
        (F.col("t.score") >= threshold).cast("int").alias("predicted"),
        F.col("t.neighbours").alias("neighbours"),
        F.col("t.matched").alias("matched"),
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns.

    Null and empty texts have the score of examples without features; repeated rows stay or go together; an empty table stays empty.
    """
    return docs.filter(toxicity_of(F.col(text_col), model)["score"] < threshold)
