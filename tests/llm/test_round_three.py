"""Fill-in-the-middle, ranked word search and exact top-k inner products against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import rows
from touchline.llm import ball_search, fill_middle, vector_topk
from touchline.session import session_conf

TEXTS = [(r[0], r[1]) for r in rows()]


def draws(doc_id, seed=1):
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def cut_by_hand(doc_id, text):
    text, (h1, h2, h3, h4) = text or "", draws(doc_id)
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(text), "plain", None, None, None, None, text
    lengths = (len(prefix), len(middle), len(prefix.encode()), len(middle.encode()))
    if h4 % 100 < 20:
        return len(text), "spm", *lengths, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(text), "psm", *lengths, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_wide_characters():
    r = random.Random(5)
    for _ in range(50):
        text = "".join(r.choice("aé中😀 ") for _ in range(r.randint(0, 60)))
        wide = fill_middle.WideCharacters.of(np.frombuffer(text.encode(), np.uint8))
        starts = np.array([len(text[:i].encode()) for i in range(len(text) + 1)])
        assert len(wide.at) == sum(c > "\x7f" for c in text)
        assert wide.to_bytes(np.arange(len(text) + 1)).tolist() == starts.tolist()
        assert wide.to_points(starts).tolist() == list(range(len(text) + 1))


def test_fill_middle(spark, docs, empty):
    def check(frame, texts):
        found = frame.withColumn("back", fill_middle.restored(frame["form"], frame["output"])).collect()
        got = Counter(tuple(r) for r in found)
        assert got == Counter((i, *cut_by_hand(i, t), t or "") for i, t in texts)

    check(fill_middle.fill_middle(docs), TEXTS)
    r = random.Random(3)
    made = [(i, "".join(r.choice(["<", "S", ">", "P", "M", "é", "😀", "<S", "word ", "\n"]) for _ in range(r.randint(0, 12)))) for i in range(400)]
    check(fill_middle.fill_middle(spark.createDataFrame(made, "doc_id bigint, text string")), made)
    assert {cut_by_hand(*x)[1] for x in made} == {"plain", "psm", "spm"}
    check(fill_middle.fill_middle(spark.createDataFrame([(-4, "x" * 5_000_000 + "é" * 1_000_000), (4, "y")], "doc_id bigint, text string")), [(-4, "x" * 5_000_000 + "é" * 1_000_000), (4, "y")])
    assert fill_middle.fill_middle(empty).count() == 0
    assert set(f["form"] for f in fill_middle.fill_middle(docs, move_percent=0).collect()) == {"plain"}


def ranked_by_hand(texts, items, k=10):
    def terms(text):
        lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    docs = [(i, Counter(w)) for i, w in ((i, terms(t)) for i, t in texts) if w]
    number, length, df = len(docs), sum(c.total() for _, c in docs), Counter(t for _, c in docs for t in c)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        scores = []
        for i, c in docs:
            m = 10 + 90 * c.total() * number // length
            score = sum(math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("leaf, block, once", [(64, 8192, 4096), (2, 7, 2), (1, 60, 1)])
def test_ranked_search(spark, docs, empty, monkeypatch, leaf, block, once):
    monkeypatch.setattr(ball_search, "LEAF_DOCS", leaf)
    monkeypatch.setattr(ball_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(ball_search, "ITEMS_AT_ONCE", once)
    r = random.Random(7)
    words = [f"w{i}" for i in range(30)] + ["É", "x1"]
    made = TEXTS + [(100 + i, " ".join(r.choice(words) for _ in range(r.randint(1, 40)))) for i in range(150)] + [(300 + i, "w1 w2 W3, same") for i in range(40)]
    items = [(1, "w1 w2 w3 same"), (2, "licensed under the apache license"), (3, None), (4, ""), (1, "more; w9"), (None, "one two"), (6, "É x1 w30 absent"), (7, "abcdeé")]
    frame = spark.createDataFrame(made, "doc_id bigint, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    found = ball_search.ranked_search(frame, asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(x) for x in found.collect()), key=str) == ranked_by_hand(made, items)
    if block == 8192:
        alone = ball_search.ranked_search(docs, asked.withColumn("doc_id", asked["item_id"]), k=3)
        assert sorted((tuple(x) for x in alone.collect()), key=str) == ranked_by_hand(TEXTS, items, 3)
        assert ball_search.ranked_search(empty, asked).count() == 0
        assert ball_search.ranked_search(docs, asked.filter("false")).count() == 0
        assert ball_search.ranked_search(docs.filter("doc_id between 4 and 6"), asked).count() == 0


def test_ball_bounds_hold_and_close_subtrees(monkeypatch):
    monkeypatch.setattr(ball_search, "LEAF_DOCS", 4)
    r, size = np.random.default_rng(2), 120
    group = ball_search.term_groups([np.arange(0, 50), np.arange(40, 100)], {t: 1 for t in range(110)} | {3: 500, 45: 500}, 600, size)
    assert group[[0, 1, 49]].tolist() == [0, 0, 0] and group[50] == group[99] == 1 and len(set(group[[3, 45, 100, 101, 119]])) == 5
    topics = [np.sort(r.choice(size, 12, replace=False)) for _ in range(16)]
    lists = [np.sort(r.choice(topics[i % 16], 8, replace=False)) for i in range(600)]
    values = [r.integers(1, 900_000, 8) for _ in lists]
    tree = ball_search.BallTree(np.arange(600), np.arange(601) * 8, np.concatenate(lists), np.concatenate(values), group)
    dense = np.zeros((600, size), np.int64)
    for i in range(600):
        dense[i, lists[i]] = values[i]
    assert sorted(tree.ids.tolist()) == list(range(600))
    for starts, ends, smallest, centre, radius in tree.levels:
        for node in range(len(starts)):
            inside = tree.ids[starts[node] : ends[node]]
            assert smallest[node] == inside.min()
            apart = (dense[inside] - centre[node]) ** 2
            for g in range(radius.shape[1]):
                assert radius[node, g] ** 2 >= apart[:, group == g].sum(axis=1).max()
    scored = 0
    for topic in topics:
        weights, best = r.integers(1, 9000, 12), []
        scored += tree.search(topic, weights, best, 5)
        truth = dense[:, topic] @ weights
        assert sorted(best, reverse=True) == [(int(truth[i]), -int(i)) for i in np.lexsort((np.arange(600), -truth))[:5]]
    assert scored < 16 * 600 / 3
    same, best = ball_search.BallTree(np.arange(600)[::-1].copy(), np.arange(601) * 2, np.tile([3, 5], 600), np.tile([7, 11], 600), group), []
    assert same.search(np.array([3, 5]), np.array([2, 3]), best, 10) < 40
    assert sorted(-i for _, i in best) == list(range(10)) and {s for s, _ in best} == {47}


def nearest_by_hand(vectors, every, k):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * x) for x in v]

    kept = [(i, v, whole(v)) for i, v in vectors if whole(v) is not None]
    queries = {}
    for i, raw, v in kept:
        if i is not None and i % every == 0 and (i not in queries or raw > queries[i][0]):
            queries[i] = raw, v
    out = []
    for q, (_, own) in queries.items():
        scores = [(-sum(a * b for a, b in zip(own, v)), i is None, i or 0) for i, _, v in kept if i != q]
        out += [(q, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("slices, block", [(2, 16 << 20), (1, 300), (3, 1), (5, 16 << 20)])
def test_vector_topk(spark, monkeypatch, slices, block):
    monkeypatch.setattr(vector_topk, "QUERY_BYTES", block)
    monkeypatch.setattr(vector_topk, "ROWS", 50)
    monkeypatch.setattr(vector_topk, "QUERIES", 4)
    r = random.Random(1)
    vectors = [(i, [r.gauss(0, 0.3) for _ in range(6)]) for i in range(1, 160)]
    vectors += [(200 + i, vectors[39][1]) for i in range(60)]  # a group of equal vectors, queries among them
    vectors += [(400, None), (420, [1.0, None]), (440, [float("nan"), 1.0]), (460, [float("inf")]), (480, []), (500, [0.5]), (520, [0.1] * 9)]
    vectors += [(None, vectors[39][1]), (20, [0.9, 0.1]), (20, [0.9, 0.1]), (21, vectors[20][1]), (540, [3e9, -2e9, 1e10]), (541, [2e9, 1.0])]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS score", "2 AS vector").repartition(4)
    found = vector_topk.top_inner_products(frame, every=20, k=7, slices=slices)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    limit = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    want = [(q, rank, i, limit(s)) for q, rank, i, s in nearest_by_hand(vectors, 20, 7)]
    assert sorted((tuple(x) for x in found.collect()), key=str) == want
    if slices == 2:
        assert vector_topk.top_inner_products(frame.filter("false")).count() == 0
        assert vector_topk.top_inner_products(frame.filter("vec_id = 540"), every=20).count() == 0
        floats = frame.filter("vec_id < 200").selectExpr("vec_id", "cast(embedding AS array<float>) AS embedding")
        rows = [(x[0], x[1]) for x in floats.collect()]
        assert sorted((tuple(x) for x in vector_topk.top_inner_products(floats, 20, 7).collect()), key=str) == nearest_by_hand(rows, 20, 7)


def test_vector_topk_with_queries_in_many_files(spark):
    r = random.Random(4)
    vectors = [(i, [r.gauss(0, 1) for _ in range(3)]) for i in range(0, 300)]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(40)
    with session_conf(spark, spark__sql__shuffle__partitions="23", spark__sql__adaptive__coalescePartitions__enabled="false"):
        found = sorted((tuple(x) for x in vector_topk.top_inner_products(frame, 3, 4).collect()), key=str)
    assert found == nearest_by_hand(vectors, 3, 4)
