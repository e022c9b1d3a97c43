"""Every operator on a table of awkward rows and on an empty one, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import rows
from touchline.llm import exact_dedup, jaccard_join, license_scan, line_dedup, order_minhash, packing, pieces, shards, token_blocks, toxicity
from touchline.llm.components import Forest, connected_components

TEXTS = [(r[0], r[1]) for r in rows()]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_doc(found):
    out = defaultdict(list)
    for r in found:
        out[r["doc_id"]].append(r)
    return out


def test_order_minhash(docs, empty):
    order = sorted(TEXTS, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for parts in (1, 4):
        found = by_doc(order_minhash.edit_fingerprints(docs, parts=parts).collect())
        assert sum(map(len, found.values())) == len(TEXTS)
        for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1]):
            new = order_minhash.edited(text or "", after or "")
            hits = [r for r in found[doc_id] if r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()]
            assert hits, doc_id
            own = order_minhash.fingerprint(text or "")
            assert hits[0]["n_chars"] == len(text or "") and hits[0]["fingerprint"] == order_minhash.as_hex(own)
            assert hits[0]["near_next"] == order_minhash.likeness(own, order_minhash.fingerprint(after or ""))
    assert order_minhash.edit_fingerprints(empty).count() == 0
    alone = order_minhash.edit_fingerprints(docs.filter("doc_id = 7")).first()
    assert alone["near_next"] == 1 and alone["edited_sha256"] == hashlib.sha256(b"one one").hexdigest()


def test_token_blocks(spark, docs, empty, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    token_blocks.write_token_blocks(docs, str(tmp_path / "a"), path, 2, segment_ids=1000)
    found = sorted(token_blocks.read_token_blocks(spark, str(tmp_path / "a")).collect(), key=lambda r: r["start"])
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (doc_id, text) in zip(found, order, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    token_blocks.write_token_blocks(empty, str(tmp_path / "b"), path, 2)
    assert token_blocks.read_token_blocks(spark, str(tmp_path / "b")).count() == 0


def test_shards(docs, empty):
    found = shards.shard_documents(docs, 4).collect()
    assert len(found) == len(TEXTS) and {r["law"] for r in found} == {"bytes"}
    sizes, first = Counter(), {}
    for doc_id, text in TEXTS:
        sizes[text or ""] += len((text or "").encode()) + 1
        key = (doc_id is not None, doc_id or 0)
        first[text or ""] = min(first.get(text or "", key), key)
    runs = [sizes[t] for t in sorted(sizes, key=first.get)]

    def needed(capacity):
        n, room = 1, capacity
        for s in runs:
            if s > room:
                n, room = n + 1, capacity
            room -= s
        return n

    best = next(c for c in range(max(runs), sum(runs) + 1) if needed(c) <= 4)
    per = defaultdict(list)
    for r in found:
        per[r["shard"]].append(r)
    assert max(sum(r["size"] for r in g) for g in per.values()) == best
    for g in per.values():
        assert sorted(r["slot"] for r in g) == list(range(len(g)))
    where = defaultdict(set)
    for r in found:
        where[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values()) and set(where) == {zlib.crc32((t or "").encode()) for _, t in TEXTS}
    assert shards.shard_documents(empty).count() == 0


def _groups():
    def grams(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets, forest = [grams(t) for _, t in TEXTS], Forest()
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                forest.link(i, j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(TEXTS):
        ids[forest.root(i)].append(doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((d, len(s), least[forest.root(i)]) for i, ((d, _), s) in enumerate(zip(TEXTS, sets))), key=str)


def test_jaccard_join(docs, empty, monkeypatch):
    want = _groups()
    assert sorted(map(tuple, jaccard_join.near_duplicates(docs).collect()), key=str) == want
    for bucket_tokens in (1, 2000):  # many and few buckets
        monkeypatch.setattr(jaccard_join, "BUCKET_TOKENS", bucket_tokens)
        assert sorted(map(tuple, jaccard_join.near_duplicates(docs).collect()), key=str) == want
    monkeypatch.setattr(jaccard_join, "FAMILY_BLOCK", 1)  # families dealt as pairs of blocks
    assert sorted(map(tuple, jaccard_join.near_duplicates(docs).collect()), key=str) == want
    assert jaccard_join.near_duplicates(empty).count() == 0


def test_pieces(docs, empty):
    model = public_tokenizers.path("piece_bpe_32k.model")
    plain = pieces.Pieces(model)
    encoded = pieces.encode_pieces(docs, model)
    found = by_doc(pieces.decode_pieces(encoded, model).collect())
    assert sorted(map(tuple, pieces.encode_and_decode(docs, model).collect()), key=str) == sorted((tuple(r) for x in found.values() for r in x), key=str)
    assert pieces.encode_and_decode(empty, model).count() == 0
    for doc_id, text in TEXTS:
        data, score = plain.encode(text)
        r = next(r for r in found[doc_id] if r["ids_crc32"] == zlib.crc32(data))
        assert (r["n_pieces"], r["score"]) == (len(data) // 4, score)
        assert r["text"] == (text or "").replace("▁", " ")
    assert pieces.decode_pieces(pieces.encode_pieces(empty, model), model).count() == 0


def test_licenses(docs, empty):
    found = by_doc(license_scan.scan_licenses(docs).collect())
    r = found[12][0]
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (15, 3, 3, 13)
    assert (r["base_labels"], r["labels"], r["score"]) == ("apache,mit", "apache,mit", 1.0)
    assert [(b["line"], b["label"]) for b in r["blocks"]] == [(0, "apache")]
    r = found[4][0]
    assert (r["n_words"], r["n_base"], r["first_word"], r["labels"], r["score"]) == (0, 0, None, "", 0.0)
    assert sum(map(len, found.values())) == len(TEXTS) and license_scan.scan_licenses(empty).count() == 0


def test_licenses_over_line_breaks(spark):
    given = [(label, text, lead, at) for label, text in license_scan.TEMPLATES for lead in ("", " * ", "# ") for at in range(1, len(text.split(" ")))]
    wrapped = []
    for _, text, lead, at in given:
        w = text.split(" ")
        wrapped.append(f"before it\n{lead}{' '.join(w[:at])}\n{lead}{' '.join(w[at:])}\nafter it")
    mit, gpl, bsd = (license_scan.TEMPLATES[i][1] for i in (1, 4, 9))
    usual = [mit.replace("obtaining a copy ", "obtaining a copy\n"), gpl.replace("modify ", "modify\n"), bsd.replace("without ", "without\n")]
    usual.append(mit.replace(" ", "\n"))
    apart = mit.replace("copy", "copy\n" + "word " * 40)  # its words are there, but not in one run
    rows = list(enumerate([*wrapped, *usual, apart, "x\n" + mit]))
    found = {r["doc_id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, (label, *_) in enumerate(given):
        assert label in found[i]["labels"].split(",") and found[i]["score"] == 1.0, rows[i]
    n = len(given)
    # the GPL sentence has 19 of the 21 words of the LGPL one, on one line as well
    assert [found[n + i]["labels"] for i in range(4)] == ["mit", "gpl,lgpl", "bsd", "mit"] and {found[n + i]["score"] for i in range(4)} == {1.0}
    assert (found[n + 4]["labels"], found[n + 4]["score"], found[n + 4]["blocks"]) == ("", 0.0, [])
    assert [(b["line"], b["label"]) for b in found[n + 5]["blocks"]] == [(1, "mit")]


def test_runs_of_words():
    r = random.Random(5)
    index = license_scan.TemplateIndex([("a", "w1 w2 w3 w4 w5 w1 w6 w7 w8 w9 w10")], {}, 0.8)
    _, order, whole, need = index.templates[0]
    hits = 0
    for _ in range(300):
        lines = [[f"w{r.randint(1, 12)}".encode() for _ in range(r.randint(0, 9))] for _ in range(6)]
        words = [w for line in lines for w in line]
        full = max((len(whole & set(b)) for b in [*lines, *(words[i : i + 14] for i in range(len(words)))]), default=0)  # 11 words / 0.8
        got = index.blocks("\n".join(b" ".join(line).decode() for line in lines))
        assert max((c for _, _, c in got), default=0) == (full / len(order) if full >= need else 0)
        hits += bool(got)
    assert 0 < hits < 300


def test_toxicity(spark, docs, empty):
    clean = [(i, f"calm words here number{i} and more", 0) for i in range(200)]
    bad = [(i, f"you vilest{i % 7} rotten person number{i}", 1) for i in range(200, 260)]
    corpus = spark.createDataFrame([r[:2] for r in clean + bad], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in clean + bad] + [(None, 1), (1, None), (99999, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(corpus, labels)
    found = toxicity.score_toxicity(corpus, model).collect()
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(260) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(r["predicted"] == (r["doc_id"] >= 200) == (r["score"] >= 0.7) for r in held)
    assert not set(model.index.ids.tolist()) & {r["doc_id"] for r in held}
    odd = by_doc(toxicity.score_toxicity(docs, model).collect())
    assert sum(map(len, odd.values())) == len(TEXTS) and odd[4][0]["score"] == odd[5][0]["score"] < 0.5 and odd[None][0]["held_out"] is False
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    none = toxicity.fit_toxicity(docs, labels.filter("false"))
    assert {r["predicted"] for r in toxicity.score_toxicity(docs, none).collect()} == {0}
    assert toxicity.score_toxicity(empty, model).count() == 0


def test_packing(docs, empty, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    whole = packing.pack_documents(docs, 64, path, 0).collect()
    monkeypatch.setattr(packing, "GROUP_ROWS", 2)  # lengths ranked in many groups
    found = packing.pack_documents(docs, 64, path, 0).collect()
    assert {(r["sequence_id"], r["offset"], r["length"]) for r in found} == {(r["sequence_id"], r["offset"], r["length"]) for r in whole}
    want = Counter()
    for doc_id, text in TEXTS:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 64):
            want[doc_id, at, len(ids[at : at + 64]), zlib.crc32(ids[at : at + 64].tobytes()), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(empty, 64, path, 0).count() == 0


@pytest.mark.parametrize("hot_share", [None, 1000, 3])  # broadcast joins; shuffled ones with every repeated key hot, with hardly any
def test_exact_dedup(docs, empty, monkeypatch, hot_share):
    if hot_share:
        monkeypatch.setattr(exact_dedup, "bounded", lambda small: small)
        monkeypatch.setattr(exact_dedup, "HOT_SHARE", hot_share)
    found = exact_dedup.exact_duplicates(docs).collect()
    groups = defaultdict(list)
    for doc_id, text in TEXTS:
        groups[(text or "").translate(LOWER)].append(doc_id)
    want = Counter()
    for norm, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(norm.encode()).hexdigest()
        for i in ids:
            want[i, keep, len(ids), sha] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == want
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == sorted(r["doc_id"] for r in kept)
    assert exact_dedup.exact_duplicates(empty).count() == 0 and exact_dedup.drop_exact_duplicates(empty).count() == 0


def test_a_hot_text_is_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "bounded", lambda small: small)
    many = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") / 2).cast("bigint").alias("fp"), "id")
    few = many.groupBy("fp").agg(F.count("*").alias("copies"))
    joined = exact_dedup.join_hot(many, few, ["fp"], "copies", 30_000)
    assert joined.columns == ["fp", "id", "copies"] and joined.count() == 30_000
    assert joined.filter("fp = -1").agg(F.count_distinct("id"), F.min("copies"), F.max("copies")).first() == (10_000, 10_000, 10_000)
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        tasks = exact_dedup.join_hot(many, few, ["fp"], "copies", 30_000).filter("fp = -1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 10_000


def test_of_rows_that_repeat_id_and_text_the_choice_is_fixed(spark):
    rows = [(1, "Same", n, "x") for n in range(9)] + [(2, "other", 0, None)]
    kept = {tuple(exact_dedup.drop_exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string, row int, keep string").repartition(n)).orderBy("doc_id").first()) for n in (1, 3, 7)}
    assert len(kept) == 1


def test_line_dedup(docs, empty, spark):
    found = by_doc(line_dedup.dedup_lines(docs).collect())
    assert found[14][0]["n_dropped"] == 0 and found[14][0]["n_lines"] == 3
    assert found[15][0]["dropped"] == [0, 1] and found[15][0]["text"] == "short"
    assert found[16][0]["dropped"] == [0, 1, 2] and found[16][0]["text"] == ""
    assert found[4][0]["text"] is None and found[4][0]["n_lines"] == 0 and found[5][0]["n_lines"] == 1
    assert sum(map(len, found.values())) == len(TEXTS) and line_dedup.dedup_lines(empty).count() == 0
    lines = [f"a templated line with number {i:03d} in it" for i in range(60)]
    near = spark.createDataFrame(list(enumerate(lines)), "line_id bigint, line string")
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if line_dedup.edit_distance_within(lines[i], lines[j], 2) <= 2}
    for most in (4096, 8):  # within one bucket, and dealt as pairs of blocks
        assert {tuple(r) for r in line_dedup.line_links(near, most_under_key=most).collect()} == want


def test_line_dedup_short_lines(spark, tmp_path):
    from touchline.llm import queries

    texts = {1: "Menu\nfirst text here\n\n\t\n  Menu", 2: "menu\nMenu\n\n\t", 3: "Menu\nfirst text here.\na line that is long enough to count", 4: "a line that is long enough to count!\n", 5: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    want, seen = {}, set()
    for doc_id, text in texts.items():
        left = []
        for line in (text or "").split("\n"):
            bare = line.strip(" ")
            near = next((s for s in seen if min(len(s), len(bare)) >= 20 and line_dedup.edit_distance_within(s, bare, 2) <= 2), None)
            if not bare.strip() or bare not in seen and near is None:
                left.append(line)
            seen.add(bare)
        want[doc_id] = None if text is None else "\n".join(left)
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs, exact_chars=line_dedup.EVERY_LINE).collect()}
    assert {i: r["text"] for i, r in found.items()} == want
    assert [found[i]["n_dropped"] for i in texts] == [1, 1, 1, 1, 0]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"]: r["n_dropped"] for r in queries.op10_line_dedup(spark, str(tmp_path)).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 0}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (100, 101), (7, 7), (None, 3), (200, 100)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(chain, "a bigint, b bigint").repartition(5)).collect()))
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 200: 100}
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def plain_toxicity(docs, labels, model):
    """Scores by the cosine with every example, with dicts alone. The kept features and the calibration are the model's."""
    held = Counter()
    bags = {}
    for text in {t or "" for _, t in docs}:
        bag = Counter(f for chunk in text.lower().split() for f in toxicity.features_of(chunk) if f in model.vocabulary)
        bags[text] = bag
    for _, text in docs:
        held.update(bags[text or ""].keys())
    idf = {f: math.log((1 + len(docs)) / (1 + held[f])) + 1 for f in model.vocabulary}

    def vector(bag):
        weights = {f: (1 + math.log(n)) * idf[f] for f, n in bag.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        return {f: w / norm for f, w in weights.items()}

    label = defaultdict(int)
    for i, toxic in labels:
        if i is not None and toxic in (0, 1) and zlib.crc32(str(i).encode()) % 3 != 1:
            label[i] = max(label[i], toxic)
    first = {}
    for i, text in docs:
        if i in label:
            first[text or ""] = min(first.get(text or "", (i, label[i])), (i, label[i]))
    toxic = sum(t for _, t in first.values())
    prior = (toxic + 0.5) / (len(first) + 1)
    bare = [t for text, (_, t) in first.items() if not bags[text]]
    examples = [(i, t, vector(bags[text])) for text, (i, t) in first.items() if bags[text]]
    scores = {}
    for text, bag in bags.items():
        vote = (sum(bare) + prior) / (len(bare) + 1)
        if bag:
            own = vector(bag)
            near = [(-round(sum(w * e.get(f, 0) for f, w in own.items()), 12), i, t) for i, t, e in examples]
            near = sorted(n for n in near if n[0] < 0)[: toxicity.NEIGHBOURS]
            vote = (sum(c * c * t for c, _, t in near) + prior * 0.5) / (sum(c * c for c, _, _ in near) + 0.5)
        scores[text] = model.calibrated(vote)
    return scores


def tables(spark, sf_dir):
    read = lambda name, *columns: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns).collect()]
    return read("documents", "doc_id", "text"), read("labels", "doc_id", "toxic")


def test_toxicity_against_every_example(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels)
    want = plain_toxicity(*tables(spark, sf_dir), model)
    found = toxicity.score_toxicity(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(found) == 1000 and len({r["score"] for r in found}) > 30
    assert all(math.isclose(r["score"], want[r["text"] or ""], abs_tol=1e-9) for r in found)
    assert max(len(r["neighbours"]) for r in found) > 5


def test_toxicity_with_contradicting_labels(spark):
    rows = [(i, f"calm words here number{i % 90} and more" if i % 5 else f"you vilest{i % 7} rotten person number{i % 60}") for i in range(300)]
    labels = [(i, int(i % 5 == 0)) for i in range(300)] + [(i, i % 2) for i in range(0, 300, 7)] + [(i, 1 - i % 2) for i in range(0, 300, 11)]
    corpus, marks = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = []
    for parts in (1, 2, 7):
        model = toxicity.fit_toxicity(corpus.repartition(parts), marks.repartition(parts))
        found.append((model.prior, toxicity.score_toxicity(corpus, model).select("doc_id", "score").orderBy("doc_id").collect()))
    assert found[0] == found[1] == found[2]
    want = plain_toxicity(rows, labels, model)
    assert all(math.isclose(r["score"], want[rows[r["doc_id"]][1]], abs_tol=1e-9) for r in found[0][1])


def plain_shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    docs = docs.withColumn("more", F.lit(1))  # stages keep what else a table has
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact dedup", "n-gram Jaccard join", "packing"]

    rows, marks = tables(spark, sf_dir)
    scores = plain_toxicity(rows, marks, toxicity.fit_toxicity(docs, labels))
    mild = {i: t for i, t in rows if scores[t or ""] < toxicity.THRESHOLD}
    last = {}
    for i, text in mild.items():
        norm = (text or "").translate(LOWER)
        last[norm] = max(i, last.get(norm, i))
    single = {i: mild[i] for i in last.values()}
    sets = {i: plain_shingles(t) for i, t in single.items()}
    forest = {i: i for i in single}

    def root(i):
        while forest[i] != i:
            i = forest[i]
        return i

    for i in single:
        for j in single:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                forest[b] = a
    apart = {i: t for i, t in single.items() if root(i) == i}
    assert len(apart) < len(single) < len(mild)

    left = docs
    for (_, stage), want in zip(corpus_pipeline.STAGES, (mild, single, apart)):
        left = stage(spark, left, sf_dir)
        assert left.columns == docs.columns
        assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == sorted(want.items())

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces_of = by_doc(corpus_pipeline.run(spark, sf_dir).collect())
    assert set(pieces_of) == set(apart)
    for i, text in apart.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces_of[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
