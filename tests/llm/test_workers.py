"""What Python workers keep between tasks, and the search for parts."""

import bisect
import random

import public_tokenizers
from pyspark.sql import functions as F

from tests.llm.conftest import rows
from touchline.llm import jaccard_join, pieces, tokens
from touchline.llm.common import in_tasks, range_bucket, worker_kept


def wide_texts(n: int) -> list[str]:
    """Letters without a blank, a new text each time."""
    r = random.Random(8)
    return ["".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(3000)) for _ in range(n)]


def test_texts_without_blanks_leave_caches_small():
    texts = wide_texts(60)
    word = tokens.CachedTokenizer(public_tokenizers.path("word_bpe_49k.json"), tokens.drop_spaces)
    byte = tokens.CachedTokenizer(public_tokenizers.path("byte_bpe_50k.json"), tokens.lead_spaces)
    model = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    for text in texts:
        assert word.ids(text) and byte.ids(text) and byte.ids("!" * 3000 + text[:9]) and model.encode(text)[0]
    for cached in (word, byte):
        kept = cached._get.__self__
        assert max(map(len, kept), default=0) <= tokens.LONGEST_KEPT and max(map(len, kept._signs), default=0) <= tokens.LONGEST_KEPT
        assert kept.held < 1 << 20
    assert max(map(len, model._cache), default=0) <= pieces.LONGEST_KEPT and model.held < 1 << 20


def test_caches_keep_to_their_bytes():
    path, r = public_tokenizers.path("byte_bpe_50k.json"), random.Random(2)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(3, 12))) for _ in range(4000)]
    byte, model = tokens.CachedTokenizer(path, tokens.lead_spaces, 100_000), pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"), 100_000)
    free, free_model = tokens.CachedTokenizer(path, tokens.lead_spaces), pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    for a in range(0, 4000, 50):
        text = " ".join(words[a : a + 50])
        assert byte.ids(text) == free.ids(text) and model.encode(text) == free_model.encode(text)
        assert byte._get.__self__.held <= 100_000 and model.held <= 100_000


def test_a_function_finds_nothing_of_another(spark):
    def put(name):
        def run(batches):
            for batch in batches:
                before = sorted(k for k in worker_kept() if k != "function")
                worker_kept()[name] = bytearray(1000)
                yield batch.from_pydict({"before": [",".join(before)] * batch.num_rows})

        return run

    ids = spark.range(0, 40, 1, 4)
    first, second = in_tasks(ids, put("a"), "before string"), in_tasks(ids, put("b"), "before string")
    for _ in range(3):
        assert {r[0] for r in first.collect()} <= {"", "a"}
        assert {r[0] for r in second.collect()} <= {"", "b"}


def test_range_bucket(spark):
    r = random.Random(6)
    for n in (0, 1, 2, 3, 10, 997):
        bounds = sorted(r.sample(range(-5000, 5000), n))
        keys = [None, *(r.randrange(-6000, 6000) for _ in range(200)), *bounds[:50]]
        frame = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", range_bucket(F.col("k"), bounds).alias("part"))
        assert all(part == (0 if k is None else bisect.bisect_left(bounds, k)) for k, part in frame.collect())


def test_dropping_near_copies_beside_any_column(spark, docs, empty):
    clashing = docs.withColumn("_dropped", F.lit(1)).withColumn("component_id", F.lit(2)).withColumn("dropped", F.lit(3))
    kept = jaccard_join.drop_near_duplicates(clashing)
    assert kept.columns == clashing.columns
    found = jaccard_join.near_duplicates(docs).collect()
    gone = {r["doc_id"] for r in found if r["doc_id"] is not None and r["doc_id"] != r["component_id"]}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((r[0] for r in rows() if r[0] not in gone), key=str)
    assert jaccard_join.drop_near_duplicates(empty).count() == 0
