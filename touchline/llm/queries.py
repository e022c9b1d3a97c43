"""The operators as registered queries with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    ball_search,
    exact_dedup,
    fill_middle,
    jaccard_join,
    license_scan,
    line_dedup,
    order_minhash,
    packing,
    pieces,
    shards,
    token_blocks,
    toxicity,
    vector_topk,
)
from touchline.llm.common import table
from touchline.session import scratch_path

WINDOW = 1024


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edit_fingerprints(table(spark, sf_dir, "documents"))


def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-blocks")
    token_blocks.write_token_blocks(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_blocks.read_token_blocks(spark, path)


def op3_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all texts, decode the ids again, and say whether the text came back (a word mark in the text comes back as a blank)."""
    docs, model = table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    decoded = pieces.encode_and_decode(docs, model)
    return decoded.select("doc_id", "n_pieces", "ids_crc32", "score", F.length("text").cast("bigint").alias("decoded_chars"), F.sha2("text", 256).alias("decoded_sha256"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("blocks")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WINDOW, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), exact_chars=line_dedup.EVERY_LINE)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.fill_middle(table(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("form"), F.col("output"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")]
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_ball_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_topk.top_inner_products(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_order_minhash": op1_order_minhash,
        "op2_token_blocks": op2_token_blocks,
        "op3_minimax_shards": op3_minimax_shards,
        "op4_jaccard_join": op4_jaccard_join,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_license_scan": op6_license_scan,
        "op7_toxicity": op7_toxicity,
        "op8_packing": op8_packing,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_line_dedup": op10_line_dedup,
        "op11_fill_middle": op11_fill_middle,
        "op12_ball_search": op12_ball_search,
        "op13_vector_topk": op13_vector_topk,
    }


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm)
"""

OP4 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
           THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * k >= 75 * (s.n + t.n - k)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON b.x = r.y),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least ON least.x = d.doc_id
"""


def _op6() -> str:
    """One column of places per phrase; templates meet a line if it holds the needed number of their distinct words."""
    places = []
    for phrase, label in license_scan.PHRASES.items():
        words = phrase.split(" ")
        wanted = "[" + ", ".join(f"'{w}'" for w in words) + "]"
        places.append((label, f"list_filter(range(len(w) - {len(words) - 1}), lambda i: w[i + 1:i + {len(words)}] = {wanted})"))
    every = ", ".join(p for _, p in places)
    labels = ", ".join(f"CASE WHEN len({p}) > 0 THEN '{label}' END" for label, p in places)
    rows = ", ".join(f"('{label}', '{text}')" for label, text in license_scan.TEMPLATES)
    words = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {words.format(_LOWER)} AS w FROM documents),
base AS (SELECT doc_id, len(w) AS n_words, flatten([{every}]) AS p, list_filter([{labels}], lambda l: l IS NOT NULL) AS bl FROM d),
templates AS (SELECT label, list_distinct({words.format(lower.format('tt'))}) AS tw FROM (VALUES {rows}) v(label, tt)),
lines AS (SELECT DISTINCT doc_id, list_distinct({words.format(lower.format('l'))}) AS lw FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)),
met AS (
  SELECT doc_id, label, len(list_intersect(tw, lw)) / len(tw) AS c FROM lines, templates
  WHERE len(list_intersect(tw, lw)) >= ceil({license_scan.THRESHOLD} * len(tw) - 1e-9)
), found AS (SELECT doc_id, list(DISTINCT label) AS ml, max(c) AS c FROM met GROUP BY doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, len(p)::BIGINT AS n_base, list_min(p)::BIGINT AS first_word, list_max(p)::BIGINT AS last_word,
       array_to_string(list_sort(bl), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(bl, coalesce(ml, [])))), ',') AS labels,
       CASE WHEN len(p) > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM base LEFT JOIN found USING (doc_id)
"""


_HEX = ", ".join(f"CAST('0x' || substr(sha256('1:' || coalesce(doc_id::VARCHAR, '')), {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))

OP11 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, {_HEX} FROM documents),
e AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), f AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM e)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""

_TERM = "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'"

OP12 = f"""
WITH words AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_TERM}) AS w FROM documents),
d AS (SELECT doc_id, w, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM d),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, {_TERM})) AS term FROM benchmark),
tf AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS weight FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
scores AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), total GROUP BY item_id, doc_id
), ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""

OP13 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
  FROM v AS q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_jaccard_join": OP4,
        "op6_license_scan": _op6(),
        "op9_exact_dedup": OP9,
        "op11_fill_middle": OP11,
        "op12_ball_search": OP12,
        "op13_vector_topk": OP13,
    }
