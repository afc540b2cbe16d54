"""The numbered queries over the sample tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeromart.llm import (
    bpe, compression, decontaminate, html, language, negatives, packing, periodic, quality_rules, sharding, simhash, toxicity, warc,
)
from aeromart.llm.common import table


def vocabulary() -> str:
    """The public byte-level vocabulary, where it is installed; executors read the same path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"]
    return judged.select(columns)


def op4_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compression.score(docs, compression.train(docs, table(spark, sf_dir, "labels")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shuffle_into_shards(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary())


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page found again by its address: through the sparse directory, a block of the index and a range read."""
    pages = table(spark, sf_dir, "pages")
    read = warc.build(pages).lookup(pages, payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.find_runs(table(spark, sf_dir, "documents"), periodic.loop_some))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents"), vocabulary()))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    seventh = F.col("vec_id") % 7 == 0
    label = F.when(seventh, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_compression": op4_compression,
    "op5_sharding": op5_sharding,
    "op6_language": op6_language,
    "op7_bpe": op7_bpe,
    "op8_decontaminate": op8_decontaminate,
    "op9_html": op9_html,
    "op10_warc": op10_warc,
    "op11_periodic": op11_periodic,
    "op12_packing": op12_packing,
    "op13_hard_negatives": op13_hard_negatives,
}

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op8_decontaminate": f"""
WITH items AS (SELECT item_id, regexp_extract_all({_LOWERED}, '{_WORDS}') AS w FROM benchmark),
patterns AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(greatest(1, len(w) - 9))) AS i FROM items WHERE len(w) > 0)
),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_WORDS}') AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM patterns),
windows AS (
  SELECT r, i, n, array_to_string(w[i + 1 : i + n], ' ') AS p
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS i FROM docs, sizes WHERE len(w) >= n)
),
found AS (SELECT r, i, n, item_id FROM windows JOIN patterns USING (n, p)),
hits AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)""",
    # the sample's pages put the article in <article>, and have no references but these
    "op9_html": r"""
WITH a AS (SELECT page_id, url, split_part(split_part(coalesce(html, ''), '<article>', 2), '</article>', 1) AS h FROM pages),
t AS (SELECT page_id, url, replace(replace(regexp_replace(h, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;', '&') AS t FROM a),
s AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM t)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM s""",
    "op10_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first, count(*) AS c FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN c > 1 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN c > 1 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)""",
    "op13_hard_negatives": """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM r a, r WHERE a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER n)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW n AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER n <= 3""",
}
