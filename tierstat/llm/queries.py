"""The registered query of each operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstat.llm import (
    decontaminate, hard_negatives, html_text, mix, neighbours, quality, repeats, secrets, shard, simhash, spelling, urls, warc,
)
from tierstat.llm.common import read


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with at least 0.8 of the item's five-word shingles in the document."""
    found = decontaminate.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "shared", "item_shingles", "containment")


def op2_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard_documents(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.when(F.col("law") == "key", F.col("grown_shard")).alias("grown_shard")
    )


def op3_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mix.with_copies(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies"
    )


def op4_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"))


def op5_link_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged_pages(read(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate with its score; the value itself is not passed on, only its digest."""
    found = secrets.secret_findings(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "position", F.length("value").cast("long").alias("length"), F.sha2(F.col("value"), 256).alias("value_sha256"), "score", "predicted"
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(read(spark, sf_dir, "pages"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(read(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector; every 7th row has its label moved on first."""
    vectors = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")))


def slipped(doc_id: Column, run: Column) -> Column:
    """``run`` without one character where 31 divides the checksum of id and run."""
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (check % F.length(run)).cast("int")
    return F.when(check % 31 == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.corpus_words(read(spark, sf_dir, "documents"), change=slipped)
    return spelling.spelling_forms(words)


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_hash_tree_sharding": op2_hash_tree_sharding,
    "op3_entropy_mix": op3_entropy_mix,
    "op4_learned_partitions": op4_learned_partitions,
    "op5_link_propagation": op5_link_propagation,
    "op6_simhash": op6_simhash,
    "op7_secrets": op7_secrets,
    "op8_quality": op8_quality,
    "op9_warc": op9_warc,
    "op10_main_text": op10_main_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_repeated_passages": op13_repeated_passages,
}

ORACLE: dict[str, str] = {
    "op1_decontamination": r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS words FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') FROM benchmark
), widths AS (
  SELECT DISTINCT least(len(words), 5) AS width FROM w WHERE kind = 'i' AND len(words) > 0
), s AS (
  SELECT DISTINCT kind, id, width,
    unnest(list_transform(range(1, len(words) - width + 2), lambda i: array_to_string(words[i:i + width - 1], ' '))) AS shingle
  FROM w JOIN widths ON len(words) >= width AND (kind = 'd' OR width = least(len(words), 5))
), n AS (SELECT id AS item_id, count(*) AS n FROM s WHERE kind = 'i' GROUP BY 1)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared, any_value(n.n) AS item_shingles,
       count(*)::DOUBLE / any_value(n.n) AS containment
FROM s d JOIN s i ON d.shingle = i.shingle AND d.width = i.width AND d.kind = 'd' AND i.kind = 'i' JOIN n ON n.item_id = i.id
GROUP BY 1, 2 HAVING count(*) >= ceil(round(any_value(n.n) * 0.8, 6))
""",
    "op2_hash_tree_sharding": r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id::VARCHAR, 'null key') AS key, coalesce(text, '') AS text FROM documents
), sized AS (
  SELECT r, doc_id, strlen(text)::BIGINT + 1 AS size, xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS text_crc32
  FROM d
), leaf AS (
  SELECT s, 'region' || (s // 8) AS region, 'region' || (s // 8) || '/rack' || (s // 4) AS rack, 8 AS region_weight, 4 AS rack_weight FROM range(16) t(s)
  UNION ALL
  SELECT 16, 'region-of-16', 'region-of-16/rack-of-16', 1, 1
), drawn AS (
  SELECT r, s, struct_pack(
      region := -ln((('0x' || substr(md5(key || '/' || region), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496::DOUBLE) / region_weight,
      rack := -ln((('0x' || substr(md5(key || '/' || rack), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496::DOUBLE) / rack_weight,
      leaf := -ln((('0x' || substr(md5(key || '/' || rack || '/' || s), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496::DOUBLE),
      s := s) AS draw
  FROM d, leaf
), placed AS (
  SELECT r, (min(draw) FILTER (s < 16)).s::INT AS shard, min(draw).s::INT AS grown_shard FROM drawn GROUP BY r
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (
    PARTITION BY shard
    ORDER BY ('0x' || substr(md5(concat_ws(':', doc_id, text_crc32)), 1, 8))::BIGINT % 256, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
  grown_shard
FROM sized JOIN placed USING (r)
""",
    "op9_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     o AS (SELECT *, CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS original FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to
FROM o
""",
    "op11_hard_negatives": """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i]))::BIGINT AS score
  FROM r a JOIN r c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), p AS (
  SELECT anchor_id, vec_id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
""",
    "op12_spelling_variants": r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), checked AS (
  SELECT run, n, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(doc_id || ':' || run)), 1),
        lambda i: ('0x' || substr(hex(encode(doc_id || ':' || run)), 2 * i + 1, 2))::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS c
  FROM counted
), slipped AS (
  SELECT CASE WHEN xor(c, 4294967295) % 31 = 0
              THEN substr(run, 1, xor(c, 4294967295) % length(run)) || substr(run, xor(c, 4294967295) % length(run) + 2)
              ELSE run END AS word, n
  FROM checked
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS most, min(struct_pack(m := -n, w := encode(near))).w AS first FROM near GROUP BY 1
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.most >= 10 * w.n THEN decode(b.first) END AS form, CASE WHEN b.most >= 10 * w.n THEN b.most END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), chain AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
""",
    "op13_repeated_passages": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), x AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS piece FROM (
    SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)
), y AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY piece) AS first FROM x
), gone AS (
  SELECT doc_id, list(DISTINCT g) AS g FROM (SELECT doc_id, unnest(range(i, i + 50)) AS g FROM y WHERE first < doc_id) GROUP BY 1
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, len(coalesce(g, []))::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN g IS NULL THEN words
         ELSE list_transform(list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(g, i)), lambda i: words[i]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
""",
}
