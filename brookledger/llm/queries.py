"""The operators applied to the given tables, and the SQL that checks some of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brookledger.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op7_exact_dedup"] = r"""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
    FROM documents),
r AS (
    SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
           row_number() OVER w = 1 AS kept
    FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM r
"""


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents and their shares of the mix, sorted by the training time of the first copy; those left out come last."""
    from brookledger.llm.mixing import mixture

    planned = mixture(table(spark, sf_dir, "documents"))
    ordered = planned.orderBy(F.get("times", F.lit(0)).asc_nulls_last(), "doc_id")
    return ordered.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op9_mixing"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS key
    FROM documents),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
           row_number() OVER (ORDER BY source NULLS LAST) AS ordinal
    FROM d GROUP BY source),
total AS (SELECT sum(source_size)::DOUBLE AS words FROM s),
-- each step fills the sources that the level reached; the last step is the fixed point
level AS (
    SELECT 0 AS step, []::BIGINT[] AS filled
    UNION ALL
    SELECT step + 1, (
        SELECT list(ordinal) FROM s, (
            SELECT (any_value(words) - coalesce(sum(3.0::DOUBLE * source_size) FILTER (list_contains(filled, ordinal)), 0))
                   / sum(weight) FILTER (NOT list_contains(filled, ordinal)) AS l FROM s, total)
        WHERE list_contains(filled, ordinal) OR l * weight >= 3.0::DOUBLE * source_size)
    FROM level WHERE step <= (SELECT count(*) FROM s)),
last AS (SELECT coalesce(filled, []) AS filled FROM level ORDER BY step DESC LIMIT 1),
rest AS (
    SELECT (any_value(words) - coalesce(sum(3.0::DOUBLE * source_size) FILTER (list_contains(filled, ordinal)), 0))
           / sum(weight) FILTER (NOT list_contains(filled, ordinal)) AS l
    FROM s, total, last),
t AS (
    SELECT source, source_size,
           CASE WHEN list_contains(filled, ordinal) THEN 3.0::DOUBLE * source_size ELSE weight * l END AS target
    FROM s, last, rest),
laid AS (
    SELECT doc_id, size, source_size, target,
           (coalesce(sum(size) OVER (
               PARTITION BY d.source
               ORDER BY ('0x' || key[1:8])::BIGINT % 4096, key, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * (CASE WHEN 2 * start + size < 2 * target THEN 1 ELSE 0 END
             + CASE WHEN 2 * (start + source_size) + size < 2 * target THEN 1 ELSE 0 END
             + CASE WHEN 2 * (start + 2 * source_size) + size < 2 * target THEN 1 ELSE 0 END)::BIGINT AS taken
FROM laid
"""


@query
def op9_mixing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each copy of the mix with its training time, sorted by it."""
    from brookledger.llm.mixing import mixture

    planned = mixture(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", F.posexplode("times").alias("copy", "time")).orderBy("time", "doc_id", "copy")


ORACLES["op9_mixing_order"] = ORACLES["op9_mixing"].partition("laid AS (")[0] + r"""placed AS (
    SELECT doc_id, size, t.source_size, target, [-0.5, 0.0, 0.5][(s.ordinal - 1) % 3 + 1]::DOUBLE AS slope,
           (coalesce(sum(size) OVER (
               PARTITION BY d.source
               ORDER BY ('0x' || key[1:8])::BIGINT % 4096, key, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN s ON d.source IS NOT DISTINCT FROM s.source),
copies AS (
    SELECT doc_id, copy::INTEGER AS copy, slope, (start + copy * source_size)::DOUBLE / target AS share
    FROM placed, range(0, 3) AS c(copy)
    WHERE size > 0 AND 2 * (start + copy * source_size) + size < 2 * target)
SELECT doc_id, copy,
       CASE WHEN slope = 0 THEN share
            ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope) END AS time
FROM copies
"""


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brookledger.llm.license_scan import license_scan

    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brookledger.llm.quality_zstd import learn, quality

    docs = table(spark, sf_dir, "documents")
    return quality(docs, learn(docs, table(spark, sf_dir, "labels")))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brookledger.llm.language_id import language_id, learn

    docs = table(spark, sf_dir, "documents")
    return language_id(docs, learn(docs))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from brookledger.llm.token_files import token_digests, token_folder, write_token_files

    folder = token_folder(spark)
    write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_digests(spark, folder)


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brookledger.llm.sentencepiece_dropout import encoded

    digests = encoded(table(spark, sf_dir, "documents"))
    return digests.select("doc_id", "n_tokens", F.md5(F.to_json("ids")).alias("ids_md5"), "lossless")


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brookledger.llm.substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept_text")


ORACLES["op3_substring_dedup"] = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (
    SELECT doc_id, p, array_to_string(words[p:p + 19], ' ') AS gram
    FROM w, unnest(range(1, len(words) - 18)) AS t(p)),
later AS (
    SELECT doc_id, p FROM g
    QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM later, range(0, 20) AS t(k)),
per AS (SELECT doc_id, list(p) AS places FROM gone GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(words, lambda x, i: NOT coalesce(list_contains(places, i), false)), ' ')) AS kept_sha256
FROM w LEFT JOIN per USING (doc_id)
"""


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brookledger.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


@query
def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brookledger.llm.pq_neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings")).drop("label")


@query
def op12_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brookledger.llm.toxic_passages import learn, toxicity

    docs = table(spark, sf_dir, "documents")
    scored = toxicity(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("n_passages", F.size("passages").cast("long")).drop("passages")


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from brookledger.llm.tokenizer_alignment import alignment

    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brookledger.llm.hard_negatives import hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


ORACLES["op13_hard_negatives"] = r"""
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT * FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id))::INTEGER AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""


ORACLES["op1_embedding_neardup"] = r"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
reached AS (
    SELECT a, b FROM links
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, least(a, min(b)) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN lowest l ON vec_id = l.a LEFT JOIN counted c ON vec_id = c.a
"""
