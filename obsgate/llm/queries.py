"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgate.llm.decontaminate import contamination
from obsgate.llm.hard_negatives import hard_negatives
from obsgate.llm.html_extract import extract
from obsgate.llm.jaccard_join import jaccard_components
from obsgate.llm.line_dedup import MAX_PCT, MIN_PAGES, line_dedup
from obsgate.llm.packing import pack
from obsgate.llm.pii import find_pii
from obsgate.llm.quality_rules import quality_rules
from obsgate.llm.substring_dedup import substring_dedup
from obsgate.llm.token_counts import token_counts
from obsgate.llm.token_records import token_records
from obsgate.llm.toxicity import toxicity
from obsgate.llm.whitening import whiten


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_read(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_read(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_read(spark, sf_dir, "documents")).selectExpr("row.doc_id AS doc_id", "row.source AS source", "n_lines", "n_dropped", "kept_text AS text")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(_read(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_read(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_read(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_read(spark, sf_dir, "documents"))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records(_read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th row is an anchor; every 7th row's label is moved on by one."""
    rows = _read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_decontaminate, op3_toxicity, op4_html_extract, op5_line_dedup, op6_pii, op7_packing, op8_jaccard_join, op9_substring_dedup, op10_token_records, op11_hard_negatives, op12_token_counts, op13_whitening)}

ORACLE: dict[str, str] = {
    "op5_line_dedup": f"""
WITH page AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
own AS (SELECT doc_id, source, unnest(list_distinct(lines)) AS line FROM page),
total AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
bad AS (
  SELECT o.source, o.line FROM own o JOIN total t ON o.source IS NOT DISTINCT FROM t.source
  WHERE regexp_matches(o.line, '[^\x20\x09-\x0D]')
  GROUP BY o.source, o.line, t.pages HAVING count(*) >= {MIN_PAGES} AND count(*) * 100 > t.pages * {MAX_PCT}),
lists AS (SELECT source, list(line) AS bad FROM bad GROUP BY source),
kept AS (
  SELECT p.*, CASE WHEN l.bad IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(l.bad, x)) END AS kept
  FROM page p LEFT JOIN lists l ON p.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, source, coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(kept), 0) AS n_dropped,
  array_to_string(kept, chr(10)) AS text FROM kept""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
    other AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT * FROM n WHERE rank <= 3""",
}
