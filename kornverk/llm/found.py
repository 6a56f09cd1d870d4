"""Problems of TESTDATA.md as queries over a directory of its tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..arrow import one_delivery
from .frequency import clean_terms, mark, ngram_frequencies
from .leaks import leak_shares, leaks
from .lookalike import lookalikes
from .mixing import document_tokens, rates
from .neardup import near_duplicates
from .pairs import defects
from .pieces import cut_levels
from .repetition import repetition
from .sentences import split_sentences
from .truncation import share_by_source, truncation


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _twentieth(df: DataFrame, key: str):
    """5 % of all different keys; a division, since 0.05 * n may miss a whole number."""
    return df.select(F.count_distinct(key) / 20).scalar()


def term_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field_name, term_value, occurrences, records, mark) of every term of ``used_terms`` and every ``corpus_count``.

    Deliveries of one output_id are one record, and equal counts of one term_id are one occurrence.
    """
    outputs, plan = _table(spark, sf_dir, "outputs"), _table(spark, sf_dir, "terms_to_use")
    used = one_delivery(outputs, "output_id", "used_terms").select(clean_terms(F.col("used_terms")).alias("v"))
    counts = plan.where("term_id IS NOT NULL").groupBy("term_id").agg(F.collect_set(F.col("corpus_count").cast("string")).alias("v"))
    marked = (
        ("used_terms", mark(ngram_frequencies(used, "v"), 3, _twentieth(outputs, "output_id"))),
        ("corpus_count", mark(ngram_frequencies(counts, "v"), 2, _twentieth(plan, "term_id"))),
    )
    terms, numbers = (df.select(F.lit(n).alias("field_name"), F.col("ngram")[0].alias("term_value"), "occurrences", "records", "mark") for n, df in marked)
    return terms.unionByName(numbers)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_frequencies(spark, sf_dir).where("mark IS NOT NULL").select("field_name", "term_value", "mark")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "outputs"), "output_id", "result")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation(_table(spark, sf_dir, "outputs"), "output_id", "result", "source").where("cut").select("output_id", "source")


def p3_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, records, cut_records, cut_share)."""
    return share_by_source(truncation(_table(spark, sf_dir, "outputs"), "output_id", "result", "source"), "source")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = repetition(_table(spark, sf_dir, "outputs"), "output_id", "result")
    return shares.where("words > 0 AND 10 * repeated_words >= 3 * words").select("output_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_sentences(_table(spark, sf_dir, "outputs"), "output_id", "result")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects(_table(spark, sf_dir, "outputs"), "output_id", "prompt", "result", "source")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_levels(_table(spark, sf_dir, "outputs"), "output_id", "result")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), "doc_id", _table(spark, sf_dir, "eval_items"), "item_id")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, longest, leaked_words, leaked_share)."""
    return leak_shares(_table(spark, sf_dir, "documents"), "doc_id", _table(spark, sf_dir, "eval_items"), "item_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(document_tokens(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "mix_targets")).where("short").select("source")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes(_table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p3_found, p3_shares, p4_found, p5_found, p6_found, p7_found, p8_found, p8_shares, p9_found, p10_found)}

_P1 = r"""
WITH records AS (SELECT output_id, min(used_terms) AS terms FROM outputs WHERE output_id IS NOT NULL GROUP BY output_id),
terms AS (
  SELECT DISTINCT output_id, lower(regexp_replace(t, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS term_value
  FROM (SELECT output_id, unnest(terms) AS t FROM records)
),
term_marks AS (
  SELECT term_value, CASE WHEN count(*) < 3 THEN 'rare' WHEN count(*) * 20 > (SELECT count(*) FROM records) THEN 'common' END AS mark
  FROM terms WHERE term_value <> '' GROUP BY term_value
),
counts AS (SELECT DISTINCT term_id, CAST(corpus_count AS VARCHAR) AS term_value FROM terms_to_use WHERE term_id IS NOT NULL AND corpus_count IS NOT NULL),
count_marks AS (
  SELECT term_value, CASE WHEN count(*) < 2 THEN 'rare' WHEN count(*) * 20 > (SELECT count(DISTINCT term_id) FROM terms_to_use) THEN 'common' END AS mark
  FROM counts GROUP BY term_value
)
SELECT 'used_terms' AS field_name, term_value, mark FROM term_marks WHERE mark IS NOT NULL
UNION ALL SELECT 'corpus_count', term_value, mark FROM count_marks WHERE mark IS NOT NULL
"""

ORACLE_SQL = {"p1_found": _P1}
