"""Terms of a plan in texts: exact spelling, then title case at the start of a sentence, then the stem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .vocabulary import with_stem_keys


def surfaces(plan: DataFrame, order: str = "ord") -> DataFrame:
    """(surface, target, at): every spelling of the plan and its term; a term is always its own, else the first row that has it counts."""
    rows = plan.where(~text.is_blank("term")).select("term", F.col(order).alias("o"), F.posexplode(F.concat(F.array("term"), F.filter(F.coalesce("variants", F.array().cast("array<string>")), lambda v: ~text.is_blank(v)))).alias("p", "surface"))
    at = F.struct("o", "p")
    return rows.groupBy("surface").agg(F.coalesce(F.max(F.when(F.col("term") == F.col("surface"), F.col("term"))), F.min_by("term", at)).alias("target"), F.min(at).alias("at"))


def stem_targets(spellings: DataFrame) -> DataFrame:
    """(stem_key, stem_target): of the spellings with one stem key the term of the first."""
    return with_stem_keys(spellings, "surface").groupBy("stem_key").agg(F.min_by("target", "at").alias("stem_target"))


def matched_tokens(tokens: DataFrame, plan: DataFrame, order: str = "ord", stemming: bool = True) -> DataFrame:
    """(token, start, term) of the rows of ``tokens`` (token, start) that match; a compound matches by its hyphen parts where it doesn't as a whole."""
    spelt = surfaces(plan, order)
    rows = tokens.select("token", "start").distinct()
    parts = rows.select("token", "start", F.posexplode(F.concat(F.array("token"), text.hyphen_candidates("token"))).alias("p", "c"))
    at_start = F.col("start") & F.when(F.col("p") == 0, True).otherwise(F.startswith("token", "c"))
    cased = parts.withColumn("low", F.when(at_start & text.is_titlecase("c"), F.lower("c")))
    hit = cased.join(spelt.select(F.col("surface").alias("c"), F.col("target").alias("t1")), "c", "left").join(spelt.select(F.col("surface").alias("low"), F.col("target").alias("t2")), "low", "left")
    found = F.coalesce("t1", "t2")
    if stemming:
        lower = F.coalesce("low", F.when(text.is_lower("c"), F.col("c")))
        hit = with_stem_keys(hit.withColumn("lower", lower), "lower").join(stem_targets(spelt), "stem_key", "left")
        found = F.coalesce(found, "stem_target")
    hits = hit.withColumn("term", found).where("term IS NOT NULL")
    return hits.groupBy("token", "start").agg(F.min_by("term", "p").alias("term"))


def used_terms(records: DataFrame, key: str, text_column: str, plan: DataFrame, order: str = "ord", stemming: bool = True) -> DataFrame:
    """(key, used_terms): the different terms of each record in the order in which they first stand; empty for a null text."""
    each = records.select(F.col(key).alias("k"), F.posexplode(text.sentence_tokens(text_column)).alias("pos", "t")).select("k", "pos", F.col("t.token").alias("token"), F.col("t.start").alias("start"))
    hits = each.join(matched_tokens(each, plan, order, stemming), ["token", "start"]).groupBy("k", "term").agg(F.min("pos").alias("pos"))
    lists = hits.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda x: x["term"]).alias("terms"))
    return records.select(F.col(key).alias("k")).join(lists, "k", "left").select(F.col("k").alias(key), F.coalesce("terms", F.array().cast("array<string>")).alias("used_terms"))
