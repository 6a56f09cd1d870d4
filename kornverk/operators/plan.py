"""The coverage plan: how often each term is still needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import containers, text
from .matching import surfaces, used_terms
from .ordering import numbered

def _terms() -> Column:
    return F.array().cast("array<string>")


def filled(terms: Column | str) -> Column:
    """Elements that aren't blank."""
    c = F.col(terms) if isinstance(terms, str) else terms
    return F.filter(F.coalesce(c, _terms()), lambda t: ~text.is_blank(t))


def distinct_terms(terms: Column | str) -> Column:
    """Elements that aren't blank, each once, in order; empty for null."""
    return F.array_distinct(filled(terms))


def remaining(target: str = "target_count", corpus: str = "corpus_count", used: str | None = "used_in_output") -> Column:
    zero = F.lit(0).cast("bigint")
    left = F.coalesce(target, zero) - F.coalesce(corpus, zero)
    return F.greatest(zero, left - F.coalesce(used, zero) if used else left)


def init_plan(vocabulary: DataFrame, target: int = 100, order: str = "rank") -> DataFrame:
    """A plan row for each row of the vocabulary with a term; a missing id is ``term_`` and the place among the rows kept, by ``order``."""
    kept = vocabulary.where(~text.is_blank("term"))
    placed = numbered(kept, F.floor(F.col(order) / 65_536), [F.col(order), F.col("term")], "_p").withColumn("_p", (F.col("_p") + 1).cast("string"))
    corpus = F.coalesce("corpus_count", F.lit(0)).cast("bigint")
    goal = F.lit(target).cast("bigint")
    return placed.select(
        F.when(text.is_blank("term_id"), F.concat(F.lit("term_"), F.lpad("_p", F.greatest(F.length("_p"), F.lit(4)), F.lit("0")))).otherwise(F.col("term_id")).alias("term_id"),
        "term", corpus.alias("corpus_count"), goal.alias("target_count"), F.lit(0).cast("bigint").alias("used_in_output"), F.lit(0).cast("bigint").alias("prompt_counter"),
        F.greatest(F.lit(0).cast("bigint"), goal - corpus).alias("target_remaining"), filled("variants").alias("variants"),
    )


def most_needed_first(plan: DataFrame) -> DataFrame:
    return plan.orderBy(F.desc("target_remaining"), F.desc("term"))


def least_needed_first(plan: DataFrame) -> DataFrame:
    return plan.orderBy("target_remaining", "term")


def presence_counts(records: DataFrame, terms: str = "used_terms") -> DataFrame:
    """(term, used): in how many records each term stands, at most once in each."""
    return records.select(F.explode(distinct_terms(terms)).alias("term")).groupBy("term").agg(F.count("*").alias("used"))


def required_counts(plan: DataFrame, order: str | None = None) -> DataFrame:
    """(term, required): how often outputs must have each term; of rows with one term the last in ``order`` counts, the largest need without one."""
    rows = plan.where(~text.is_blank("term")).withColumn("required", remaining(used=None))
    last = F.max("required") if order is None else F.max_by("required", order)
    return rows.groupBy("term").agg(last.alias("required"))


def evaluated(records: DataFrame, plan: DataFrame, key: str, mode: str = "new", order: str = "ord") -> DataFrame:
    """(key, used_terms): stored lists cut to terms of the plan in mode ``new``, computed from the text where there is none, or for all in mode ``all``."""
    if mode not in ("new", "all"):
        raise ValueError(f"mode is new or all, not {mode!r}")
    stored = records.where("used_terms IS NOT NULL") if mode == "new" else records.limit(0)
    open_ = records.where("used_terms IS NULL") if mode == "new" else records
    known = surfaces(plan, order).select(F.col("target").alias("t")).distinct()
    each = stored.select(F.col(key).alias("k"), F.posexplode(distinct_terms("used_terms")).alias("p", "t")).join(known, "t", "left_semi")
    lists = each.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "t"))), lambda x: x["t"]).alias("l"))
    cached = stored.select(F.col(key).alias("k")).join(lists, "k", "left").select(F.col("k").alias(key), F.coalesce("l", _terms()).alias("used_terms"))
    texts = open_.select(key, containers.answer_text_of("result").alias("text"))
    return cached.unionByName(used_terms(texts, key, "text", plan, order))


def updated_plan(plan: DataFrame, records: DataFrame, accumulate: bool = False) -> DataFrame:
    """The plan with its use in ``records`` (used_terms), in place of the stored use or added to it."""
    joined = plan.join(presence_counts(records), "term", "left")
    zero = F.lit(0).cast("bigint")
    used = F.coalesce("used", zero)
    now = F.coalesce("used_in_output", zero) + used if accumulate else used
    return joined.withColumn("used_in_output", now).withColumn("target_remaining", remaining()).drop("used").select(plan.columns)


def is_complete(plan: DataFrame) -> DataFrame:
    """(complete): no term is needed any more; an empty plan is not complete."""
    return plan.agg(((F.count("*") > 0) & (F.coalesce(F.max("target_remaining"), F.lit(0)) <= 0)).alias("complete"))


def estimated_targets(plan: DataFrame, optional: int = 10, effort: str = "low") -> DataFrame:
    """``target_remaining`` as a number of prompts, by the terms one answer is expected to use."""
    base = 4.5 if effort == "none" else 6.1
    expected = max(1.0, 1 + (base - 1) * max(0, optional) / 10)
    left = F.when(F.coalesce(F.col("target_remaining") >= 0, F.lit(False)), F.col("target_remaining")).otherwise(remaining())
    return plan.withColumn("target_remaining", F.ceil(left / F.lit(expected)).cast("bigint"))


def last_of_each(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with one key the last in ``order``."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
