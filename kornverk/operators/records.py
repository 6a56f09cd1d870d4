"""Records of prompts and answers: projections, merges and differences by id, counters and totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids


def id_result(records: DataFrame) -> DataFrame:
    """(id, result) of rows that have both."""
    return records.where("id IS NOT NULL AND result IS NOT NULL").select("id", "result")


def id_result_totals(records: DataFrame) -> DataFrame:
    """(kept, skipped) of ``id_result``."""
    both = F.col("id").isNotNull() & F.col("result").isNotNull()
    return records.agg(F.count_if(both).alias("kept"), F.count_if(~both).alias("skipped"))


def canonical(records: DataFrame) -> DataFrame:
    """(id, template, prompt, result, used_terms): ``response`` where there is no result, a null template empty, a null list empty; other columns go."""
    have = set(records.columns)

    def col(name: str, kind: str = "string") -> Column:
        return F.col(name) if name in have else F.lit(None).cast(kind)

    return records.select(
        col("id").alias("id"), F.coalesce(col("template"), F.lit("")).alias("template"), col("prompt").alias("prompt"),
        F.coalesce(col("result"), col("response")).alias("result"), F.coalesce(col("used_terms", "array<string>"), F.array().cast("array<string>")).alias("used_terms"),
    )


def without_audit(records: DataFrame) -> DataFrame:
    """Rows as they were before they were rejected or counted."""
    return records.drop("filter_reason", "used_term_counts")


def merged(*inputs: DataFrame) -> DataFrame:
    """All rows of all inputs, repeats kept; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)


def pending(prompts: DataFrame, outputs: DataFrame) -> DataFrame:
    """Prompts whose id no output has."""
    return prompts.join(outputs.select("id").distinct(), "id", "left_anti")


def has_pending(prompts: DataFrame, outputs: DataFrame) -> bool:
    return not pending(prompts, outputs).isEmpty()


def not_completed(rows: DataFrame, completed: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id, as text, isn't among the completed ids; rows without one stay."""
    done = completed.select(F.col(key).cast("string").alias("_done")).where("_done IS NOT NULL").distinct()
    return rows.join(done, F.col(key).cast("string") == F.col("_done"), "left_anti")


def upserted(existing: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """``new`` in place of existing rows with the same id."""
    return existing.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def without_rejected(prompts: DataFrame, rejected: DataFrame) -> DataFrame:
    """Prompts whose id wasn't rejected, so that they are answered again; rows without an id stay."""
    return prompts.join(rejected.select("id").where("id IS NOT NULL").distinct(), "id", "left_anti")


def moved(rows: DataFrame, going: DataFrame, key: str, reason: str) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows that go with their reason)."""
    return rows.join(going.select(key), key, "left_anti"), rows.join(going.select(key), key, "left_semi").withColumn("filter_reason", F.lit(reason))


def max_counters(prompts: DataFrame) -> DataFrame:
    """(term_id, counter): the highest number of the ids of each prefix."""
    return prompts.select(ids.id_prefix("id").alias("term_id"), ids.id_number("id").alias("n")).where("term_id IS NOT NULL AND n IS NOT NULL").groupBy("term_id").agg(F.max("n").alias("counter"))


def generation_keys(records: DataFrame, *extra: str) -> DataFrame:
    """``extra`` columns with (generation, prefix) of each id; ids of another form come last."""
    return records.select(*extra, ids.generation("id").alias("generation"), ids.generation_prefix("id").alias("prefix"))


def status_totals(log: DataFrame) -> DataFrame:
    """(status, entries): statuses trimmed and lower-cased, blank ones as ``unknown``."""
    even = F.lower(F.trim(F.coalesce("status", F.lit(""))))
    return log.groupBy(F.when(even == "", "unknown").otherwise(even).alias("status")).agg(F.count("*").alias("entries"))


def run_totals(before: DataFrame, after: DataFrame, failed: DataFrame, key: str = "id", value: str = "result") -> DataFrame:
    """(processed, changed, unchanged, failed, skipped) of a step from ``before`` to ``after``; skipped rows are in neither ``after`` nor ``failed``."""
    a = after.select(F.col(key).alias("_a"), F.col(value).alias("_v"))
    f = failed.select(F.col(key).alias("_f")).distinct()
    j = before.join(a, F.col(key) == F.col("_a"), "left").join(f, F.col(key) == F.col("_f"), "left")
    there = F.col("_a").isNotNull()
    same = F.col(value).eqNullSafe(F.col("_v"))
    lost = F.col("_f").isNotNull()
    return j.agg(
        F.count_if(there | lost).alias("processed"), F.count_if(there & ~lost & ~same).alias("changed"), F.count_if(there & ~lost & same).alias("unchanged"),
        F.count_if(lost).alias("failed"), F.count_if(~there & ~lost).alias("skipped"),
    )
