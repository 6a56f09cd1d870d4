"""The loop that asks for answers until the plan is filled; each round is a set of tables of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import checkpointed
from ..operators import generate, plan, prompts, quality, records


def fill_plan(start: DataFrame, vocabulary: DataFrame, scenarios: DataFrame, template: str, model: Callable, limits: quality.Limits = quality.Limits(), optional: int = 10, rounds: int = 10, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plan, outputs, rejected) after at most ``rounds`` rounds: prompts for the terms still needed, answers, terms used, quality filter.

    A rejected answer is asked for again under a new id. Lineage is cut after each round.
    """
    spark = start.sparkSession
    now = start.withColumn("ord", F.xxhash64("term"))
    outputs = spark.createDataFrame([], "id string, template string, prompt string, result string, used_terms array<string>")
    asked = spark.createDataFrame([], "id string")
    rejected = spark.createDataFrame([], "id string, template string, prompt string, result string, used_terms array<string>, filter_reason string, stage int")
    usage = prompts.usage_map(vocabulary)
    for stage in range(rounds):
        if plan.is_complete(now).first().complete:
            break
        sequence = checkpointed(prompts.prompt_sequence(now, asked))
        made = prompts.rendered(sequence, prompts.optional_terms(sequence, now, optional, seed + stage), usage, scenarios, template, "loop", seed + stage)
        raw = checkpointed(generate.new_outputs(made, model).drop("error").withColumn("used_terms", F.lit(None).cast("array<string>")))
        terms = plan.evaluated(raw, now, "id")
        judged = checkpointed(quality.with_reasons(raw.drop("used_terms").join(terms, "id"), limits))
        outputs = checkpointed(records.merged(outputs, quality.accepted(judged)))
        rejected = checkpointed(records.merged(rejected, quality.rejected(judged).withColumn("stage", F.lit(stage))))
        asked = checkpointed(asked.unionByName(sequence.select("id")))
        now = checkpointed(plan.updated_plan(prompts.with_counters(now, sequence), outputs))
    return now.drop("ord"), outputs, rejected
