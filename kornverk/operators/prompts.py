"""Prompts from a plan: a required expression, sampled optional terms and a scenario in a template; all draws are hashes of a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, text
from .ordering import numbered
from .records import max_counters


def draw(seed: int, *what: Column | str) -> Column:
    """A number from 0 to below 1 that depends on the seed and ``what`` alone."""
    parts = [F.col(c) if isinstance(c, str) else c for c in what]
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *[p.cast("string") for p in parts])), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def draw_key(seed: int, *what: Column | str) -> Column:
    """Text to sort by for a sample without replacement."""
    parts = [F.col(c) if isinstance(c, str) else c for c in what]
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def sample_rows(pool: DataFrame, n: int, seed: int, *key: str) -> DataFrame:
    """``n`` rows by the order of their draws; all of them again, as often as it takes, if the pool has fewer."""
    order = [draw_key(seed, *key), *map(F.col, key)]
    have = pool.count()
    if n <= have or not have:
        return pool.orderBy(*order).limit(n)
    rounds = -(-n // have)
    return pool.withColumn("_round", F.explode(F.sequence(F.lit(1), F.lit(rounds)))).orderBy("_round", *order).limit(n).drop("_round")


def scenarios(raw: DataFrame) -> DataFrame:
    """(scenario, number): the rows that have one, numbered from 0 in their order of text."""
    have = raw.where("Scenario <> ''").select(F.col("Scenario").alias("scenario"))
    return numbered(have, F.substring("scenario", 1, 4), [F.col("scenario")])


def flags(raw: DataFrame, *columns: str) -> DataFrame:
    """The scenario flags as numbers; what is no number is null."""
    return raw.where("Scenario <> ''").select(F.col("Scenario").alias("scenario"), *[F.col(f"`{c}`").try_cast("int").alias(c) for c in columns])


def prompt_sequence(plan: DataFrame, existing: DataFrame, all_needed: bool = False) -> DataFrame:
    """(term_id, term, counter, id): one prompt for each term that is still needed, or as many as it needs.

    Counters go on after the higher of the stored one and the highest that any existing prompt has, so that no id comes twice.
    """
    rows = plan.where((F.col("target_remaining") > 0) & ~text.is_blank("term") & ~text.is_blank("term_id"))
    zero = F.lit(0).cast("bigint")
    last = rows.join(max_counters(existing), "term_id", "left").withColumn("last", F.greatest(F.coalesce("counter", zero), F.coalesce("prompt_counter", zero)))
    n = F.col("target_remaining") if all_needed else F.lit(1).cast("bigint")
    each = last.select("term_id", "term", F.explode(F.sequence(F.col("last") + 1, F.col("last") + n)).alias("counter"))
    return each.select("term_id", "term", "counter", ids.prompt_id("term_id", "counter").alias("id"))


def with_counters(plan: DataFrame, sequence: DataFrame) -> DataFrame:
    """The plan with the highest counter that ``sequence`` gave out."""
    top = sequence.groupBy("term_id").agg(F.max("counter").alias("_top"))
    return plan.join(top, "term_id", "left").withColumn("prompt_counter", F.coalesce("_top", "prompt_counter")).select(plan.columns)


def usage_map(vocabulary: DataFrame, order: str = "rank") -> DataFrame:
    """(term, usage): of rows with one term the last counts."""
    rows = vocabulary.where(~text.is_blank("term"))
    return rows.groupBy("term").agg(F.max_by(F.filter(F.coalesce("usage", F.array().cast("array<string>")), lambda u: u.isNotNull()), F.struct(order, F.coalesce("usage", F.array().cast("array<string>")))).alias("usage"))


def expression(term: Column | str, usage: Column | str, seed: int, *what: Column | str) -> Column:
    """The term, or with even chance one of its phrases if it has any."""
    u = F.coalesce(F.col(usage) if isinstance(usage, str) else usage, F.array().cast("array<string>"))
    t = F.col(term) if isinstance(term, str) else term
    pick = F.get(u, F.floor(draw(seed + 1, *what) * F.size(u)).cast("int"))
    return F.when((F.size(u) > 0) & (draw(seed, *what) < 0.5), pick).otherwise(t)


def optional_terms(prompts: DataFrame, plan: DataFrame, k: int, seed: int, parts: int = 64) -> DataFrame:
    """(id, place, term): up to ``k`` different needed terms for each prompt, the required one among them by chance.

    The terms are dealt into numbered slots by their draws; a prompt takes ``k`` slots that follow each other from a drawn start, with
    a drawn step through them, so each prompt has its own sample and no prompt is joined with all terms.
    """
    pool = plan.where((F.col("target_remaining") > 0) & ~text.is_blank("term")).select("term").distinct()
    slots = numbered(pool.withColumn("_d", draw_key(seed, "term")), F.substring("_d", 1, 2), [F.col("_d"), F.col("term")], "slot").drop("_d")
    size = slots.agg(F.count("*")).scalar()
    start = F.floor(draw(seed, "id", F.lit("start")) * size).cast("bigint")
    each = prompts.select("id", start.alias("_s"), F.explode(F.sequence(F.lit(0), F.lit(max(k, 1) - 1))).alias("place")).where(F.lit(k > 0) & (F.col("place") < size))
    return each.withColumn("slot", F.pmod(F.col("_s") + F.col("place"), size)).join(slots, "slot").select("id", "place", "term")


def sampled_terms(prompts: DataFrame, pool: DataFrame, k: int, seed: int) -> DataFrame:
    """(id, place, term): the ``k`` terms of a *small* pool with the lowest draws for each prompt; an exact sample that SQL can repeat.

    Every prompt meets every term of the pool, so the pool is sent to all executors; it is an error if it has over 10,000 rows.
    """
    terms = [r.term for r in pool.select("term").distinct().limit(10_001).collect()]
    if len(terms) > 10_000:
        raise ValueError("the pool is too large for sampled_terms; take optional_terms")
    listed = F.array(*map(F.lit, sorted(terms))) if terms else F.array().cast("array<string>")
    drawn = F.slice(F.array_sort(F.transform(listed, lambda t: F.struct(F.md5(F.concat_ws("\x1f", F.lit(str(seed)), F.col("id"), t)).alias("d"), t.alias("t")))), 1, max(k, 1))
    return prompts.select("id", F.posexplode(drawn).alias("place", "x")).where(F.lit(k > 0)).select("id", F.col("place").cast("int").alias("place"), F.col("x.t").alias("term"))


def rendered(sequence: DataFrame, optional: DataFrame, usage: DataFrame, raw_scenarios: DataFrame, template: str, template_name: str, seed: int) -> DataFrame:
    """(id, template, prompt) of each row of ``sequence`` (id, term); ``optional`` (id, place, term) are its optional terms."""
    named = optional.join(usage, "term", "left").select("id", "place", expression("term", "usage", seed, "id", "place", "term").alias("e"))
    lists = named.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "e"))), lambda x: x["e"]), ", ").alias("snomed_optional"))
    stage = scenarios(raw_scenarios)
    count = stage.agg(F.count("*")).scalar()
    rows = sequence.join(usage, "term", "left").select("id", expression("term", "usage", seed, "id", "term").alias("snomed_required"), F.floor(draw(seed, "id", F.lit("scenario")) * count).cast("bigint").alias("number"))
    full = rows.join(lists, "id", "left").join(stage, "number", "left")
    values = {"scenario": F.coalesce("scenario", F.lit("")), "snomed_required": F.col("snomed_required"), "snomed_optional": F.coalesce("snomed_optional", F.lit(""))}
    return full.select("id", F.lit(template_name).alias("template"), text.fill_template(F.lit(template), values).alias("prompt"))


def round_robin(n: int, templates: list[tuple[str, str]], pool: DataFrame, raw_scenarios: DataFrame, seed: int, optional: int = 10) -> DataFrame:
    """(id, template, prompt): ``n`` prompts with raw phrases of ``pool`` (phrase), taking the templates (name, text) in turn."""
    spark = pool.sparkSession
    rows = spark.range(n).select(F.pmod("id", F.lit(len(templates))).cast("int").alias("t"), (F.floor(F.col("id") / len(templates)) + 1).alias("no"))
    name, body = (F.get(F.array(*[F.lit(x[i]) for x in templates]), F.col("t")) for i in (0, 1))
    base = rows.select(F.concat(F.element_at(F.split(name, r"\.[^.]*$"), 1), F.lit("_"), F.col("no").cast("string")).alias("id"), name.alias("template"), body.alias("body"))
    phrases = pool.select(F.col("phrase").alias("term")).distinct().withColumn("target_remaining", F.lit(1))
    drawn = optional_terms(base, phrases, optional + 1, seed)
    parts = drawn.groupBy("id").agg(F.max(F.when(F.col("place") == 0, F.col("term"))).alias("req"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("place") > 0, F.struct("place", "term")))), lambda x: x["term"]), ", ").alias("opt"))
    stage = scenarios(raw_scenarios)
    count = stage.agg(F.count("*")).scalar()
    full = base.join(parts, "id", "left").withColumn("number", F.floor(draw(seed, "id", F.lit("scenario")) * count).cast("bigint")).join(stage, "number", "left")
    none = F.lit("")
    return full.select("id", "template", text.fill_template("body", {"scenario": F.coalesce("scenario", none), "snomed_required": F.coalesce("req", none), "snomed_optional": F.coalesce("opt", none)}).alias("prompt"))


def per_prefix_numbers(rows: DataFrame, prefix: str, order: str) -> DataFrame:
    """``rows`` with ``counter``, from 1 within each prefix."""
    return rows.withColumn("counter", F.row_number().over(Window.partitionBy(prefix).orderBy(order)).cast("bigint"))
