"""Records that the plan doesn't need go, rejected ones that it does need come back: greedy scans in a fixed order, run in parallel rounds.

Both scans look at records one after another. Removing: a record goes if each of its terms can spare one more; of the undecided
records with a term, as many as it can spare may all go, whatever is decided for the others, and none may once it can spare
none. So in each round every record within the spare number of all its terms goes, every record with a term without spare stays, and
the counts are brought up to date. The first undecided record is always decided, and the result is that of the scan. Restoring
is the same with what terms lack: a record within the lack of any of its terms comes back, one whose terms lack nothing doesn't.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..arrow import checkpointed
from ..functions import ids
from .ordering import numbered
from .plan import distinct_terms, presence_counts, required_counts


def prune_order(records: DataFrame, order: str) -> DataFrame:
    """``records`` with ``turn``, from 0: the latest generation first, then by prefix and place, from the last."""
    keyed = records.withColumn("_g", -ids.generation("id")).withColumn("_p", ids.generation_prefix("id"))
    return numbered(keyed, F.col("_g"), [F.desc("_p"), F.desc(order)], "turn").drop("_g", "_p")


def _within(pairs: DataFrame) -> DataFrame:
    """(turn, term) pairs with ``place``, from 1, of each among the undecided records of its term, counted in blocks of turns."""
    block = pairs.withColumn("_b", F.floor(F.col("turn") / 65_536))
    sizes = block.groupBy("term", "_b").agg(F.count("*").alias("_n"))
    before = sizes.select("term", "_b", (F.sum("_n").over(Window.partitionBy("term").orderBy("_b")) - F.col("_n")).alias("_before"))
    own = block.withColumn("_own", F.row_number().over(Window.partitionBy("term", "_b").orderBy("turn")))
    return own.join(before, ["term", "_b"]).withColumn("place", F.col("_before") + F.col("_own")).drop("_b", "_own", "_before")


def never_removable(records: DataFrame, plan: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """(key): records with a term that is needed as often as it stands."""
    spare = presence_counts(records).join(required_counts(plan, order), "term", "left").where(F.col("used") - 1 < F.coalesce("required", F.lit(0)))
    return records.select(key, F.explode(distinct_terms("used_terms")).alias("term")).join(spare, "term", "left_semi").select(key).distinct()


def binding_terms(records: DataFrame, plan: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """(term, spare): terms that would fall below their need if all records went that can go at all."""
    open_ = records.join(never_removable(records, plan, key, order), key, "left_anti")
    all_ = presence_counts(records).join(required_counts(plan, order), "term", "left").withColumn("spare", F.col("used") - F.coalesce("required", F.lit(0)))
    return all_.join(presence_counts(open_).withColumnRenamed("used", "open"), "term").where(F.col("open") > F.col("spare")).select("term", "spare")


def pruned(records: DataFrame, plan: DataFrame, order: str, plan_order: str | None = None) -> DataFrame:
    """(order, reason) of every record that goes: ``missing`` where it has no terms, else ``saturated``.

    ``order`` is a unique place of each record. Null lists have no terms. The counts that remain are checked against the need.
    """
    turns = checkpointed(prune_order(records.select(order, "id", "used_terms"), order))
    base = turns.select("turn", F.explode(distinct_terms("used_terms")).alias("term"))
    spare = presence_counts(turns).join(required_counts(plan, plan_order), "term", "left").select("term", (F.col("used") - F.coalesce("required", F.lit(0))).alias("spare"))
    undecided = checkpointed(base)
    spare = checkpointed(spare)
    gone = None
    while not undecided.isEmpty():
        placed = _within(undecided).join(spare, "term")
        verdict = placed.groupBy("turn").agg(F.bool_and(F.col("place") <= F.col("spare")).alias("goes"), F.bool_or(F.col("spare") <= 0).alias("stays")).where("goes OR stays")
        verdict = checkpointed(verdict)
        now = verdict.where("goes").select("turn")
        gone = now if gone is None else gone.unionByName(now)
        taken = undecided.join(now, "turn", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
        spare = checkpointed(spare.join(taken, "term", "left").select("term", (F.col("spare") - F.coalesce("n", F.lit(0))).alias("spare")))
        undecided = checkpointed(undecided.join(verdict, "turn", "left_anti"))
    bare = turns.where(F.size(distinct_terms("used_terms")) == 0).select(order, F.lit("missing").alias("reason"))
    if gone is None:
        return bare
    out = turns.join(gone, "turn", "left_semi").select(order, F.lit("saturated").alias("reason")).unionByName(bare)
    kept = records.join(out, order, "left_anti")
    short = coverage_shortfall(records, kept, plan, plan_order)
    if not short.isEmpty():
        raise ValueError(f"pruning left terms below their need: {[r.term for r in short.limit(20).collect()]}")
    return out


def coverage_shortfall(before: DataFrame, after: DataFrame, plan: DataFrame, order: str | None = None) -> DataFrame:
    """(term): terms that ``after`` has less often than needed although ``before`` had them."""
    was, now = presence_counts(before).withColumnRenamed("used", "was"), presence_counts(after).withColumnRenamed("used", "now")
    zero = F.lit(0)
    both = required_counts(plan, order).join(was, "term", "left").join(now, "term", "left")
    return both.where(F.coalesce("now", zero) < F.least(F.coalesce("was", zero), F.col("required"))).select("term")


def restore_candidates(rejected: DataFrame, outputs: DataFrame, reasons: list[str], passes: DataFrame, order: str) -> DataFrame:
    """``rejected`` with ``verdict``: ``reason``, ``invalid``, ``obsolete``, ``existing`` or ``candidate``.

    ``passes`` (order) are the rows that pass the quality filter. Of candidates with one id only the first counts as one.
    """
    bad = rejected.where(F.startswith("filter_reason", F.lit("obsolete")) & F.col("id").isNotNull()).select(F.col("id").alias("_bad")).distinct()
    have = outputs.where("id IS NOT NULL").select(F.col("id").alias("_have")).distinct()
    ok = passes.select(F.col(order).alias("_ok"))
    flags = rejected.join(bad, F.col("id") == F.col("_bad"), "left").join(have, F.col("id") == F.col("_have"), "left").join(ok, F.col(order) == F.col("_ok"), "left")
    may = F.coalesce(F.col("filter_reason").isin(*reasons), F.lit(False))
    judged = flags.withColumn(
        "verdict",
        F.when(~may, "reason").when(F.coalesce(F.col("id") == "", F.lit(True)), "invalid").when(F.col("_bad").isNotNull(), "obsolete")
        .when(F.col("_have").isNotNull(), "existing").when(F.col("_ok").isNull(), "invalid").otherwise("candidate"),
    ).drop("_bad", "_have", "_ok")
    return judged


def restored(rejected: DataFrame, outputs: DataFrame, reasons: list[str], passes: DataFrame, order: str, plan: DataFrame | None = None, plan_order: str | None = None) -> DataFrame:
    """(order, verdict) of every rejected row; ``restored`` where it comes back, ``existing`` where its id is already there or came back before, ``redundant`` where the plan needs none of its terms."""
    judged = checkpointed(restore_candidates(rejected, outputs, reasons, passes, order).select(order, "id", "used_terms", "verdict"))
    rows = judged.where("verdict = 'candidate'")
    w = Window.partitionBy("id").orderBy(order)
    if plan is None:
        first = rows.select(order, F.when(F.row_number().over(w) == 1, "restored").otherwise("existing").alias("verdict"))
        return judged.where("verdict <> 'candidate'").select(order, "verdict").unionByName(first)
    zero = F.lit(0)
    lack = required_counts(plan, plan_order).join(presence_counts(outputs), "term", "left").select("term", (F.col("required") - F.coalesce("used", zero)).alias("lack"))
    lack = checkpointed(lack)
    open_ = checkpointed(rows.select(F.col(order).alias("turn"), "id", distinct_terms("used_terms").alias("terms")))
    done: list[DataFrame] = []
    while not open_.isEmpty():
        # one row of each id at a time, so that a later one with the same id sees what became of the first
        heads = open_.withColumn("_r", F.row_number().over(Window.partitionBy("id").orderBy("turn")))
        pairs = open_.select("turn", F.explode("terms").alias("term"))
        placed = _within(pairs).join(lack, "term")
        needed = placed.groupBy("turn").agg(F.bool_or(F.col("place") <= F.col("lack")).alias("back"), F.bool_or(F.col("lack") > 0).alias("maybe"))
        judged_now = heads.where("_r = 1").join(needed, "turn", "left").select("turn", "id", "terms", F.coalesce("back", F.lit(False)).alias("back"), F.coalesce("maybe", F.lit(False)).alias("maybe")).where("back OR NOT maybe")
        now = checkpointed(judged_now)
        back = now.where("back")
        later = open_.join(back.select("id", F.col("turn").alias("_first")), "id").where("turn > _first").select("turn")
        done += [back.select("turn", F.lit("restored").alias("verdict")), now.where("NOT back").select("turn", F.lit("redundant").alias("verdict")), checkpointed(later).withColumn("verdict", F.lit("existing"))]
        gained = back.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
        lack = checkpointed(lack.join(gained, "term", "left").select("term", (F.col("lack") - F.coalesce("n", zero)).alias("lack")))
        open_ = checkpointed(open_.join(now.select("turn"), "turn", "left_anti").join(done[-1].select("turn"), "turn", "left_anti"))
    out = judged.where("verdict <> 'candidate'").select(order, "verdict")
    for d in done:
        out = out.unionByName(d.select(F.col("turn").alias(order), "verdict"))
    return out
