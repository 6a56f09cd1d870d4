"""Summaries of speech-quality scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def to_hundred(mos: Column | str) -> Column:
    return ((F.col(mos) if isinstance(mos, str) else mos) - 1) * 25


def scored(scores: DataFrame) -> DataFrame:
    return scores.where("ok")


def failed(scores: DataFrame) -> DataFrame:
    return scores.where("NOT ok")


def summary(scores: DataFrame) -> DataFrame:
    """(files_total, files_scored, files_failed, mos_mean, mos_median, mos_std, duration_hours); mean, median and deviation are NaN where too few rows have a score."""
    ok = F.col("ok")
    mos = F.when(ok, F.col("mos"))
    nan = F.lit(float("nan"))
    return scores.agg(
        F.count("*").alias("files_total"), F.count_if(ok).alias("files_scored"), F.count_if(~ok).alias("files_failed"), F.coalesce(F.avg(mos), nan).alias("mos_mean"),
        F.coalesce(F.median(mos), nan).alias("mos_median"), F.coalesce(F.stddev_samp(mos), nan).alias("mos_std"), (F.coalesce(F.sum(F.when(ok, F.col("duration_s"))), F.lit(0.0)) / 3600).alias("duration_hours"),
    )


def described(scores: DataFrame, value: str = "mos") -> DataFrame:
    """(count, mean, std, min, p25, p50, p75, max) of the values that aren't null; quartiles are exact and linear."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return scores.agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), F.max(value).alias("max"))


def box_plot(scores: DataFrame, value: str = "mos") -> DataFrame:
    """(low, q1, median, q3, high): quartiles, and the outermost values within 1.5 times their distance."""
    d = described(scores, value).select("p25", "p50", "p75")
    reach = 1.5 * (F.col("p75") - F.col("p25"))
    inside = scores.select(value).join(F.broadcast(d)).where((F.col(value) >= F.col("p25") - reach) & (F.col(value) <= F.col("p75") + reach))
    return inside.agg(F.min(value).alias("low"), F.any_value("p25").alias("q1"), F.any_value("p50").alias("median"), F.any_value("p75").alias("q3"), F.max(value).alias("high"))


def histogram(scores: DataFrame, bins: int = 20, value: str = "mos") -> DataFrame:
    """(bin, low, high, n) with all bins of equal width between the least and the greatest value; the last bin holds the greatest."""
    lo, hi = scores.agg(F.min(value)).scalar(), scores.agg(F.max(value)).scalar()
    width = (hi - lo) / bins
    at = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.lit(bins - 1), F.floor((F.col(value) - lo) / F.nullif(width, F.lit(0.0))).cast("int")))
    counts = scores.where(F.col(value).isNotNull()).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    every = scores.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").where(lo.isNotNull()).select("bin", (lo + F.col("bin") * width).alias("low"), (lo + (F.col("bin") + 1) * width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def extremes(scores: DataFrame, n: int = 10, best: bool = True, value: str = "mos") -> DataFrame:
    """The ``n`` best or worst scored files, ties by path."""
    order = F.desc(value) if best else F.asc(value)
    return scored(scores).where(F.col(value).isNotNull()).orderBy(order, "rel_path").limit(n).select("rel_path", "mos", "mos_0_100", "duration_s")


def first_files(files: DataFrame, n: int, path: str = "path") -> DataFrame:
    """The first ``n`` files by path; all for 0."""
    return files.orderBy(path).limit(n) if n else files.orderBy(path)
