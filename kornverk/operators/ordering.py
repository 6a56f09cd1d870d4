"""Global order without one task that sees all rows: counts of buckets first, then rows within each bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, bucket: Column, order: list[Column], name: str = "number") -> DataFrame:
    """``df`` with its 0-based place in the order of (``bucket``, ``order``); only the counts of buckets are ordered as a whole."""
    at = df.withColumn("_bucket", bucket)
    sizes = at.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("_bucket").alias("_b"), (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_before"))
    own = at.withColumn("_own", F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)) - 1)
    joined = own.join(before, F.col("_bucket").eqNullSafe(F.col("_b")))
    return joined.withColumn(name, F.col("_before") + F.col("_own")).drop("_bucket", "_b", "_before", "_own")


def max_rank(df: DataFrame, score: str, name: str = "rank") -> DataFrame:
    """``df`` with the number of rows whose score is as high or higher; only the different scores are ordered as a whole."""
    scores = df.groupBy(F.col(score).alias("_s")).agg(F.count("*").alias("_n"))
    upto = scores.select("_s", F.sum("_n").over(Window.orderBy(F.desc("_s"))).alias(name))
    return df.join(upto, F.col(score).eqNullSafe(F.col("_s"))).drop("_s")


def first_seen(df: DataFrame, value: str, order: str) -> DataFrame:
    """(value, order): every different value with the place where it first stands."""
    return df.groupBy(value).agg(F.min(order).alias(order))
