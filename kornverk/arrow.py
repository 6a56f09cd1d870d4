"""Arrow-batched Python over DataFrame columns, and a few Spark helpers the operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Batches = Iterator[pa.RecordBatch]


def _schema(spark: SparkSession, schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def map_batches(df: DataFrame, fn: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow`` whose batches are cast to ``schema`` (a DDL string)."""
    spark_schema = _schema(df.sparkSession, schema)
    arrow = to_arrow_schema(spark_schema)

    def run(batches: Batches) -> Batches:
        for b in fn(batches):
            yield pa.RecordBatch.from_arrays([x if x.type == f.type else x.cast(f.type) for x, f in zip(b.columns, arrow)], schema=arrow)

    return df.mapInArrow(run, spark_schema)


def map_columns(df: DataFrame, fn: Callable[[dict[str, list]], dict], schema: str) -> DataFrame:
    """``fn`` gets each Arrow batch as lists by column and returns columns of any one length."""
    spark_schema = _schema(df.sparkSession, schema)
    arrow = to_arrow_schema(spark_schema)

    def run(batches: Batches) -> Batches:
        for b in batches:
            if b.num_rows:
                out = fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
                yield pa.RecordBatch.from_arrays([x if isinstance(x := out[f.name], pa.Array) else pa.array(x, type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, spark_schema)


def one_delivery(df: DataFrame, key: str, *values: str) -> DataFrame:
    """One row for each key: deliveries of one record are equal; of unequal ones the smallest values stand. Null keys are left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*values)).alias("_v")).select(key, *[F.col(f"_v.{v}").alias(v) for v in values])


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut, in the shared folder of ``spark.checkpoint.dir``; a folder of our own only where that is unset."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="kornverk-checkpoint-"))
    return df.checkpoint()
