"""Steps that go on where they stopped: a folder as a stream, every row once, results appended."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.records import not_completed


def resumable(spark: SparkSession, source: str | Path, schema: str, target: str | Path, state: str | Path, step: Callable[[DataFrame], DataFrame], key: str = "id") -> StreamingQuery:
    """Runs ``step`` over the JSON lines of ``source`` that are new since the last call, and appends Parquet to ``target``.

    A batch that is run again after a loss leaves out the ids that ``target`` already has.
    """

    def write(batch: DataFrame, _: int) -> None:
        done = spark.read.parquet(str(target)) if any(Path(target).glob("*.parquet")) else None
        step(batch if done is None else not_completed(batch, done, key)).write.mode("append").parquet(str(target))

    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.jsonl").json(str(source))
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", str(state)).trigger(availableNow=True).start()
