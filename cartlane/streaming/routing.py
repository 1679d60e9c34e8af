"""One folder per table from a feed of all tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartlane.sources.sinks import BATCH
from cartlane.streaming.envelope import table_of


def _write(batch: DataFrame, path: str, batch_id: int) -> None:
    batch.write.mode("overwrite").partitionBy("source_table").text(f"{path}/{BATCH}={batch_id}")


def route_by_table(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the records undecoded, each under its table's name, in one pass.

    No shuffle: every task writes what it holds, so a busy table is spread over all tasks.
    """
    return (
        table_of(raw)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: _write(batch, path, batch_id))
        .trigger(availableNow=True)
        .start()
    )


def routed(spark: SparkSession, path: str, table_name: str) -> DataFrame:
    """The routed records of one table, to be decoded."""
    return spark.read.text(path).filter(F.col("source_table") == table_name).select("value")
