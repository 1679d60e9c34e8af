"""Writes that can be repeated: a batch id names a folder, and a rerun replaces it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlane.plans.keys import next_id
from cartlane.plans.scratch import children as names_in
from cartlane.plans.scratch import exists, remove

BATCH = "batch_id"

# Spark's readers pass over names that begin with this.
_STARTS = "_starts"


def append(df: DataFrame, path: str) -> None:
    """Adds rows once more each time it runs; a job that may be retried uses ``write_batch``."""
    df.write.mode("append").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Adds a batch, or replaces it if the same id was written before."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """All batches of a path; with ``schema`` (of a batch), no rows where nothing was written yet."""
    if schema is None:
        return spark.read.parquet(path)
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    whole = T.StructType([*fields.fields, T.StructField(BATCH, T.IntegerType())])
    if not any(name.startswith(f"{BATCH}=") for name in names_in(spark, path)):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path)


def batch_start(existing: DataFrame, path: str, batch_id: int, column: str = "id") -> int:
    """The first key of a batch: above all keys of ``existing`` when it is first asked for.

    It is written beside the batches, so a batch that is run again, before or after it and others
    were stored, gets the keys it had.
    """
    spark = existing.sparkSession
    place = f"{path}/{_STARTS}/{BATCH}={batch_id}"
    if not exists(spark, f"{place}/_SUCCESS"):
        spark.range(1).select(next_id(existing, column).alias("start")).write.mode("overwrite").parquet(place)
    return spark.read.schema("start long").parquet(place).first()["start"]


def read_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(f"{path}/{BATCH}={batch_id}")


def write_parent_and_child(
    parents: DataFrame, children: DataFrame, parent_path: str, child_path: str, batch_id: int
) -> None:
    """Writes the children, then the parents. A batch counts once its parents are there.

    When a batch is run again its old parents go first, so that they never count beside children
    that are being replaced.
    """
    withdraw(parents.sparkSession, parent_path, batch_id)
    write_batch(children, child_path, batch_id)
    write_batch(parents, parent_path, batch_id)


def withdraw(spark: SparkSession, path: str, batch_id: int) -> None:
    """Takes a batch away, if it is there."""
    remove(spark, f"{path}/{BATCH}={batch_id}")


def read_children(
    spark: SparkSession, parent_path: str, child_path: str, child_key: str, parent_key: str = "id"
) -> DataFrame:
    """The children whose parent was written, so half-written batches stay unseen."""
    parents = read_batches(spark, parent_path).select(F.col(parent_key).alias(child_key), BATCH)
    return read_batches(spark, child_path).join(parents, [child_key, BATCH], "left_semi")
