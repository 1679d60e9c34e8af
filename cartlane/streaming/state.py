"""The current rows of a table from its changes.

The change with the highest log position of a key counts, so repeats and records out of
order do no harm. A stream needs no state of its own for this: each trigger is reduced to
the last change per key and added to the table of changes, and readers take the last change
of each key there. Every few triggers the ranges of keys that changed are reduced to one row per key,
so what is read stays as large as the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartlane.sources.sinks import write_batch
from cartlane.streaming.versions import EVERY, Versions, add, reduce, reduce_before, rows_of


def latest_changes(changes: DataFrame) -> DataFrame:
    """The last change of each key, deletes included. Partial results go into the shuffle."""
    last = F.max_by(F.struct(*[c for c in changes.columns if c != "id"]), "lsn").alias("last")
    return changes.groupBy("id").agg(last).select("id", "last.*")


def current_state(changes: DataFrame) -> DataFrame:
    """The rows that exist after all changes."""
    return latest_changes(changes).filter("NOT deleted")


def without_repeats(changes: DataFrame, key: tuple[str, ...] = ("id", "lsn")) -> DataFrame:
    """One record of each key and log position, however often and however late it came.

    For a feed of several tables the key begins with the table. Taken from the written log, so
    nothing is forgotten and no record that comes late is lost.
    """
    rest = [c for c in changes.columns if c not in key]
    first = F.min(F.struct(*rest)).alias("first")
    return changes.groupBy(*key).agg(first).select(*[c if c in key else F.col(f"first.{c}") for c in changes.columns])


def write_changes(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs the stream over what is there and adds all its records to the log. No shuffle, no state."""
    return (
        changes.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
        .trigger(availableNow=True)
        .start()
    )


def _table(path: str) -> Versions:
    return Versions(path, ("id",), "lsn")


def write_state(changes: DataFrame, path: str, checkpoint: str, every: int = EVERY) -> StreamingQuery:
    """Runs the stream over what is there: each trigger adds the keys that changed.

    A trigger that is run again after a failure replaces its own folder.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        reduce_before(batch.sparkSession, _table(path), batch_id, every)
        add(_table(path), latest_changes(batch), batch_id)

    return (
        changes.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(merge)
        .trigger(availableNow=True)
        .start()
    )


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The current rows from what ``write_state`` wrote."""
    return rows_of(spark, _table(path)).filter("NOT deleted")


def compact_state(spark: SparkSession, path: str, upto: int) -> None:
    """Reduces the changes up to and including trigger ``upto`` to the last one of each key.

    Only the ranges of keys that changed are read and written. Deletes stay in it, since a record
    out of order may still come.
    """
    reduce(spark, _table(path), upto)
