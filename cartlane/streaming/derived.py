"""Sums that follow a change feed.

An update brings the new row only. So the last row of each key is kept; a trigger looks up the rows
it replaces, takes them back with the sign -1 and puts in the new ones with +1. The signed rows
are summed by what is asked for, and the sums are added to those stored. A trigger reads and writes
the keys it holds. Records that come late or again change nothing, as the row kept has their log
position or a later one; a trigger that is run again finds everything as it was before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlane.plans.scratch import written
from cartlane.streaming.state import latest_changes
from cartlane.streaming.versions import Versions, add, reduce_before, rows_of

SIGN = "sign"


def signed_changes(changes: DataFrame, images: Versions, batch_id: int) -> DataFrame:
    """The rows of a trigger that come (``sign`` 1) and go (-1), deleted ones not among them.

    ``changes`` has the columns of ``images``, whose order is the log position. The rows are added to
    ``images``.
    """
    spark = changes.sparkSession
    reduce_before(spark, images, batch_id)
    columns = changes.columns
    last = written(latest_changes(changes), "last")
    before = rows_of(spark, images, batch_id, last.select("id")).select("id", F.struct(*columns).alias("__old"))
    found = last.join(before, "id", "left").filter(F.col("__old").isNull() | (F.col("lsn") > F.col("__old.lsn")))
    found = written(found, "found")
    add(images, found.select(*columns), batch_id)
    came = found.select(*columns, F.lit(1).alias(SIGN))
    went = found.filter("__old IS NOT NULL").select("__old.*", F.lit(-1).alias(SIGN))
    return came.unionByName(went).filter("NOT deleted")


def add_sums(sums: DataFrame, stored: Versions, batch_id: int) -> None:
    """Adds the sums of a trigger, one row per key, to those stored; ``version`` orders them."""
    spark = sums.sparkSession
    reduce_before(spark, stored, batch_id)
    values = [c for c in sums.columns if c not in stored.key]
    sums = written(sums, "sums")
    before = rows_of(spark, stored, batch_id, sums.select(*stored.key)).drop("version")
    before = before.withColumnsRenamed({v: f"__{v}" for v in values})
    kinds = dict(sums.dtypes)
    total: dict[str, Column] = {v: (F.col(v) + F.coalesce(f"__{v}", F.lit(0))).cast(kinds[v]) for v in values}
    whole = sums.join(before, list(stored.key), "left").withColumns(total).select(*sums.columns)
    add(stored, whole.withColumn("version", F.lit(batch_id).cast("long")), batch_id)
