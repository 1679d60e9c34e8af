"""Running totals and neighbours inside a group, for groups of any size.

A window over a group runs in one task, which stops a job when one group holds a third of a
large table. So rows are cut into ranges by group and order first, all of about one size: a large
group spreads over many ranges, small ones share one. A window then runs inside each range,
and what ranges before (or after) contribute is joined to the groups that reach over an edge. There
is one such group per edge at most, so those joins are as small as the number of ranges.

There is one plan for all sizes. Nulls are ordinary values, in groups and in orders: first of all,
and equal to each other.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartlane.plans.scratch import written

RANGE = "__range"


def ranged(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The rows with the number of their range, as a scratch table.

    It is written once, as two computations of the cuts need not agree. The functions below take
    such rows as they are, and cut others themselves; a filter leaves the ranges valid.
    """
    cut = df.repartitionByRange(*group, *order).withColumn(RANGE, F.spark_partition_id())
    return written(cut, "ranges")


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[f"__{c}"]) for c in columns])


def _aliased(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"__{c}") for c in columns], *keep)


def _over_edges(rows: DataFrame, group: list[str]) -> DataFrame:
    """The groups that lie in more than one range: one per edge at most."""
    whole = F.struct(*group)
    ends = rows.groupBy(RANGE).agg(F.min(whole).alias("low"), F.max(whole).alias("high"))
    # One row per range.
    before = F.lag("high").over(W.orderBy(RANGE))
    found = ends.withColumn("before", before).filter(F.col("before").isNotNull() & (F.col("before") == F.col("low")))
    return found.select("low.*").distinct()


def _pieces(rows: DataFrame, group: list[str], piece: Column) -> DataFrame:
    """``piece``, an aggregate, of each range of the groups that reach over an edge."""
    over = F.broadcast(_aliased(_over_edges(rows, group), group))
    return rows.join(over, _same(rows, over, group), "left_semi").groupBy(*group, RANGE).agg(piece.alias("__piece"))


def _joined(rows: DataFrame, pieces: DataFrame, group: list[str]) -> DataFrame:
    """``__piece`` of the row's group and range. Not more rows than ranges and edges are sent."""
    keys = [*group, RANGE]
    few = F.broadcast(_aliased(pieces.filter("__piece IS NOT NULL"), keys, "__piece"))
    return rows.join(few, _same(rows, few, keys), "left").drop(*[f"__{c}" for c in keys])


def running_total(df: DataFrame, group: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the group's rows up to and including this one.

    ``order`` must be total inside a group.
    """
    rows = df if RANGE in df.columns else ranged(df, group, order)
    earlier = W.partitionBy(*group).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    before = _pieces(rows, group, F.sum(value)).withColumn("__piece", F.sum("__piece").over(earlier))
    inside = W.partitionBy(*group, RANGE).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = _joined(rows.withColumn(name, F.sum(value).over(inside)), before, group)
    total = counted.withColumn(name, F.col(name) + F.coalesce("__piece", F.lit(0))).drop("__piece")
    return total if rows is df else total.drop(RANGE)


def numbered_in_group(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Adds 1, 2, ... in order inside each group."""
    return running_total(df, group, order, F.lit(1).cast("bigint"), name)


def neighbour(
    df: DataFrame, group: list[str], order: list[str], columns: list[str], name: str, following: bool = False
) -> DataFrame:
    """Adds a struct of ``columns`` of the row before (or after) in the group, null at the end."""
    rows = df if RANGE in df.columns else ranged(df, group, order)
    step, pick = (F.lead, F.min_by) if following else (F.lag, F.max_by)
    taken = F.struct(*columns)
    edges = _pieces(rows, group, pick(taken, F.struct(*order)))
    edges = edges.withColumn("__piece", step("__piece").over(W.partitionBy(*group).orderBy(RANGE)))
    local = rows.withColumn(name, step(taken).over(W.partitionBy(*group, RANGE).orderBy(*order)))
    found = _joined(local, edges, group).withColumn(name, F.coalesce(name, "__piece")).drop("__piece")
    return found if rows is df else found.drop(RANGE)
