"""Numbers for rows without sorting the whole table in one task.

Keys to be stored come from ranges of the rows' own keys, as many as there are partitions. Rows to
be drawn from (``counted_and_numbered``) go to hash buckets of their key, a function of the row
alone, so that a plan needs no table in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartlane.functions.draws import draw
from cartlane.plans.scratch import written

BUCKETS = 4096

_BUCKET = "__bucket"
_BEFORE = "__before"
_PLACE = "__place"
_SEED = "number"


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(draw(_SEED, *keys), F.lit(buckets)))


def _rank_in_bucket(keys: list[str]) -> Column:
    return F.row_number().over(W.partitionBy(_BUCKET).orderBy(*keys)).cast("bigint")


def counted_and_numbered(
    df: DataFrame, keys: list[str], name: str, start=1, buckets: int = BUCKETS
) -> tuple[Column, DataFrame]:
    """The number of rows, as a scalar subquery, and the rows numbered without gaps.

    Both come from one count per bucket, so Spark runs that count once for the two.
    """
    rows = _bucketed(df, keys, buckets)
    sizes = rows.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    total = sizes.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n")).scalar()
    # At most ``buckets`` rows, so the single-task window and the broadcast are bounded.
    running = W.orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(_BUCKET, F.coalesce(F.sum("__n").over(running), F.lit(0)).alias(_BEFORE))
    first = start if isinstance(start, Column) else F.lit(start)
    table = (
        rows.withColumn(name, _rank_in_bucket(keys))
        .join(F.broadcast(offsets), _BUCKET)
        .withColumn(name, (F.col(name) + F.col(_BEFORE) + first - 1).cast("bigint"))
        .drop(_BUCKET, _BEFORE)
    )
    return total, table


def next_id(existing: DataFrame, column: str = "id") -> Column:
    """The first key above those in a table, 1 for an empty table."""
    top = existing.agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint").alias("top"))
    return top.scalar() + 1


def with_surrogate_key(
    df: DataFrame, keys: list[str], name: str = "id", existing: DataFrame | None = None, start=None
) -> DataFrame:
    """Adds a key above all keys of ``existing``, without gaps, in order of ``keys``.

    The rows go to ranges of ``keys`` once and are written there with their place; counts of
    the ranges give each its first number. A batch that may be run again passes the ``start``
    recorded for it (see ``sinks.batch_start``) and gets the same keys as before.
    """
    if start is None:
        start = 1 if existing is None else next_id(existing, name)
    first = start if isinstance(start, Column) else F.lit(start)
    # The place is the number of the range and, in the low 33 bits, of the row in it.
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_PLACE, F.monotonically_increasing_id())
    rows = written(placed, "keys")
    part = F.shiftright(_PLACE, 33)
    sizes = rows.groupBy(part.alias(_BUCKET)).agg(F.count(F.lit(1)).alias("__n"))
    running = W.orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    # One row per range.
    offsets = F.broadcast(sizes.select(_BUCKET, F.coalesce(F.sum("__n").over(running), F.lit(0)).alias(_BEFORE)))
    inside = F.col(_PLACE).bitwiseAND(F.lit(2**33 - 1))
    return (
        rows.withColumn(_BUCKET, part)
        .join(offsets, _BUCKET)
        .withColumn(name, (inside + F.col(_BEFORE) + first).cast("bigint"))
        .drop(_BUCKET, _BEFORE, _PLACE)
    )
