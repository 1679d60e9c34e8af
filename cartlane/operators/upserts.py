"""Insert if new, update by key."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``; rows with a null in the key all stay, as nulls
    never equal each other in a unique key.

    The limit of one row is applied before the shuffle too, so a frequent key sends at most
    one row per task. Rows with a null key are not shuffled; where the key cannot be null,
    Spark leaves their part out.
    """
    group = W.partitionBy(*key).orderBy(*order)
    ranked = rows.dropna(subset=key).withColumn(_RANK, F.row_number().over(group))
    without_key = reduce(or_, [F.col(k).isNull() for k in key])
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK).unionByName(rows.filter(without_key))


def insert_new(batch: DataFrame, target: DataFrame | None, key: list[str], order: list[str]) -> DataFrame:
    """The rows of a batch to append to ``target``: new keys only, the first row of each.

    ``order`` is total over the batch. The target's keys are cut down to those of the batch
    first: for a small batch that is a broadcast of the batch instead of a shuffle of the
    target, for a large one the second join finds both sides in place. Keys are made distinct
    before they meet, as no join can split a frequent key on the side that is looked up.
    """
    first = first_per_key(batch, key, order)
    if target is None:
        return first
    known = target.select(*key).join(batch.select(*key).distinct(), key, "left_semi")
    return first.join(known, key, "left_anti")


def rejected(batch: DataFrame, inserted: DataFrame, row_key: list[str]) -> DataFrame:
    """The rows of a batch that ``insert_new`` left out."""
    return batch.join(inserted.select(*row_key), row_key, "left_anti")


def update_by_key(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    columns: list[str],
    order: list[str] | None = None,
) -> DataFrame:
    """The target with ``columns`` replaced where ``updates`` has its key.

    With ``order``, which has to be total, the last of several updates of a key counts. Without it
    a key that is updated twice is an error.
    """
    updates = updates.filter(F.col(key).isNotNull())
    new = F.struct(*columns)
    if order is None:
        twice = F.raise_error(F.concat(F.lit(f"{key} is updated twice: "), F.col(key).cast("string")))
        found = updates.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.first(new).alias("__new"))
        last = found.select(key, F.when(F.col("__n") > 1, twice.cast(found.schema["__new"].dataType)).otherwise(F.col("__new")).alias("__new"))
    else:
        last = updates.groupBy(key).agg(F.max_by(new, F.struct(*order)).alias("__new"))
    changed = {c: F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)) for c in columns}
    return target.join(last, key, "left").withColumns(changed).select(*target.columns)
