"""A keyed table that triggers add to: the row of a key with the largest ``order`` counts.

Keys lie in buckets, ranges of a number, a folder each. A trigger adds a folder with its rows in
their buckets, and replaces it when it is run again. A reduction leaves one row per key; it reads and
writes the buckets that changed since the one before, and those only. A reader takes the last
reduction of each bucket and the triggers after it, or just the buckets of the keys it asks for.

A trigger reduces what came before it, never its own rows: those are still to be read without it
if it has to run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlane.plans.scratch import children, exists, remove
from cartlane.sources.sinks import BATCH

#: Numbers in a bucket, and triggers between two reductions.
WIDTH, EVERY = 1 << 20, 16

_BUCKET, _UPTO = "bucket", "upto"


@dataclass(frozen=True)
class Versions:
    """Where the table is, its key, the number that buckets are ranges of, and what orders versions.

    ``schema`` is DDL; without it the files tell.
    """

    path: str
    key: tuple[str, ...]
    order: str
    schema: str | None = None
    number: str = "id"
    width: int = WIDTH

    def bucket(self) -> Column:
        return F.floor(F.col(self.number) / F.lit(self.width)).cast("long")


def add(table: Versions, rows: DataFrame, batch_id: int) -> None:
    """Adds the rows of a trigger, or replaces them."""
    # Rebalancing makes files of an even size, whatever a bucket holds.
    dealt = rows.withColumn(_BUCKET, table.bucket()).hint("rebalance", _BUCKET)
    dealt.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{table.path}/changes/{BATCH}={batch_id}")


def _numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of finished folders ``name=number``, in order."""
    found = [n.split("=")[1] for n in children(spark, path) if n.startswith(f"{name}=")]
    return sorted(int(n) for n in found if exists(spark, f"{path}/{name}={n}/_SUCCESS"))


def _buckets(spark: SparkSession, folder: str) -> set[int]:
    return {int(n.split("=")[1]) for n in children(spark, folder) if n.startswith(f"{_BUCKET}=")}


def _reduced(spark: SparkSession, table: Versions) -> dict[int, list[int]]:
    """The reductions that hold each bucket, the last one first."""
    out: dict[int, list[int]] = {}
    for upto in reversed(_numbered(spark, f"{table.path}/compacted", _UPTO)):
        for bucket in _buckets(spark, f"{table.path}/compacted/{_UPTO}={upto}"):
            out.setdefault(bucket, []).append(upto)
    return out


def _folders(spark: SparkSession, table: Versions, before: int | None, wanted: set[int] | None) -> tuple[list[str], list[str]]:
    """Folders of the last reductions, and of the triggers after them."""
    path = table.path
    reduced = {b: upto for b, upto in _reduced(spark, table).items() if wanted is None or b in wanted}
    done = max(_numbered(spark, f"{path}/compacted", _UPTO), default=-1)
    old = [f"{path}/compacted/{_UPTO}={upto[0]}/{_BUCKET}={b}" for b, upto in sorted(reduced.items())]
    new = []
    for batch_id in _numbered(spark, f"{path}/changes", BATCH):
        if batch_id > done and (before is None or batch_id < before):
            there = _buckets(spark, f"{path}/changes/{BATCH}={batch_id}")
            new += [f"{path}/changes/{BATCH}={batch_id}/{_BUCKET}={b}" for b in sorted(there if wanted is None else there & wanted)]
    return old, new


def _read(spark: SparkSession, table: Versions, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], table.schema)
    reader = spark.read if table.schema is None else spark.read.schema(table.schema)
    return reader.parquet(*folders)


def _latest(rows: DataFrame, table: Versions) -> DataFrame:
    rest = [c for c in rows.columns if c not in table.key]
    last = F.max_by(F.struct(*rest), table.order).alias("last")
    return rows.groupBy(*table.key).agg(last).select(*[c if c in table.key else F.col(f"last.{c}") for c in rows.columns])


def buckets_of(keys: DataFrame, table: Versions) -> set[int]:
    """The buckets that hold some keys: as many numbers as there are buckets at most."""
    return {r[0] for r in keys.select(table.bucket().alias(_BUCKET)).distinct().collect()}


def added(spark: SparkSession, table: Versions, batch_id: int) -> DataFrame:
    """The rows that a trigger has added."""
    folder = f"{table.path}/changes/{BATCH}={batch_id}"
    return _read(spark, table, [f"{folder}/{_BUCKET}={b}" for b in sorted(_buckets(spark, folder))])


def additions(spark: SparkSession, table: Versions, before: int | None = None, wanted: set[int] | None = None) -> DataFrame:
    """All rows added to a table that is never reduced, by triggers before ``before``."""
    return _read(spark, table, _folders(spark, table, before, wanted)[1])


def rows_of(spark: SparkSession, table: Versions, before: int | None = None, among: DataFrame | None = None) -> DataFrame:
    """The row of each key that counts, as of the triggers before ``before``.

    ``among`` holds the keys asked for, once each, under some of the key's columns: only their
    buckets are read.
    """
    wanted = None if among is None else buckets_of(among, table)
    old, new = _folders(spark, table, before, wanted)
    rows = _read(spark, table, old + new)
    if among is not None:
        rows = rows.join(among, among.columns, "left_semi")
    # A reduction has one row per key already.
    return _latest(rows, table) if new else rows


def reduce(spark: SparkSession, table: Versions, upto: int) -> None:
    """Reduces the buckets that changed up to and including trigger ``upto``.

    The reduction of a bucket before this one stays for readers that have begun with it, and so
    do the triggers after that; what is older goes.
    """
    path = table.path
    done = _numbered(spark, f"{path}/compacted", _UPTO)
    triggers = [n for n in _numbered(spark, f"{path}/changes", BATCH) if (not done or n > done[-1]) and n <= upto]
    if not triggers or (done and done[-1] >= upto):
        return
    changed = set().union(*(_buckets(spark, f"{path}/changes/{BATCH}={n}") for n in triggers))
    if changed:
        old, new = _folders(spark, table, upto + 1, changed)
        rows = _latest(_read(spark, table, old + new), table).withColumn(_BUCKET, table.bucket())
        rows.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/compacted/{_UPTO}={upto}")
    for bucket, kept in _reduced(spark, table).items():
        for old_upto in kept[2:]:
            remove(spark, f"{path}/compacted/{_UPTO}={old_upto}/{_BUCKET}={bucket}")
    for old_upto in done:
        if not _buckets(spark, f"{path}/compacted/{_UPTO}={old_upto}"):
            remove(spark, f"{path}/compacted/{_UPTO}={old_upto}")
    for batch_id in _numbered(spark, f"{path}/changes", BATCH):
        if done and batch_id <= done[-1]:
            remove(spark, f"{path}/changes/{BATCH}={batch_id}")


def reduce_before(spark: SparkSession, table: Versions, batch_id: int, every: int = EVERY) -> None:
    """Called by a trigger: every few triggers, reduces those before it, which are over for good."""
    if batch_id and batch_id % every == 0:
        reduce(spark, table, batch_id - 1)
