"""References without a parent, kept up to date from the change feed.

For each rule (a column of a table that refers to another table) and each key, two numbers follow
the feed: rows that hold the key, and parents that have it. A violation is a key with the first and
without the second, whichever came first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartlane.plans.scratch import written
from cartlane.schemas import Table
from cartlane.streaming.derived import SIGN, add_sums, signed_changes
from cartlane.streaming.envelope import decode
from cartlane.streaming.versions import Versions, rows_of

_COUNTS = "rule string, key long, children long, parents long, version long"


def _counts(path: str) -> Versions:
    return Versions(f"{path}/counts", ("rule", "key"), "version", _COUNTS, number="key")


def _images(path: str, table: Table, columns: list[str]) -> Versions:
    schema = ", ".join(["id long, lsn long, deleted boolean", *[f"{c} long" for c in columns]])
    return Versions(f"{path}/rows-{table.name}", ("id",), "lsn", schema)


def _entries(changes: DataFrame, table: Table, rules: dict[str, str], path: str, batch_id: int, referred: list[str]) -> DataFrame:
    """Signed counts by rule and key from one table: as a child by column, as a parent by id."""
    columns = [c for c in table.references if c in rules]
    rows = signed_changes(changes.select("id", "lsn", "deleted", *columns), _images(path, table, columns), batch_id)
    none = F.lit(0).cast("long")
    sign = F.col(SIGN).cast("long")
    held = [F.struct(F.lit(rules[c]).alias("rule"), F.col(c).alias("key"), sign.alias("children"), none.alias("parents")) for c in columns]
    there = [F.struct(F.lit(r).alias("rule"), F.col("id").alias("key"), none.alias("children"), sign.alias("parents")) for r in referred]
    return rows.select(F.inline(F.array(*held, *there))).dropna(subset=["key"])


def merge_references(raw: DataFrame, tables: list[Table], path: str, batch_id: int) -> None:
    """Brings the counts up to date with one trigger of the feed of all tables."""
    raw = written(raw.select("value"), "records")
    names = [t.name for t in tables]
    parts = []
    for table in tables:
        rules = {c: f"{table.name}.{c}" for c, parent in table.references.items() if parent in names}
        referred = [f"{t.name}.{c}" for t in tables for c, parent in t.references.items() if parent == table.name]
        if rules or referred:
            parts.append(_entries(decode(raw, table, list(rules)), table, rules, path, batch_id, referred))
    delta = reduce(DataFrame.unionByName, parts).groupBy("rule", "key")
    add_sums(delta.agg(F.sum("children").alias("children"), F.sum("parents").alias("parents")), _counts(path), batch_id)


def write_references(raw: DataFrame, tables: list[Table], path: str, checkpoint: str) -> StreamingQuery:
    """Runs the stream of undecoded records over what is there, for the references among ``tables``."""
    return (
        raw.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: merge_references(batch, tables, path, batch_id))
        .trigger(availableNow=True)
        .start()
    )


def read_orphans(spark: SparkSession, path: str) -> DataFrame:
    """``rule, key, rows``: the keys that rows hold and no parent has, and how many rows."""
    missing = rows_of(spark, _counts(path)).filter("children > 0 AND parents <= 0")
    return missing.select("rule", "key", F.col("children").alias("rows"))
