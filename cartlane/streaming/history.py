"""When an order had which status.

A stream keeps every status record, and readers derive the history from the whole log, whatever
order the records came in and however they were split over triggers. A delete ends the last
status; an order that comes back begins anew.

Or a stream keeps the intervals themselves (``write_intervals``). A run is a stretch of records of an
order with one status; it is stored with its first and its last record and the time it ends. A new
record touches the runs next to it, and only those are cut anew. If it falls inside a run of
another status, the records of that run are looked up in the log, since they are what the
run falls apart into. A trigger reads the ranges of keys that it holds, and of an order with many
runs those from the one before its earliest to the one after its latest record.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartlane.functions.times import as_of_column
from cartlane.operators.upserts import first_per_key
from cartlane.plans.keys import with_surrogate_key
from cartlane.plans.ordered import RANGE, neighbour, ranged
from cartlane.plans.scratch import written
from cartlane.sources.sinks import BATCH, read_batches, write_batch
from cartlane.streaming.versions import Versions, add, added, additions, buckets_of, reduce_before, rows_of

STATUS = "order_status_id"

# Records of the same log position are repeats; the rest only makes the order total.
_ORDER = ["lsn", "since", "deleted", STATUS]
_LOG = "id long, deleted boolean, order_status_id long, changed_at timestamp_ntz, lsn long"


def _runs(changes: DataFrame, stored: bool) -> DataFrame:
    """The records, deletes included, that differ from the one before of their order.

    Ranges are cut after a look at all rows: changes that still have to be decoded are written first, a few
    numbers each, so that this is done once.
    """
    rows = changes.select("id", STATUS, "deleted", F.col("changed_at").alias("since"), "lsn")
    rows = rows if stored else written(rows, "changes")
    before = neighbour(ranged(rows, ["id"], _ORDER), ["id"], _ORDER, [STATUS, "deleted"], "__before")
    same = F.col(f"__before.{STATUS}").eqNullSafe(F.col(STATUS)) & (F.col("__before.deleted") == F.col("deleted"))
    return before.filter(F.col("__before").isNull() | ~same).drop("__before")


def status_changes(changes: DataFrame, stored: bool = False) -> DataFrame:
    """The changes after which an order's status differs from before; ``stored`` if they are a table already.

    Repeated records follow their twin in the log and so change nothing.
    """
    return _runs(changes, stored).filter("NOT deleted").drop("deleted", RANGE)


def status_history(changes: DataFrame, stored: bool = False) -> DataFrame:
    """``id, order_status_id, since, lsn, until`` from a batch of changes; ``stored`` if they are a table already.

    ``until`` is when the next status or a delete came, null for the present status.
    """
    after = neighbour(_runs(changes, stored), ["id"], _ORDER, ["since"], "__after", following=True)
    return after.filter("NOT deleted").withColumn("until", F.col("__after.since")).drop("__after", "deleted", RANGE)


def first_visits(history: DataFrame) -> DataFrame:
    """Each status of an order once, as the history table's unique key wants it."""
    return first_per_key(history, ["id", STATUS], ["lsn"])


def history_rows(history: DataFrame, staff: DataFrame, as_of, existing: DataFrame | None = None, start=None) -> DataFrame:
    """First visits as rows of the history table; ``staff`` has ``order_id, staff_id``.

    An order without staff has no row, as the table wants one.
    """
    visits = first_visits(history).withColumnRenamed("id", "order_id").join(staff, "order_id")
    rows = visits.select(
        "order_id",
        STATUS,
        "staff_id",
        F.lit(None).cast("string").alias("comments"),
        as_of_column(as_of).alias("created_at"),
    )
    return with_surrogate_key(rows, ["order_id", STATUS], "id", existing, start)


def write_status_log(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs the stream over what is there and adds its status records. No shuffle, no state."""
    return (
        changes.select("id", "deleted", STATUS, "changed_at", "lsn")
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
        .trigger(availableNow=True)
        .start()
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """``status_history`` of what ``write_status_log`` wrote."""
    return status_history(read_batches(spark, path, _LOG).drop(BATCH), stored=True)


_RECORD = ["id", *_ORDER]
_RECORDS = "id long, lsn long, since timestamp_ntz, deleted boolean, order_status_id long"
_RUNS = f"{_RECORDS}, last_lsn long, last_since timestamp_ntz, until timestamp_ntz, alive boolean, version long"


def _tables(path: str) -> tuple[Versions, Versions]:
    """All records, and the runs, known by their first record."""
    log = Versions(f"{path}/log", tuple(_RECORD), "lsn", _RECORDS)
    return log, Versions(f"{path}/runs", tuple(_RECORD), "version", _RUNS)


def _place(lsn: str = "lsn", since: str = "since") -> Column:
    """The place of a record in its order's log."""
    return F.struct(F.col(lsn).alias("lsn"), F.col(since).alias("since"), "deleted", STATUS)


def _around(records: DataFrame, runs: DataFrame) -> DataFrame:
    """The runs of each order from the one before its first new record to the one after its last."""
    spans = records.groupBy("id").agg(F.min("lsn").alias("__low"), F.max("lsn").alias("__high"))
    side = F.when(F.col("lsn") < F.col("__low"), -1).when(F.col("lsn") > F.col("__high"), 1).otherwise(0).alias("side")
    run = F.struct(_place().alias("place"), *runs.columns)
    # Of the runs before, the last; of those after, the first; those between, each by itself.
    each = F.when(side == 0, _place()).alias("each")
    found = runs.join(spans, "id").groupBy("id", side, each).agg(F.max(run).alias("last"), F.min(run).alias("first"))
    return found.select(F.when(F.col("side") > 0, F.col("first")).otherwise(F.col("last")).alias("run")).select(
        *[F.col(f"run.{c}").alias(c) for c in runs.columns]
    )


def _touched(records: DataFrame, runs: DataFrame) -> DataFrame:
    """New records (``fresh``) and the runs next to one, in one line per order.

    ``firm``: the record before a run is as it was, so it stays the beginning of a run. ``opened``: a
    new record lies inside.
    """
    line = runs.withColumn("fresh", F.lit(False)).unionByName(
        records.withColumn("fresh", F.lit(True)), allowMissingColumns=True
    )
    order = W.partitionBy("id").orderBy(*_ORDER, "fresh")
    near = line.withColumns(
        {
            "__before": F.coalesce(F.lag("fresh").over(order), F.lit(False)),
            "__after": F.coalesce(F.lead("fresh").over(order), F.lit(False)),
            "__next": F.lead(_place()).over(order),
        }
    )
    inside = F.col("__after") & (F.col("__next") < _place("last_lsn", "last_since"))
    marked = near.withColumns({"firm": ~F.col("fresh") & ~F.col("__before"), "opened": ~F.col("fresh") & inside})
    return marked.filter("fresh OR __before OR __after").drop("__before", "__after", "__next")


def _cut(points: DataFrame) -> DataFrame:
    """Runs from records of orders in order, parts of an order kept apart by ``firm``."""
    points = points.groupBy(*_RECORD).agg(F.max("firm").alias("firm"), F.max("until").alias("until"))
    order = W.partitionBy("id").orderBy(*_ORDER)
    before = F.lag(F.struct("deleted", STATUS)).over(order)
    begins = F.col("firm") | before.isNull() | ~before.eqNullSafe(F.struct("deleted", STATUS))
    numbered = points.withColumn("begins", begins).withColumn("run", F.count_if("begins").over(order))
    runs = numbered.groupBy("id", "run").agg(
        F.min(_place()).alias("first"),
        F.max(_place()).alias("last"),
        F.min_by("firm", _place()).alias("firm"),
        F.max_by("until", _place()).alias("known"),
    )
    after = F.lead(F.struct("firm", F.col("first.since").alias("since"))).over(W.partitionBy("id").orderBy("run"))
    # Where the next run here is firm, others lie between, and the end is the one known.
    until = F.when(after.isNotNull() & ~after["firm"], after["since"]).otherwise(F.col("known"))
    return runs.withColumn("until", until).select(
        "id", "first.*", F.col("last.lsn").alias("last_lsn"), F.col("last.since").alias("last_since"), "until"
    )


def merge_intervals(changes: DataFrame, path: str, batch_id: int) -> None:
    """Brings the stored runs up to date with the records of one trigger."""
    spark = changes.sparkSession
    log, table = _tables(path)
    reduce_before(spark, table, batch_id)
    rows = changes.select("id", "lsn", F.col("changed_at").alias("since"), "deleted", STATUS)
    add(log, rows.distinct(), batch_id)
    records = added(spark, log, batch_id)
    stored = rows_of(spark, table, batch_id, records.select("id").distinct()).filter("alive").drop("alive", "version")
    touched = written(_touched(records, _around(records, stored)), "touched")

    none = F.lit(None).cast("timestamp_ntz").alias("until")
    first = touched.select(*_RECORD, "firm", "until")
    last = touched.filter("NOT fresh AND NOT opened").select(
        "id", F.col("last_lsn").alias("lsn"), F.col("last_since").alias("since"), "deleted", STATUS, F.lit(False).alias("firm"), "until"
    )
    parts = [first, last]
    opened = touched.filter("opened").select("id", F.col("lsn").alias("__low"), F.col("last_lsn").alias("__high"))
    if not opened.isEmpty():
        earlier = additions(spark, log, batch_id, buckets_of(opened, log))
        inside = earlier.join(opened, "id").filter("lsn BETWEEN __low AND __high")
        parts.append(inside.select(*_RECORD, F.lit(False).alias("firm"), none))
    runs = _cut(reduce(DataFrame.unionByName, parts)).withColumn("alive", F.lit(True))
    gone = touched.filter("NOT fresh").drop("fresh", "firm", "opened").withColumn("alive", F.lit(False))
    # A run that begins as one of before replaces it.
    version = F.lit(2 * batch_id).cast("long") + F.col("alive").cast("int")
    add(table, runs.unionByName(gone).withColumn("version", version), batch_id)


def write_intervals(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs the stream over what is there and keeps the intervals of each status."""
    return (
        changes.select("id", "deleted", STATUS, "changed_at", "lsn")
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: merge_intervals(batch, path, batch_id))
        .trigger(availableNow=True)
        .start()
    )


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """What ``status_history`` gives for all records so far. Nothing is derived, only read."""
    runs = rows_of(spark, _tables(path)[1])
    return runs.filter("alive AND NOT deleted").select("id", STATUS, "since", "lsn", "until")
