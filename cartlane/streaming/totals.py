"""Order totals that follow the change feed of the lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartlane.functions.money import hundredth, money
from cartlane.modes import REFERENCE, STRICT, check_mode
from cartlane.streaming.derived import SIGN, add_sums, signed_changes
from cartlane.streaming.versions import Versions, rows_of

#: Columns of a line that the totals are made of.
LINE = ["order_id", "quantity", "product_price", "product_tax"]

_LINES = "id long, lsn long, deleted boolean, order_id long, quantity int, product_price decimal(15,2), product_tax decimal(15,2)"
_SUMS = "order_id long, lines long, amount decimal(38,2), tax decimal(38,4), version long"


def _tables(path: str) -> tuple[Versions, Versions]:
    lines = Versions(f"{path}/lines", ("id",), "lsn", _LINES)
    return lines, Versions(f"{path}/sums", ("order_id",), "version", _SUMS, number="order_id")


def merge_totals(changes: DataFrame, path: str, batch_id: int, mode: str = REFERENCE) -> None:
    """Brings the totals up to date with the changes of the lines in one trigger."""
    lines, sums = _tables(path)
    rows = signed_changes(changes.select("id", "lsn", "deleted", *LINE), lines, batch_id).dropna(subset=["order_id"])
    price, sign = F.col("product_price"), F.col(SIGN)
    # The tax per hundred, not yet divided: reference mode counts one piece of each line.
    tax = price * F.col("product_tax") * (F.col("quantity") if check_mode(mode) == STRICT else F.lit(1))
    delta = rows.groupBy("order_id").agg(
        F.sum(sign).cast("long").alias("lines"),
        F.sum(sign * F.col("quantity") * price).cast("decimal(38,2)").alias("amount"),
        F.sum(sign * tax).cast("decimal(38,4)").alias("tax"),
    )
    add_sums(delta, sums, batch_id)


def write_totals(changes: DataFrame, path: str, checkpoint: str, mode: str = REFERENCE) -> StreamingQuery:
    """Runs the stream of line changes over what is there."""
    return (
        changes.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: merge_totals(batch, path, batch_id, mode))
        .trigger(availableNow=True)
        .start()
    )


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """What ``order_totals`` gives for the lines as they are now. An order without lines has no row."""
    sums = rows_of(spark, _tables(path)[1]).filter("lines > 0")
    tax = F.col("tax") * hundredth()
    return sums.select(
        "order_id",
        money(F.col("amount")).alias("order_amount"),
        money(tax).alias("tax_amount"),
        money(F.col("amount") + tax).alias("total_amount"),
    )
