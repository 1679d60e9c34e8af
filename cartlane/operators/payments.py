"""Transactions and what they do to an order's status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlane.functions.draws import draw_choice
from cartlane.functions.times import as_of_column
from cartlane.modes import REFERENCE, STRICT, check_mode
from cartlane.plans.keys import with_surrogate_key
from cartlane.schemas import STATUS_AFTER_FAILURE, STATUS_AFTER_SUCCESS


def _description() -> Column:
    # Fixed value: the wording of the description.
    return F.concat(F.lit("Fake transaction description for order #"), F.col("order_id").cast("string"))


def make_transactions(orders: DataFrame, requests: DataFrame, seed: str = "") -> DataFrame:
    """A payment over the full amount for each requested order; unknown orders drop out.

    ``requests`` has ``order_id`` and, where it is known, the payment's ``status``; else the payment
    succeeds or fails by draw.
    """
    drawn = draw_choice(f"{seed}-status", ["true", "false"], "order_id")
    status = F.col("status") if "status" in requests.columns else drawn
    amounts = orders.select(F.col("id").alias("order_id"), F.col("total_amount").alias("amount"))
    return requests.join(amounts, "order_id").select(
        "order_id",
        F.lit("payment").alias("transaction_type"),
        "amount",
        status.cast("boolean").alias("status"),
        _description().alias("description"),
    )


def stored_transactions(
    orders: DataFrame, requests: DataFrame, key: str, as_of, existing: DataFrame | None = None, start=None
) -> DataFrame:
    """Payments with a given ``status`` as rows of the table; ``key`` is the requests' own key, in order
    of which the ids are given. A status that is not given is the table's default."""
    amounts = orders.select(F.col("id").alias("order_id"), F.col("total_amount").alias("amount"))
    paid = requests.select(key, "order_id", F.coalesce(F.col("status").cast("boolean"), F.lit(False)).alias("status")).join(amounts, "order_id")
    rows = paid.select(
        *dict.fromkeys([key, "order_id"]),
        F.lit("payment").alias("transaction_type"),
        "amount",
        "status",
        _description().alias("description"),
        as_of_column(as_of).alias("created_at"),
    )
    return with_surrogate_key(rows, [key], "id", existing, start)


def next_status(transactions: DataFrame) -> DataFrame:
    """``id, order_status_name`` for transactions that bring the ``next_status`` they ask for.

    A paid order may go on, an unpaid one be held or cancelled; what does not fit the result of the
    payment, or has no result, changes nothing.
    """
    asked = F.col("next_status")
    fits = F.when(F.col("status"), asked.isin(*STATUS_AFTER_SUCCESS)).when(~F.col("status"), asked.isin(*STATUS_AFTER_FAILURE))
    keep = [c for c in transactions.columns if c not in ("order_id", "next_status")]
    return transactions.filter(fits).select(F.col("order_id").alias("id"), asked.alias("order_status_name"), *keep)


def status_after_payment(transactions: DataFrame, seed: str, mode: str = REFERENCE) -> DataFrame:
    """The next status of each paid order: ``id, order_status_name``.

    Reference mode takes every payment as successful, as its status is compared as text;
    strict mode tells success from failure.
    """
    success = draw_choice(f"{seed}-next", STATUS_AFTER_SUCCESS, "order_id")
    name = success
    if check_mode(mode) == STRICT:
        failure = draw_choice(f"{seed}-next", STATUS_AFTER_FAILURE, "order_id")
        name = F.when(F.col("status"), success).otherwise(failure)
    return transactions.select(F.col("order_id").alias("id"), name.alias("order_status_name"))
