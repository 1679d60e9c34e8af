"""Campaigns and discounts: validity and seeded windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlane.functions.draws import draw_choice, draw_decimal, draw_int
from cartlane.functions.times import as_of_column, plus_days, to_epoch_micros
from cartlane.plans.assign import assign
from cartlane.plans.stabbing import stab
from cartlane.schemas import AMOUNT, PERCENT

# Days since the start and days of validity, discount values, code characters.
CAMPAIGN_AGE, CAMPAIGN_DAYS = (1, 30), (1, 10)
DISCOUNT_AGE, DISCOUNT_DAYS = (1, 30), (1, 30)
PERCENT_RANGE = (1, 100)
AMOUNT_RANGE = ("1", "1000")


def active_at(rows: DataFrame, as_of, window: bool = False) -> DataFrame:
    """Rows not expired at ``as_of``; with ``window`` also started by then.

    A row without an expiry is left out, as any comparison with null is.
    """
    now = as_of_column(as_of)
    valid = rows.filter(F.col("expired_at") > now)
    return valid.filter(F.col("started_at") <= now) if window else valid


def active_at_each(moments: DataFrame, at: str, rows: DataFrame, window: bool = False) -> DataFrame:
    """Each moment with every row that is active then, as ``active_at`` tells it for one moment.

    The two tables have no column in common.
    """
    points = moments.withColumn("__moment", to_epoch_micros(F.col(at)))
    ends = {"__start": to_epoch_micros(F.col("started_at"))} if window else {}
    spans = rows.withColumns({**ends, "__end": to_epoch_micros(F.col("expired_at"))})
    return stab(points, spans, "__moment", "__start" if window else None, "__end").drop("__moment", "__start", "__end")


def _window(now: Column, age: tuple[int, int], days: tuple[int, int], seed: str, keys: list[str]) -> dict[str, Column]:
    started = plus_days(now, -draw_int(f"{seed}-age", *age, *keys))
    return {
        "started_at": started,
        "expired_at": plus_days(started, draw_int(f"{seed}-days", *days, *keys)),
    }


def with_campaign_window(rows: DataFrame, keys: list[str], as_of, seed: str) -> DataFrame:
    """Adds a seeded start in the last month and an end up to ten days later."""
    return rows.withColumns(_window(as_of_column(as_of), CAMPAIGN_AGE, CAMPAIGN_DAYS, seed, keys))


def with_discount_terms(rows: DataFrame, keys: list[str], campaigns: DataFrame, as_of, seed: str) -> DataFrame:
    """Adds campaign (or none), type, value and validity window to new discounts."""
    percent = draw_int(f"{seed}-percent", *PERCENT_RANGE, *keys).cast("decimal(15,2)")
    amount = draw_decimal(f"{seed}-amount", *AMOUNT_RANGE, 2, *keys).cast("decimal(15,2)")
    linked = assign(rows, keys, campaigns, ["id"], {"id": "adscampaign_id"}, f"{seed}-campaign", null_slot=True)
    typed = linked.withColumn("type", draw_choice(f"{seed}-type", [PERCENT, AMOUNT], *keys))
    terms = {"value": F.when(F.col("type") == PERCENT, percent).otherwise(amount)}
    terms.update(_window(as_of_column(as_of), DISCOUNT_AGE, DISCOUNT_DAYS, seed, keys))
    return typed.withColumns(terms)
