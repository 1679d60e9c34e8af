"""Provinces, cities and addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlane.functions.draws import draw_choice
from cartlane.functions.text import joined
from cartlane.functions.times import as_of_column
from cartlane.operators.upserts import insert_new
from cartlane.operators.users import users_without
from cartlane.plans.assign import assign
from cartlane.plans.keys import with_surrogate_key

# The kinds of address.
ADDRESS_TITLES = ["home", "office"]


def new_provinces(places: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The states named in a file that are not provinces yet, with ids."""
    names = (
        places.select(F.col("state_name").alias("province_name"))
        .filter(F.col("province_name").isNotNull())
        .distinct()
    )
    if existing is not None:
        names = names.join(existing.select("province_name"), "province_name", "left_anti")
    return with_surrogate_key(names, ["province_name"], "id", existing)


def new_cities(
    places: DataFrame,
    provinces: DataFrame,
    existing: DataFrame | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """The cities of a file that are new in their province, with ids.

    A city that comes twice keeps its first place in ``order`` (the file's order if the file
    was read with positions; by default the lowest coordinates).
    """
    order = order or ["lat", "lng"]
    names = provinces.select(F.col("id").alias("province_id"), F.col("province_name").alias("state_name"))
    located = places.join(names, "state_name").withColumnRenamed("city", "city_name")
    fresh = insert_new(located, existing, ["city_name", "province_id"], order)
    rows = fresh.select("city_name", "province_id", F.col("lat").alias("latitude"), F.col("lng").alias("longitude"))
    return with_surrogate_key(rows, ["city_name", "province_id"], "id", existing)


def given_addresses(
    users: DataFrame, addresses: DataFrame, cities: DataFrame, as_of, existing: DataFrame | None = None, start=None
) -> DataFrame:
    """An address row, as stored, for each user that has none, in the city the user gives.

    ``users`` brings ``city_id``, ``title`` and the two parts of the text; the province is the
    city's. A user without a known city gets no address.
    """
    waiting = users_without(users, addresses).select(F.col("id").alias("user_id"), "city_id", "title", "street", "unit")
    located = waiting.join(cities.select(F.col("id").alias("city_id"), "province_id"), "city_id")
    rows = located.select(
        "title",
        "user_id",
        "province_id",
        "city_id",
        joined(F.col("street"), F.col("unit")).alias("full_address"),
        as_of_column(as_of).alias("created_at"),
    )
    return with_surrogate_key(rows, ["user_id"], "id", existing, start)


def attach_addresses(users: DataFrame, addresses: DataFrame, cities: DataFrame, seed: str) -> DataFrame:
    """An address in a drawn city for each user that has none.

    ``users`` brings the two parts of the text as ``street`` and ``unit``.
    """
    waiting = users_without(users, addresses).select(F.col("id").alias("user_id"), "street", "unit")
    placed = assign(
        waiting, ["user_id"], cities, ["id"], {"id": "city_id", "province_id": "province_id"}, f"{seed}-city"
    )
    return placed.filter(F.col("city_id").isNotNull()).select(
        draw_choice(f"{seed}-title", ADDRESS_TITLES, "user_id").alias("title"),
        "user_id",
        "province_id",
        "city_id",
        joined(F.col("street"), F.col("unit")).alias("full_address"),
    )
