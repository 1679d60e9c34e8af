"""Unique slugs.

The rule, row by row: take the base slug if it is free, else the first free of ``base-1``,
``base-2`` and so on. As sets: the i-th row of a base takes its i-th free place, where place
0 is the bare slug and place n is ``base-n``.

Two bases meet only where one reads like a numbered slug of the other: ``lamp-2`` may be the
third row of ``lamp`` or the first row of ``lamp 2``, and goes to the row that comes first.
Such bases are settled in a second step, level by level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlane.functions.text import base_slug
from cartlane.plans.ordered import numbered_in_group, running_total
from cartlane.plans.scratch import written

# A slug that ends in a number as the rule writes it: no leading zero.
_NUMBERED = r"^(.*)-([1-9][0-9]{0,17})$"

_BASE = "__base"
_PLACE = "__place"


def unique_slugs(rows: DataFrame, name: str, order: str, existing: DataFrame | None = None) -> DataFrame:
    """Adds ``slug``, unique among the rows and against ``existing.slug``; null without a name.

    ``order`` is a unique numeric column: the order of arrival.
    """
    named = rows.withColumn(_BASE, base_slug(F.col(name)))
    based = named.filter(F.col(_BASE).isNotNull())
    bases = based.groupBy(_BASE).agg(F.min(order).alias("first"))
    taken = None
    if existing is not None:
        places = _places(existing.select(F.col("slug").alias(_BASE)).dropna())
        taken = places.join(bases.select(_BASE), _BASE, "left_semi").distinct()
    rivals = (
        _places(bases, "first")
        .filter("n > 0")
        .join(bases.select(_BASE), _BASE, "left_semi")
        .withColumn("rival", F.concat_ws("-", _BASE, "n"))
    )
    if rivals.isEmpty():
        placed = _place(based, order, taken)
    else:
        placed = _place_by_level(based, order, taken, written(rivals, "rivals"))
    slug = F.when(F.col(_PLACE) == 0, F.col(_BASE)).otherwise(F.concat_ws("-", _BASE, _PLACE))
    unnamed = named.filter(F.col(_BASE).isNull()).withColumn("slug", F.lit(None).cast("string"))
    return placed.withColumn("slug", slug).drop(_BASE, _PLACE).unionByName(unnamed.drop(_BASE))


def _places(slugs: DataFrame, *keep: str) -> DataFrame:
    """What a slug occupies: place 0 of itself and, if numbered, place n of its stem."""
    bare = slugs.select(_BASE, F.lit(0).cast("bigint").alias("n"), *keep)
    numbered = slugs.filter(F.col(_BASE).rlike(_NUMBERED)).select(
        F.regexp_extract(_BASE, _NUMBERED, 1).alias(_BASE),
        F.regexp_extract(_BASE, _NUMBERED, 2).try_cast("bigint").alias("n"),
        *keep,
    )
    return bare.unionByName(numbered)


def _place(based: DataFrame, order: str, taken: DataFrame | None) -> DataFrame:
    """The i-th row of each base in its i-th free place."""
    ranked = numbered_in_group(based, [_BASE], [order], "__rank")
    ranked = ranked.withColumn("__rank", F.col("__rank") - 1)
    if taken is None:
        return ranked.withColumnRenamed("__rank", _PLACE)
    merged = _with_taken(ranked, taken)
    return merged.withColumn(_PLACE, F.col("__rank") + F.col("__skipped")).drop("__rank", "__skipped")


def _with_taken(ranked: DataFrame, taken: DataFrame) -> DataFrame:
    """Adds how many taken places lie below the rank-th free one.

    Each taken place is marked with the free places below it. A run of taken places has one
    mark, so marks are counted first: the rule itself leaves long runs. Rows and marks of a base
    then go in one sequence by rank, and a running count does the rest.
    """
    numbered = numbered_in_group(taken, [_BASE], ["n"], "__th")
    marks = (
        numbered.select(_BASE, (F.col("n") - F.col("__th") + 1).alias("__rank"))
        .groupBy(_BASE, "__rank")
        .agg(F.count(F.lit(1)).alias("__add"))
        .withColumn("__row", F.lit(0))
    )
    sequence = ranked.withColumns({"__row": F.lit(1), "__add": F.lit(0).cast("bigint")}).unionByName(
        marks, allowMissingColumns=True
    )
    counted = running_total(sequence, [_BASE], ["__rank", "__row"], F.col("__add"), "__skipped")
    return counted.filter("__row = 1").drop("__row", "__add")


def _place_by_level(based: DataFrame, order: str, taken: DataFrame | None, rivals: DataFrame) -> DataFrame:
    """Bases that touch another base, those without a stem first.

    Whether a base still has its bare slug depends on its stem's rows, and so on down.
    """
    if taken is None:
        taken = based.sparkSession.createDataFrame([], f"{_BASE} string, n bigint")
    taken = written(taken, "taken")
    children = rivals.select(F.col("rival").alias(_BASE))
    touched = rivals.select(_BASE).union(children).distinct()
    untouched = based.join(touched, _BASE, "left_anti")
    done = [_place(untouched, order, taken.join(touched, _BASE, "left_anti"))]

    touching = written(based.join(touched, _BASE, "left_semi"), "touching")
    level = written(rivals.select(_BASE).join(children, _BASE, "left_anti").distinct(), "level")
    blocked = taken
    while not level.isEmpty():
        rows = touching.join(level, _BASE, "left_semi")
        here = rivals.join(level, _BASE, "left_semi")
        blocked = blocked.join(level, _BASE, "left_semi")
        blocked = written(blocked.unionByName(_winning_rivals(rows, order, blocked, here)), "blocked")
        placed = written(_place(rows, order, blocked), "slugs")
        done.append(placed)
        # Bare slugs of the next level that went to rows of this one.
        slugs = placed.filter(F.col(_PLACE) > 0).select(F.concat_ws("-", _BASE, _PLACE).alias("rival"))
        lost = here.join(slugs, "rival", "left_semi").select(
            F.col("rival").alias(_BASE), F.lit(0).cast("bigint").alias("n")
        )
        blocked = taken.unionByName(lost)
        level = written(here.select(F.col("rival").alias(_BASE)).distinct(), "level")
    return reduce(DataFrame.unionByName, done)


def _winning_rivals(rows: DataFrame, order: str, taken: DataFrame, rivals: DataFrame) -> DataFrame:
    """The rivals that come before the stem's row that would take their place.

    A rival for place n wins when the stem has no more rows before it than there are free
    places below n, less the rivals that won below n. That last number is closed in from
    both sides: too few winners below means too many here, and the other way round.
    """
    one, none = F.lit(1).cast("bigint").alias("one"), F.lit(0).cast("bigint").alias("one")
    asked = rivals.join(taken, [_BASE, "n"], "left_anti").select(_BASE, F.col("first").alias("at"), none, "n")
    arrivals = rows.select(_BASE, F.col(order).alias("at"), one)
    before = running_total(
        arrivals.unionByName(asked, allowMissingColumns=True), [_BASE], ["at"], F.col("one"), "rows_before"
    )
    places = taken.select(_BASE, "n", one).unionByName(
        before.filter("n IS NOT NULL").select(_BASE, "n", none, "rows_before"), allowMissingColumns=True
    )
    free = running_total(places, [_BASE], ["n"], F.col("one"), "taken_below")
    spare = F.col("n") - F.col("taken_below") - F.col("rows_before")
    state = written(
        free.filter("rows_before IS NOT NULL").select(
            _BASE, "n", spare.alias("spare"), F.lit(0).cast("bigint").alias("won_below")
        ),
        "spare",
    )
    while True:
        wins = (F.col("won_below") <= F.col("spare")).cast("bigint")
        counted = running_total(state.withColumn("win", wins), [_BASE], ["n"], F.col("win"), "upto")
        state = written(
            counted.select(
                _BASE, "n", "spare", F.col("won_below").alias("last"), (F.col("upto") - F.col("win")).alias("won_below")
            ),
            "spare",
        )
        if state.filter("won_below <> last").isEmpty():
            return state.filter("won_below <= spare").select(_BASE, "n")
        state = state.drop("last")
