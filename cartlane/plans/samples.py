"""Seeded samples without replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlane.functions.draws import draw, draw_int, draw_series
from cartlane.plans.keys import counted_and_numbered

_SLOT = "__slot"


def sample_rows(df: DataFrame, k: int, keys: list[str], seed: str) -> DataFrame:
    """``k`` rows of the table. Spark keeps the best k per task, then the best k of those."""
    return df.orderBy(draw(seed, *keys), *keys).limit(k)


def distinct_up_to(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` lowest distinct values of a column, all of them if there are fewer."""
    return df.select(column).distinct().orderBy(column).limit(n)


def baskets(
    requests: DataFrame,
    request_key: str,
    items: DataFrame,
    item_keys: list[str],
    seed: str,
    low: int = 1,
    high: int = 10,
    keep: list[str] | None = None,
) -> DataFrame:
    """For each request, between ``low`` and ``high`` different items, each set equally likely.

    Robert Floyd's sampling: the i-th of k picks out of n is drawn below n - k + i, and is
    n - k + i - 1 itself if the draw was picked before. It needs the row alone, so no request
    meets more items than it takes, and it is written out step by step so that all steps
    compile into one loop. All items are taken when there are too few. ``keep`` names further
    columns of ``requests`` for the result; ``high`` is meant to be small.
    """
    n, table = counted_and_numbered(items, item_keys, _SLOT, start=0)
    carried = [request_key, *(keep or [])]
    drawn = [f"__d{i}" for i in range(1, high + 1)]
    picked = [f"__p{i}" for i in range(1, high + 1)]
    rows = requests.select(
        *carried,
        n.alias("__n"),
        F.least(draw_int(f"{seed}-size", low, high, request_key), n).alias("__k"),
        *[d.alias(name) for d, name in zip(draw_series(seed, high, request_key), drawn)],
    ).filter("__k > 0")
    spare = F.col("__n") - F.col("__k")
    rows = rows.withColumns({name: F.pmod(F.col(name), spare + i) for i, name in enumerate(drawn, 1)})
    for i, name in enumerate(picked):
        pick = F.col(drawn[i])
        if i:
            taken = pick.isin(*[F.col(p) for p in picked[:i]])
            pick = F.when(taken, spare + i).otherwise(pick)
        rows = rows.withColumn(name, pick)
    slots = rows.select(
        *carried, F.posexplode(F.slice(F.array(*picked), F.lit(1), F.col("__k").cast("int"))).alias("line_number", _SLOT)
    )
    return slots.withColumn("line_number", F.col("line_number") + 1).join(table, _SLOT).drop(_SLOT)
