"""Seeded choice of a row of another table for each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlane.functions.draws import draw
from cartlane.plans.keys import BUCKETS, counted_and_numbered

_SLOT = "__slot"


def assign(
    rows: DataFrame,
    row_keys: list[str],
    choices: DataFrame,
    choice_keys: list[str],
    columns: dict[str, str],
    seed: str,
    null_slot: bool = False,
    only_if: Column | None = None,
) -> DataFrame:
    """Gives each row one uniformly drawn row of ``choices``, with replacement.

    ``columns`` maps columns of ``choices`` to names in the result. ``null_slot`` adds "none"
    as one more choice. Rows where ``only_if`` is not true get nulls, as do all rows when
    ``choices`` is empty.

    An equi-join on a dense number: the draws are even, so the join is too. Rows that take
    nothing get one of many numbers that match nothing, so they do not meet in one task.
    """
    kept = choices.select(*dict.fromkeys([*choice_keys, *columns]))
    count, table = counted_and_numbered(kept, choice_keys, _SLOT, start=0)
    number = draw(seed, *row_keys)
    slot = F.pmod(number, F.nullif(count + F.lit(1 if null_slot else 0), F.lit(0)))
    if only_if is not None:
        slot = F.when(only_if, slot)
    nowhere = -1 - F.pmod(number, F.lit(BUCKETS))
    table = table.select(_SLOT, *[F.col(c).alias(alias) for c, alias in columns.items()])
    return rows.withColumn(_SLOT, F.coalesce(slot, nowhere)).join(table, _SLOT, "left").drop(_SLOT)
