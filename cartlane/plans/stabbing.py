"""Points and the intervals that hold them, found by an equality join.

Each interval is cut into tiles of one level: powers of four, of which the interval touches five to
seventeen (fewer only if it is very short). A point is in one tile of each level that is in use. The
two meet on level and tile, and a last test drops the points that only an outer tile let through.

A tile with many points is hot: its points are dealt to parts by their content, and the intervals
that touch it go to each part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Points in a tile from which on it may be hot; it also has to hold a thousandth of all points.
HOT, SHARE = 1 << 20, 1000

_LEVEL, _TILE, _PART, _FROM, _UPTO, _AT = "__level", "__tile", "__part", "__from", "__upto", "__at"


def stab(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    start: str | None,
    end: str,
    on: tuple[str, ...] = (),
    hot: int = HOT,
) -> DataFrame:
    """Every point with each interval that holds it: ``start <= at < end``, and equal ``on``.

    The three are whole numbers. Without a ``start`` an interval reaches back without an end; a null in
    any of them holds nothing. Apart from ``on`` the two tables have no column in common. Two small
    results come to the driver first: the range of the points, and the levels, 32 at most.
    """
    if clash := (set(points.columns) & set(intervals.columns)) - set(on):
        raise ValueError(f"both tables have {sorted(clash)}")
    seen = points.agg(F.min(at).alias("low"), F.max(at).alias("high"), F.count(at).alias("n")).first()
    low, high = (seen["low"], seen["high"]) if seen["n"] else (0, 0)

    known = [c for c in (start, end) if c is not None]
    begin = F.greatest(F.col(start), F.lit(low)) if start else F.lit(low)
    cut = intervals.dropna(subset=known).withColumns(
        {_FROM: (begin - low).cast("long"), _UPTO: (F.least(F.col(end), F.lit(high + 1)) - low).cast("long")}
    )
    cut = cut.filter(F.col(_FROM) < F.col(_UPTO))
    bits = F.length(F.bin(F.col(_UPTO) - F.col(_FROM)))
    cut = cut.withColumn(_LEVEL, F.greatest(F.lit(0), 2 * F.floor((bits - 3) / 2)).cast("int"))
    levels = sorted(r[0] for r in cut.select(_LEVEL).distinct().collect())

    def tile(place, level):
        return F.call_function("shiftright", place, level)

    touched = F.sequence(tile(F.col(_FROM), F.col(_LEVEL)), tile(F.col(_UPTO) - 1, F.col(_LEVEL)))
    tiles = cut.withColumn(_TILE, F.explode(touched))
    placed = points.dropna(subset=[at]).withColumn(_AT, (F.col(at) - low).cast("long"))
    nowhere = F.array().cast(f"array<struct<{_LEVEL}:int,{_TILE}:bigint>>")
    here = [F.struct(F.lit(n).alias(_LEVEL), tile(F.col(_AT), F.lit(n)).alias(_TILE)) for n in levels]
    placed = placed.select("*", F.inline(F.array(*here) if here else nowhere))

    # At most ``SHARE`` tiles of each level hold more than that share of the points.
    limit = max(hot, seen["n"] // SHARE)
    meet = [_LEVEL, _TILE, *on]
    crowded = placed.groupBy(*meet).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit)
    parts = F.broadcast(crowded.select(*meet, F.ceil(F.col("__n") / limit).alias("__parts")))
    dealt = F.pmod(F.xxhash64(*points.columns), F.coalesce("__parts", F.lit(1)))
    placed = placed.join(parts, meet, "left").withColumn(_PART, dealt).drop("__parts")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__parts", F.lit(1)) - 1))
    tiles = tiles.join(parts, meet, "left").withColumn(_PART, copies).drop("__parts")

    found = placed.join(tiles, [*meet, _PART]).filter((F.col(_FROM) <= F.col(_AT)) & (F.col(_AT) < F.col(_UPTO)))
    return found.select(*points.columns, *[c for c in intervals.columns if c not in on])
