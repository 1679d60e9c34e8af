"""Trees given by a reference of each row to its parent, and sums over subtrees.

Every node gets an interval of places, and the intervals of its subtree lie inside it, in the order of
keys. First the sizes of all subtrees, upwards: in each round a node adds its sum to the ancestor it
looks at and then looks twice as far. Then the places, downwards: a node begins behind its parent and
the subtrees of its earlier siblings, and these steps are added up along the path in the same way. A
tree of depth d takes log2(d) rounds each way, whatever its width; siblings are summed in ranges.

A total over a subtree is then the difference of two running totals over the places.

Nodes on a cycle or below one have no place. A parent that is not there counts as none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlane.plans.ordered import running_total
from cartlane.plans.scratch import written


def _doubled(state: DataFrame, first: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Each node that looks at another takes over where that one looks, and ``sums`` of the two."""
    ahead = first.select(F.col("id").alias("up"), *[F.col(c).alias(f"__{c}") for c in first.columns if c != "id"])
    kept = [c for c in state.columns if c not in ("id", "up", *sums)]
    return state.join(ahead, "up", "left").select("id", F.col("__up").alias("up"), *kept, *[v.alias(c) for c, v in sums.items()])


def _subtree_sizes(links: DataFrame, nodes: int) -> DataFrame:
    """``id, size``; rows that still look at another after all rounds are on or below a cycle."""
    state = written(links.select("id", "up", F.lit(1).cast("long").alias("size")), "sizes")
    reach = 1
    while reach <= nodes and not state.filter("up IS NOT NULL").isEmpty():
        added = state.filter("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(F.sum("size").alias("__more"))
        grown = state.join(added, "id", "left").withColumn("size", F.col("size") + F.coalesce("__more", F.lit(0))).drop("__more")
        state = written(_doubled(grown, state.select("id", "up"), {}), "sizes")
        reach *= 2
    return state


def tree_intervals(rows: DataFrame, key: str = "id", parent: str = "category_id") -> DataFrame:
    """``id, root_id, depth, begin, end`` of each node: its subtree has the places from begin to before end.

    Places count from 0 without gaps; roots and siblings are in order of their keys. All but the id are null
    for nodes on a cycle or below one.
    """
    nodes = rows.select(F.col(key).alias("id"), F.col(parent).alias("up"))
    there = nodes.select(F.col("id").alias("up"), F.col("id").alias("__there"))
    links = nodes.join(there, "up", "left").select("id", F.col("__there").alias("up"))
    links = written(links, "links")
    count = links.count()
    sizes = _subtree_sizes(links, count)
    sound = links.join(sizes.filter("up IS NULL").select("id", "size"), "id")

    before = running_total(sound, ["up"], ["id"], F.col("size"), "upto")
    step = F.col("upto") - F.col("size") + F.when(F.col("up").isNull(), F.lit(0)).otherwise(F.lit(1))
    one = F.lit(1).cast("long")
    state = before.select("id", "up", "size", F.col("id").alias("root_id"), step.cast("long").alias("begin"), one.alias("nodes"))
    state = written(state, "places")
    while not state.filter("up IS NOT NULL").isEmpty():
        nothing = F.lit(0)
        sums = {
            "root_id": F.coalesce("__root_id", "root_id"),
            "begin": F.col("begin") + F.coalesce("__begin", nothing),
            "nodes": F.col("nodes") + F.coalesce("__nodes", nothing),
        }
        state = written(_doubled(state, state.drop("size"), sums), "places")
    placed = state.select(
        "id", "root_id", (F.col("nodes") - 1).cast("int").alias("depth"), "begin", (F.col("begin") + F.col("size")).alias("end")
    )
    return links.select("id").join(placed, "id", "left")


def subtree_totals(intervals: DataFrame, facts: DataFrame, key: str, values: list[str]) -> DataFrame:
    """``id, depth`` and the sum of each value over the facts of a node's whole subtree, 0 where there are none.

    Facts are summed by node first. Nodes without a place are returned with null totals.
    """
    own = facts.groupBy(F.col(key).alias("id")).agg(*[F.sum(v).alias(v) for v in values])
    kinds = dict(own.dtypes)
    filled = {v: F.coalesce(v, F.lit(0)).cast(kinds[v]) for v in values}
    nodes = written(intervals.join(own, "id", "left").withColumns(filled).withColumn("__all", F.lit(0)), "facts")
    summed = nodes.filter("begin IS NOT NULL")
    for v in values:
        summed = running_total(summed, ["__all"], ["begin"], F.col(v), f"__{v}")
    upto = [f"__{v}" for v in values]
    summed = written(summed.select("id", "begin", "end", *values, *upto), "running")
    last = summed.select((F.col("begin") + 1).alias("end"), *[F.col(u).alias(f"{u}_end") for u in upto])
    totals = summed.join(last, "end").select(
        "id", *[(F.col(f"__{v}_end") - F.col(f"__{v}") + F.col(v)).alias(v) for v in values]
    )
    return intervals.select("id", "depth").join(totals, "id", "left")
