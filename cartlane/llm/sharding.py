"""Sharding: balanced label propagation over linked documents.

First each document takes the smallest number among its neighbours', until nothing changes: these labels
are groups. A group that a shard can hold moves as a whole: groups bid for shards, and a shard takes the
largest that fit. Those refused bid again for what room there is. A group larger than a shard is laid over
as few shards as it needs, and then its documents vote: in each round a document looks at the shards
of its linked documents with smaller numbers and wants to go where most of them are, so no two chase
each other. A shard takes movers up to a quota: those that follow documents with few links first. In
the end shards above the exact quota send documents to those below. Unlinked documents fill up the shards.

Ranks within a shard are sums over buckets of a hash plus a rank in the bucket, so no task sorts a
shard. What the driver reads is one number per shard.

Defined results: the law is ``rows``: the counts of any two shards differ by one at most. A null
text has no bytes and equals an empty one; repeated rows are documents of their own, linked
by their equal texts; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartlane.llm.components import connected
from cartlane.llm.shared import kept

SHARDS = 8

#: Rounds of moves within a large group, and how far above the even share a shard may fill meanwhile.
ROUNDS, SLACK = 3, 0.25

#: Times that a group bids for a shard.
BIDS = 6

#: Rows in a bucket on average: what one window sorts.
BUCKET_ROWS = 1 << 16


def _before(rows: DataFrame, by: str, classes: Column, hashed: Column, order: list, weight: Column, total: int) -> DataFrame:
    """Adds ``before``: the weights of all rows of the same ``by`` that come earlier.

    Rows are ordered by class, bucket of the hash, and ``order`` in the bucket.
    """
    buckets = max(1, -(-total // BUCKET_ROWS))
    marked = rows.withColumns({"__class": classes, "__bucket": F.pmod(hashed, F.lit(buckets)), "__weight": weight})
    sums = marked.groupBy(by, "__class", "__bucket").agg(F.sum("__weight").alias("__sum"))
    # A row per class and bucket: the number of rows over BUCKET_ROWS, and 64 classes.
    earlier = W.partitionBy(by).orderBy("__class", "__bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.withColumn("__start", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    inside = W.partitionBy(by, "__class", "__bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = marked.withColumn("__inside", F.coalesce(F.sum("__weight").over(inside), F.lit(0)))
    joined = summed.join(starts, [by, "__class", "__bucket"])
    return joined.withColumn("before", F.col("__start") + F.col("__inside")).drop(
        "__class", "__bucket", "__weight", "__start", "__inside"
    )


def _counts(labels: DataFrame, shards: int) -> list[int]:
    got = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [got.get(s, 0) for s in range(shards)]


def _by_shard(column: str, values: list) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), F.col(column) + 1)


def _round(labels: DataFrame, links: DataFrame, degrees: DataFrame, total: int, shards: int) -> DataFrame:
    """The labels after one round of moves to the shard of most neighbours with smaller numbers."""
    of_voter = labels.select(F.col("node").alias("voter"), F.col("shard").alias("target"))
    votes = links.join(of_voter, "voter").groupBy("node", "target").agg(F.count(F.lit(1)).alias("votes"), F.min("voter").alias("leader"))
    best = votes.groupBy("node").agg(
        F.max_by(F.struct("target", "leader"), F.struct("votes", -F.col("leader"), -F.col("target"))).alias("best")
    )
    moves = (
        best.select("node", "best.*").join(labels, "node").filter("target <> shard").select("node", "target", "leader")
    )
    soft = math.ceil(total / shards * (1 + SLACK))
    room = [max(0, soft - n) for n in _counts(labels, shards)]
    wanted = moves.groupBy("target", "leader").agg(F.count(F.lit(1)).alias("n")).join(degrees, "leader")
    ranked = _before(
        wanted, "target", F.floor(F.log2("degree")), F.xxhash64("leader"), [F.xxhash64("leader"), "leader"], F.col("n"), total
    )
    # The share of a leader's followers for which there is room; a hash picks that many of them.
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (_by_shard("target", room) - F.col("before")) / F.col("n")))
    let_in = ranked.select("target", "leader", share.alias("share")).filter("share > 0")
    fits = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(1 << 20)) < F.col("share") * F.lit(1 << 20)
    accepted = moves.join(let_in, ["target", "leader"]).filter(fits).select("node", F.col("target").alias("moved"))
    return labels.join(accepted, "node", "left").select("node", F.coalesce("moved", "shard").alias("shard"))


def _evened(labels: DataFrame, degrees: DataFrame, quotas: list[int], total: int) -> DataFrame:
    """The labels with no shard above its quota. What leaves goes to the fullest shards with room."""
    shards = len(quotas)
    counts = _counts(labels, shards)
    excess = [max(0, n - q) for n, q in zip(counts, quotas)]
    if not any(excess):
        return labels
    over = [s for s, n in enumerate(excess) if n]
    rows = labels.filter(F.col("shard").isin(over)).join(degrees.withColumnRenamed("leader", "node"), "node", "left")
    classes = F.when(F.col("degree").isNull(), F.lit(0)).otherwise(1 + F.floor(F.log2("degree")))
    ranked = _before(rows, "shard", classes, F.xxhash64("node"), [F.xxhash64("node"), "node"], F.lit(1), total)
    starts = [sum(excess[:s]) for s in range(shards)]
    leaving = ranked.filter(F.col("before") < _by_shard("shard", excess)).select(
        "node", (F.col("before") + _by_shard("shard", starts)).alias("place")
    )
    order = sorted(range(shards), key=lambda s: (-counts[s], s))
    moved = leaving.select("node", _filled([max(0, quotas[s] - counts[s]) for s in order], order).alias("moved"))
    return labels.join(moved, "node", "left").select("node", F.coalesce("moved", "shard").alias("shard"))


def _filled(rooms: list[int], order: list[int]) -> Column:
    """The shard of a ``place`` if the shards' rooms are filled one after the other."""
    shard, end = F.lit(order[-1]), sum(rooms)
    for s, room in reversed(list(zip(order, rooms))):
        end -= room
        shard = F.when(F.col("place") < end + room, F.lit(s)).otherwise(shard)
    return shard


def _spread(members: DataFrame, links: DataFrame, sizes: list[tuple[int, int]], quotas: list[int], total: int, rounds: int) -> DataFrame:
    """``node, shard`` for groups that no shard can hold, ``root, size``; there are fewer of them than shards.

    They lie one after the other over the shards, and then their nodes vote.
    """
    starts, upto = [], 0
    for root, size in sizes:
        starts.append((root, upto))
        upto += size
    begin = F.coalesce(*(F.when(F.col("root") == root, F.lit(start)) for root, start in starts))
    ranked = _before(members, "root", F.lit(0), F.xxhash64("node"), [F.xxhash64("node"), "node"], F.lit(1), total)
    shards = len(quotas)
    placed = ranked.withColumn("place", F.col("before") + begin).select("node", _filled(quotas, list(range(shards))).alias("shard"))
    labels = kept(placed, "shard-labels")
    inside = kept(links.join(members.select("node"), "node", "left_semi"), "shard-links")
    degrees = kept(inside.groupBy(F.col("voter").alias("leader")).agg(F.count(F.lit(1)).alias("degree")), "shard-degrees")
    for _ in range(rounds):
        labels = kept(_round(labels, inside, degrees, total, shards), "shard-labels")
    return kept(_evened(labels, degrees, quotas, total), "shard-labels")


def _packed(groups: DataFrame, rooms: list[int], total: int) -> tuple[DataFrame | None, list[int]]:
    """``root, shard`` of the groups (``root, size``) that find a shard with room for all of them, and the rooms left.

    Each group bids for one shard, the largest for the emptiest and so on in turn; a shard takes them from
    the largest on as long as they fit as wholes. Those refused bid again.
    """
    found = None
    rooms = list(rooms)
    for _ in range(BIDS):
        order = sorted((s for s, room in enumerate(rooms) if room > 1), key=lambda s: (-rooms[s], s))
        if not order:
            break
        smaller = 63 - F.floor(F.log2("size"))
        hashed, inside = F.xxhash64("root"), [F.desc("size"), F.xxhash64("root"), "root"]
        turn = _before(groups.withColumn("all", F.lit(0)), "all", smaller, hashed, inside, F.lit(1), total)
        shard = F.element_at(F.array(*map(F.lit, order)), (F.col("before") % len(order) + 1).cast("int"))
        bids = turn.select("root", "size", shard.alias("shard"))
        bids = _before(bids, "shard", smaller, hashed, inside, F.col("size"), total)
        fits = F.col("before") + F.col("size") <= _by_shard("shard", rooms)
        settled = kept(bids.select("root", "size", "shard", fits.alias("fits")), "shard-bids")
        got = settled.filter("fits").groupBy("shard").agg(F.sum("size").alias("n")).collect()
        if not got:
            break
        for r in got:
            rooms[r["shard"]] -= r["n"]
        taken = settled.filter("fits").select("root", "shard")
        found = taken if found is None else found.unionByName(taken)
        groups = settled.filter("NOT fits").select("root", "size")
        if groups.isEmpty():
            break
    return found, rooms


def propagate(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``node, shard, slot`` for all ``nodes``; ``links`` are pairs ``a, b`` of nodes, in any order."""
    directed = links.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("voter"))
    directed = kept(directed.distinct(), "shard-links")
    nodes = kept(nodes.select("node"), "shard-nodes")
    total = nodes.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    members = kept(connected(directed.select(F.col("node").alias("a"), F.col("voter").alias("b"))), "shard-groups")
    sizes = kept(members.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "shard-sizes")

    # A group larger than a shard's quota: there are fewer of them than shards.
    large = F.col("size") > total // shards
    giants = [(r["root"], r["size"]) for r in sizes.filter(large).orderBy(F.desc("size"), "root").collect()]
    parts, rooms = [], quotas
    if giants:
        of_giants = members.filter(F.col("root").isin([root for root, _ in giants]))
        parts.append(_spread(of_giants, directed, giants, quotas, total, rounds))
        rooms = [q - n for q, n in zip(quotas, _counts(parts[0], shards))]
    found, rooms = _packed(sizes.filter(~large), rooms, total)
    loose = members.filter(~members["root"].isin([root for root, _ in giants])) if giants else members
    if found is not None:
        parts.append(loose.join(found, "root").select("node", "shard"))
        loose = loose.join(found.select("root"), "root", "left_anti")
    # What is left fills up the shards: first groups that nowhere fit, each in one place of the line.
    alone = nodes.join(members.select("node"), "node", "left_anti").select("node", F.lit(None).cast("long").alias("root"))
    rest = loose.select("node", F.col("root").cast("long").alias("root")).unionByName(alone).withColumn("all", F.lit(0))
    by = F.xxhash64(F.coalesce("root", "node"))
    line = _before(rest, "all", F.col("root").isNull().cast("int"), by, [by, "root", "node"], F.lit(1), total)
    parts.append(line.select("node", F.col("before").alias("place")).select("node", _filled(rooms, list(range(shards))).alias("shard")))
    labels = kept(reduce(DataFrame.unionByName, parts), "shard-labels")
    ranked = _before(labels, "shard", F.lit(0), F.xxhash64("node"), [F.xxhash64("node"), "node"], F.lit(1), total)
    return ranked.select("node", "shard", F.col("before").cast("long").alias("slot"))


def cut_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """One row: ``links`` and how many of them are ``cut``, their ends in two shards."""
    a = labels.select(F.col("node").alias("a"), F.col("shard").alias("shard_a"))
    b = labels.select(F.col("node").alias("b"), F.col("shard").alias("shard_b"))
    both = links.join(a, "a").join(b, "b")
    return both.agg(F.count(F.lit(1)).alias("links"), F.count_if(F.col("shard_a") != F.col("shard_b")).alias("cut"))


def shard_documents(documents: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """Documents with equal texts kept together as far as shards of even counts allow."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = kept(
        documents.select(
            F.col(key).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("content"),
            F.monotonically_increasing_id().alias("node"),
        ),
        "shard-documents",
    )
    same = ["content", "text_crc32", "size"]
    first = rows.groupBy(*same).agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    links = rows.join(first, same).select("a", F.col("node").alias("b"))
    placed = propagate(rows.select("node"), links, shards)
    return rows.join(placed, "node").select(
        F.col("id").alias(key),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
