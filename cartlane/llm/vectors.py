"""Nearest neighbours by largest inner product: a robust-pruned directed graph for each shard.

Equal vectors are one node, with as many of the smallest ids as an answer can hold. Nodes are
dealt to shards of bounded size by a hash. A graph is built in batches: a greedy search
over the graph so far proposes the neighbours of a new node, and relaxed pruning keeps
those that no kept neighbour is much closer to; edges back are pruned the same way. A search keeps
a beam of the best nodes and follows the edges of those not yet followed. Blocks of queries
search every shard, and the best of all shards are ranked by exact products in double precision.

The largest products need not be the smallest angles. So a shard has a graph for each band of lengths,
within which the two orders are close: edges are chosen by angle, a search follows the largest products.
Bands are searched from long to short, and a query leaves out those whose longest vector cannot come into
its answer, which is short work where lengths differ much.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take
no part, neither do null ids; vectors of different lengths never meet; a repeated row counts
once; a query's own id is never in its answer; ties go to the smaller id; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartlane.llm.shared import kept

#: Neighbours in an answer; a query is a row whose id is a multiple of QUERY_STEP.
NEAREST, QUERY_STEP = 20, 20

#: Nodes in a shard and queries in a block, on average.
SHARD_ROWS, BLOCK_ROWS = 8192, 1024

#: Edges of a node after pruning, and room for edges back before it is pruned again.
DEGREE, ROOM = 32, 48
#: Nodes in the beam of a search, while building and for queries; nodes followed at once.
BUILD_BEAM, QUERY_BEAM, FOLLOWED = 64, 128, 4
#: A neighbour goes if a kept one is closer to it by this factor.
RELAXED = 1.2
#: How much longer than its shortest the longest vector of a graph may be.
BAND = 1.1
BATCH, SEED = 512, 11


class Graph(NamedTuple):
    points: np.ndarray  # float32
    edges: np.ndarray  # (n, ROOM) int32, -1 where there is none
    entry: int


def lengths_of(vectors: np.ndarray) -> np.ndarray:
    """The length of each vector, whatever the scale of its components."""
    scale = np.abs(vectors).max(axis=1, initial=0)
    scale[scale == 0] = 1
    return np.sqrt(np.square(vectors / scale[:, None]).sum(axis=1)) * scale


def bands_of(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of descending lengths: of one band the shortest is not shorter than the longest by more than
    ``BAND``, unless it would have fewer nodes than a beam."""
    out, begin = [], 0
    while begin < len(lengths):
        end = int(np.searchsorted(-lengths, -lengths[begin] / BAND, "right"))
        end = min(max(end, begin + QUERY_BEAM), len(lengths))
        out.append((begin, end))
        begin = end
    return out


def beam_search(graph: Graph, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``beam`` nodes of each query, best first (-1 for none), and all nodes followed."""
    points, edges, entry = graph
    count, n = len(queries), len(points)
    # A node stands in a beam as twice its number, plus 1 once it is followed; -1 is none.
    marks = np.full((count, beam), -1, np.int64)
    worth = np.full((count, beam), -np.inf, np.float32)
    marks[:, 0], worth[:, 0] = 2 * entry, queries @ points[entry]
    # The last column stands for edges that are not there.
    visited = np.zeros((count, n + 1), bool)
    visited[:, entry] = visited[:, n] = True
    seen = visited.reshape(-1)
    followed = []
    active = np.arange(count)
    while len(active):
        mine = marks[active]
        open_ = mine & 1 == 0
        turn = np.cumsum(open_, axis=1, dtype=np.int32)
        some = turn[:, -1] > 0
        if not some.all():
            active, mine, open_, turn = active[some], mine[some], open_[some], turn[some]
        if not len(active):
            break
        at, column = np.nonzero(open_ & (turn <= FOLLOWED))
        nodes = mine[at, column] >> 1
        mine[at, column] |= 1
        slot = turn[at, column] - 1
        step = np.full((count, FOLLOWED), -1, np.int64)
        step[active[at], slot] = nodes
        followed.append(step)
        # No edge is -1: that is the last column of the query before.
        place = (edges[nodes] + (active[at] * (n + 1))[:, None]).reshape(-1)
        fresh = np.flatnonzero(~seen[place])
        place, owner = place[fresh], at[fresh // edges.shape[1]]
        seen[place] = True
        near = place - active[owner] * (n + 1)
        gained = np.einsum("ij,ij->i", queries[active[owner]], points[near])
        # What is better than the last of the beam stands beside it, once; the best of both stay.
        held = worth[active]
        better = np.flatnonzero(gained > held[owner, -1])
        if len(better):
            _, once = np.unique(place[better], return_index=True)
            better = better[once]
            owner, near, gained = owner[better], near[better], gained[better]
            counts = np.bincount(owner, minlength=len(active))
            place = beam + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            all_marks = np.full((len(active), beam + counts.max()), -1, np.int64)
            all_worth = np.full(all_marks.shape, -np.inf, np.float32)
            all_marks[:, :beam], all_worth[:, :beam] = mine, held
            all_marks[owner, place], all_worth[owner, place] = 2 * near, gained
            order = np.argsort(-all_worth, axis=1, kind="stable")[:, :beam]
            mine = np.take_along_axis(all_marks, order, axis=1)
            worth[active] = np.take_along_axis(all_worth, order, axis=1)
        marks[active] = mine
    return marks >> 1, np.concatenate(followed, axis=1) if followed else marks[:, :0]


def robust_prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Up to ``degree`` of each node's candidates (-1 for none): the nearest, less what it covers, and so on."""
    out = np.full((len(nodes), degree), -1, np.int64)
    for a in range(0, len(nodes), 256):
        mine, given = nodes[a : a + 256], candidates[a : a + 256]
        ordered = np.sort(given, axis=1)
        ordered = ordered[:, min(int((ordered < 0).all(axis=0).sum()), ordered.shape[1] - 1) :]
        repeated = np.concatenate([np.zeros((len(ordered), 1), bool), ordered[:, 1:] == ordered[:, :-1]], axis=1)
        valid = (ordered >= 0) & ~repeated & (ordered != mine[:, None])
        x = points[np.maximum(ordered, 0)]
        # Points are directions: squared distances are 2 - 2 * products.
        own = 2 - 2 * np.einsum("bd,bcd->bc", points[mine], x)
        between = 2 - 2 * np.matmul(x, x.transpose(0, 2, 1))
        own = np.where(valid, np.maximum(own, 0), np.inf)
        rows = np.arange(len(mine))
        alive = valid.copy()
        for k in range(degree):
            best = np.where(alive, own, np.inf).argmin(axis=1)
            there = alive[rows, best]
            if not there.any():
                break
            out[a : a + 256][there, k] = ordered[rows, best][there]
            covered = RELAXED**2 * between[rows, best] <= own
            alive &= ~(covered & there[:, None])
            alive[rows, best] = False
    return out


def build_graph(vectors: np.ndarray, lengths: np.ndarray, seed: int = SEED) -> Graph:
    """The graph of a band: nodes enter in random order, in batches that grow with the graph.

    Edges are chosen by angle, among directions; searches go by product, so the points of the graph that
    is returned have their lengths, to the scale of the longest.
    """
    points = (vectors / lengths[:, None]).astype(np.float32)
    n = len(points)
    edges = np.full((n, ROOM), -1, np.int32)
    entry = int((points @ points.mean(axis=0)).argmax())
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != entry]
    graph = Graph(points, edges, entry)
    at = 0
    while at < len(order):
        batch = order[at : at + min(BATCH, at + 1)]
        at += len(batch)
        _, followed = beam_search(graph, points[batch], BUILD_BEAM)
        chosen = robust_prune(points, batch, followed)
        edges[batch, :DEGREE] = chosen
        # Edges back, by the node they begin at.
        source = np.repeat(batch, DEGREE)
        target = chosen.reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        while len(target):
            heads, first, counts = np.unique(target, return_index=True, return_counts=True)
            turn = np.arange(len(target)) - np.repeat(first, counts)
            used = (edges[heads] >= 0).sum(axis=1)
            room = np.repeat(ROOM - used, counts)
            fits = turn < room
            column = np.repeat(used, counts)[fits] + turn[fits]
            edges[target[fits], column] = source[fits]
            source, target = source[~fits], target[~fits]
            full = np.unique(target)
            if len(full):
                pruned = robust_prune(points, full, edges[full].astype(np.int64))
                edges[full] = -1
                edges[full, :DEGREE] = pruned
    return graph._replace(points=points * (lengths / lengths.max())[:, None].astype(np.float32))


def _finite(vector: Column) -> Column:
    """Not null, not empty, not zero, and finite in every component."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & good & F.exists(vector, lambda x: x != 0)


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id``, ``vector`` in double precision and ``dim`` of the rows that take part."""
    picked = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return picked.filter(F.col("id").isNotNull() & _finite(F.col("vector"))).withColumn("dim", F.size("vector"))


_SHARD = (
    "dim int, shard int, n long, vectors binary, members binary, ends binary, points binary, edges binary,"
    " bands binary, entries binary, longest binary"
)


def build_index(rows: DataFrame, nearest: int = NEAREST, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """One row per shard, and the number of shards. Every row of ``usable`` is in it.

    A node holds the ``nearest + 1`` smallest ids of its vector: no answer can hold more. The limit
    on them goes before the shuffle, so a vector of a third of all rows is no large group.
    """
    rank = F.row_number().over(W.partitionBy("dim", "vector").orderBy("id"))
    few = rows.distinct().withColumn("rank", rank).filter(F.col("rank") <= nearest + 1)
    nodes = kept(few.groupBy("dim", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vector-nodes")
    shards = max(1, -(-nodes.count() // shard_rows))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        lengths = lengths_of(vectors)
        order = np.argsort(-lengths, kind="stable")
        vectors, lengths = vectors[order], lengths[order]
        members = pdf["ids"].to_numpy()[order]
        bands = bands_of(lengths)
        graphs = [build_graph(vectors[a:b], lengths[a:b]) for a, b in bands]
        row = {
            "dim": int(pdf["dim"].iloc[0]),
            "shard": int(pdf["shard"].iloc[0]),
            "n": len(vectors),
            "vectors": vectors.tobytes(),
            "members": np.concatenate(members).astype(np.int64).tobytes(),
            "ends": np.cumsum([len(x) for x in members]).astype(np.int64).tobytes(),
            "points": b"".join(g.points.tobytes() for g in graphs),
            "edges": b"".join(g.edges.tobytes() for g in graphs),
            "bands": np.array([b for _, b in bands], np.int64).tobytes(),
            "entries": np.array([g.entry for g in graphs], np.int64).tobytes(),
            "longest": lengths[[a for a, _ in bands]].tobytes(),
        }
        return pd.DataFrame([row])

    shard = F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int")
    index = nodes.withColumn("shard", shard).groupBy("dim", "shard").applyInPandas(build, _SHARD)
    return kept(index, "vector-index"), shards


def _blocks(queries: DataFrame, rows: int) -> DataFrame:
    """Queries in blocks, one row each."""
    blocks = max(1, -(-queries.count() // rows))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        ids = pdf["id"].to_numpy(np.int64)
        return pd.DataFrame([{"dim": int(pdf["dim"].iloc[0]), "ids": ids.tobytes(), "queries": vectors.tobytes()}])

    dealt = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    return kept(dealt.groupBy("dim", "block").applyInPandas(pack, "dim int, ids binary, queries binary"), "query-blocks")


class _Answers:
    """The best members for each query so far."""

    def __init__(self, own: list[int], nearest: int):
        self._own, self._nearest = own, nearest
        self.best: list[list[tuple[float, int]]] = [[] for _ in own]
        #: The worth of each query's last answer, once there are enough.
        self.least = np.full(len(own), -np.inf)

    def add(self, at: int, worth: np.ndarray, members: list[np.ndarray]) -> None:
        """Nodes with their members: those of equal worth all count, the smallest ids win."""
        found = [(-w, int(m)) for w, ids in zip(worth.tolist(), members) for m in ids if m != self._own[at] and w >= self.least[at]]
        self.best[at] = sorted(self.best[at] + found)[: self._nearest]
        if len(self.best[at]) == self._nearest:
            self.least[at] = -self.best[at][-1][0]


def _promising(worth: np.ndarray, nearest: int, slack: float) -> np.ndarray:
    """Which nodes can be in an answer, of which one may be the query's own: a product of many at once may differ
    in its last digits from that of one pair."""
    if len(worth) <= nearest + 1:
        return np.ones(len(worth), bool)
    return ~(worth < np.partition(worth, -nearest - 1)[-nearest - 1] - slack)


def _searched(nearest: int, beam: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                dim, n = row["dim"], row["n"]
                vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, dim)
                members = np.split(np.frombuffer(row["members"], np.int64), np.frombuffer(row["ends"], np.int64)[:-1])
                points = np.frombuffer(row["points"], np.float32).reshape(n, dim)
                edges = np.frombuffer(row["edges"], np.int32).reshape(n, ROOM)
                ids = np.frombuffer(row["ids"], np.int64)
                queries = np.frombuffer(row["queries"], np.float64).reshape(len(ids), dim)
                lengths = lengths_of(queries)
                directions = (queries / lengths[:, None]).astype(np.float32)
                answers = _Answers(ids.tolist(), nearest)
                begin = 0
                for end, entry, longest in zip(*(np.frombuffer(row[c], t).tolist() for c, t in (("bands", np.int64), ("entries", np.int64), ("longest", np.float64)))):
                    # No product is above that of the lengths; bands come from long to short.
                    asking = np.flatnonzero(lengths * longest * (1 + 1e-9) >= answers.least)
                    if not len(asking):
                        break
                    found, _ = beam_search(Graph(points[begin:end], edges[begin:end], entry), directions[asking], beam)
                    for at, nodes in zip(asking.tolist(), found):
                        nodes = nodes[nodes >= 0] + begin
                        nodes = nodes[_promising(vectors[nodes] @ queries[at], nearest, 1e-9 * lengths[at] * longest)]
                        exact = np.array([float(np.dot(queries[at], vectors[i])) for i in nodes])
                        answers.add(at, exact, [members[i] for i in nodes])
                    begin = end
                out = [(own, m, -w) for own, best in zip(ids.tolist(), answers.best) for w, m in best]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def search(
    rows: DataFrame,
    queries: DataFrame,
    nearest: int = NEAREST,
    beam: int = QUERY_BEAM,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest of ``rows`` to each of ``queries`` (both from ``usable``).

    Each block of queries goes to each shard once: a row of the join is a block and a shard's graph.
    """
    index, shards = build_index(rows, nearest, shard_rows)
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = _blocks(queries.distinct(), block_rows).withColumn("shard", every)
    met = asked.join(index, ["dim", "shard"])
    found = met.mapInPandas(_searched(nearest, beam), "query_id long, vec_id long, score double").distinct()
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest).select(
        "query_id", "rank", "vec_id", "score"
    )


def search_every(rows: DataFrame, step: int = QUERY_STEP, **options) -> DataFrame:
    """The nearest of all usable rows to those whose id is a multiple of ``step``."""
    part = kept(usable(rows), "usable-vectors")
    return search(part, part.filter(F.col("id") % step == 0), **options)
