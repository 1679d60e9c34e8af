"""Ranked lexical search: the best documents for each item, by a tree of documents that share frequent terms.

Documents are reduced to the terms of the items: ``(term, tf)`` in order of the terms' document
frequency, the most frequent first. In a task, ``DOCUMENTS`` of them at a time make a tree: documents
with the same first terms share a path, a path without a fork is one step, and a node with few
documents, or with the rest of its fork's small branches, is a leaf. A node holds, for each term below
it, the largest tf of its documents, and the smallest length norm m. A score grows with tf and falls
with m, so these give a bound on every score below the node. For each item the tree is searched depth
first, the better branch before the others; a branch whose bound is below the tenth score found so far
is left out. A task carries the scores found from one tree to the next, and hands over ten documents
per item.

Items are the queries: they go to the tasks in groups of ``ITEMS_BYTES`` at most, with a pass for each.

Defined results: null and empty texts have no terms and are in no answer, and an item without terms
has none; repeated items have an answer each; repeated documents are answers of their own, a null id
before all others; equal scores by id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlane.llm.shared import bounded, kept
from cartlane.llm.texts import Keys, RangeHash, byte_table, chunks, flat, lowered, words

#: Answers of an item.
TOP = 10

#: Documents in a tree and in a leaf, and terms of documents in a tree at most.
DOCUMENTS, LEAF, ENTRIES = 1 << 13, 32, 1 << 22

#: Bytes of items that are sent to every task.
ITEMS_BYTES = 16 << 20

# Digits, letters in lower case, and all that is not ASCII.
_INSIDE = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)

# Fixed values of the score: a share of the length of a document counts, the rest is the same for all.
_SCALE, _TF, _NORM, _LENGTH = 1_000_000_000, 1000, 8, 90


class Vocabulary:
    """The terms of the items; finds words among them by a hash and then byte for byte."""

    def __init__(self, texts: pa.Array):
        """``texts`` are items; ``items`` are their terms as numbers, once each."""
        data, offsets = flat(texts)
        data = lowered(data)
        begins, ends, before = words(data, offsets, _INSIDE)
        terms: dict[bytes, int] = {}
        raw = data.tobytes()
        numbers = [terms.setdefault(raw[a:b], len(terms)) for a, b in zip(begins.tolist(), ends.tolist())]
        self.items = [np.unique(np.array(numbers[a:b], np.int64)) for a, b in zip(before, before[1:])]
        self.size = len(terms)
        joined = list(terms)
        self._ends = np.cumsum([len(t) for t in joined], dtype=np.int64)
        self._begins = self._ends - np.array([len(t) for t in joined], np.int64)
        self._data = np.frombuffer(b"".join(joined), np.uint8)
        hashes = RangeHash(self._data)(self._begins, self._ends)
        self._order = np.argsort(hashes)
        self._hashes = hashes[self._order]

    def find(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words of no item."""
        if not self.size:
            return np.full(len(begins), -1)
        hashes = RangeHash(data)(begins, ends)
        at = np.minimum(np.searchsorted(self._hashes, hashes), self.size - 1)
        out = np.where(self._hashes[at] == hashes, self._order[at], -1)
        found = np.flatnonzero(out >= 0)
        own, other = Keys(data), Keys(self._data)
        a, b = begins[found], ends[found]
        c, d = self._begins[out[found]], self._ends[out[found]]
        wrong = (b - a) != (d - c)
        out[found[wrong]] = -1
        while len(a):
            wrong = own(a, b) != other(c, d)
            out[found[wrong]] = -1
            more = (b - a) > 8
            a, b, c, d, found = a[more] + 8, b[more], c[more] + 8, d[more], found[more]
        return out


def term_vectors(documents: DataFrame, vocabulary, key: str = "doc_id") -> DataFrame:
    """Documents with terms at all: ``key, n`` terms with repeats, ``terms`` of the vocabulary, ``tfs``."""
    rows = bounded(documents).select(key, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for chunk in chunks(batches):
            data, offsets = flat(chunk.column(1))
            data = lowered(data)
            begins, ends, before = words(data, offsets, _INSIDE)
            n = np.diff(before)
            numbers = known.find(data, begins, ends)
            found = numbers >= 0
            document = np.repeat(np.arange(len(n)), n)[found]
            pairs, tfs = np.unique(document * max(1, known.size) + numbers[found], return_counts=True)
            stops = np.searchsorted(pairs, np.arange(len(n) + 1) * max(1, known.size)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(stops, pa.array(v, pa.int32())) for v in (pairs % max(1, known.size), tfs)]
            out = pa.RecordBatch.from_arrays([chunk.column(0), pa.array(n, pa.int64()), *lists], [key, "n", "terms", "tfs"])
            yield out.filter(pa.array(n > 0))

    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, n long, terms array<int>, tfs array<int>")


def worth(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term with weight 1 gives a document."""
    return _SCALE * tf // (_TF * tf + _NORM * m)


@dataclass
class Tree:
    """Documents in the order of their paths, and nodes with bounds.

    ``begin`` and ``end`` are the documents of a node, ``children`` its nodes, none for a leaf. The
    bounds stand by term: those of term ``t`` are ``stops[t]`` to ``stops[t + 1]`` of ``nodes`` and ``most``.
    """

    order: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray
    begin: list[int]
    end: list[int]
    children: list[list[int]]
    stops: np.ndarray
    nodes: np.ndarray
    most: np.ndarray


def _forks(paths: list[bytes], leaf: int) -> tuple[list[int], list[int], list[list[int]]]:
    """The nodes over sorted paths of four bytes a term; a parent stands before its children."""
    begin, end, children = [0], [len(paths)], [[]]
    todo = [(0, 0)]
    while todo:
        node, depth = todo.pop()
        a, b = begin[node], end[node]
        if b - a <= leaf:
            continue
        first, last = paths[a], paths[b - 1]
        while first[depth : depth + 4] == last[depth : depth + 4] and depth < len(first):
            depth += 4
        if first == last:  # one path for all
            continue
        # Branches of the fork, those with few documents together with their neighbours.
        cuts, at = [a], a
        while at < b:
            term = paths[at][depth : depth + 4]
            stop, step = at, 1
            while stop + step < b and paths[stop + step][depth : depth + 4] == term:
                stop, step = stop + step, step * 2
            while step:
                if stop + step < b and paths[stop + step][depth : depth + 4] == term:
                    stop += step
                step //= 2
            stop += 1
            if stop - cuts[-1] > leaf and cuts[-1] < at:
                cuts.append(at)
            if stop - at > leaf:
                cuts.append(stop)
            at = stop
        if cuts[-1] < b:
            cuts.append(b)
        for x, y in zip(cuts, cuts[1:]):
            child = len(begin)
            begin.append(x)
            end.append(y)
            children.append([])
            children[node].append(child)
            # Only a branch of one term goes on below it.
            if paths[x][depth : depth + 4] == paths[y - 1][depth : depth + 4]:
                todo.append((child, depth + 4))
    return begin, end, children


def make_tree(starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray, size: int, leaf: int = LEAF) -> Tree:
    """A tree over documents with terms ``terms[starts[i]:starts[i + 1]]``, ascending; ``size`` terms exist."""
    raw = terms.astype(">u4").tobytes()
    paths = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), starts[1:].tolist())]
    order = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
    sizes = np.diff(starts)[order]
    stops = np.concatenate([[0], np.cumsum(sizes)])
    entry = np.repeat(starts[:-1][order] - stops[:-1], sizes) + np.arange(stops[-1])
    terms, tfs, m = terms[entry].astype(np.int64), tfs[entry].astype(np.int64), m[order]
    begin, end, children = _forks([paths[i] for i in order.tolist()], leaf)
    # The largest tf of each term, from the leaves up.
    below: list = [None] * len(begin)
    least = [0] * len(begin)
    for node in range(len(begin) - 1, -1, -1):
        if children[node]:
            parts = [below[c] for c in children[node]]
            own, tf = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            least[node] = min(least[c] for c in children[node])
        else:
            a, b = stops[begin[node]], stops[end[node]]
            own, tf, least[node] = terms[a:b], tfs[a:b], int(m[begin[node] : end[node]].min())
        ranked = np.lexsort((tf, own))
        own, tf = own[ranked], tf[ranked]
        last = np.flatnonzero(np.append(own[1:] != own[:-1], True)) if len(own) else np.zeros(0, np.int64)
        below[node] = own[last], tf[last]
    owner = np.repeat(np.arange(len(begin)), [len(b[0]) for b in below])
    own, tf = np.concatenate([b[0] for b in below]), np.concatenate([b[1] for b in below])
    most = worth(tf, np.array(least, np.int64)[owner])
    ranked = np.argsort(own, kind="stable")
    by_term = np.searchsorted(own[ranked], np.arange(size + 1))
    values = worth(tfs, np.repeat(m, sizes))
    return Tree(order, stops, terms, values, begin, end, children, by_term, owner[ranked], most[ranked])


class Best:
    """The best answers of an item so far: highest score, then smallest id, null before all."""

    def __init__(self, top: int):
        self._top = top
        self._heap: list[tuple] = []

    @property
    def least(self) -> int:
        """A score below this one is no answer."""
        return self._heap[0][0] if len(self._heap) == self._top else 1

    def add(self, score: int, key) -> None:
        entry = (score, math.inf if key is None else -key)
        if len(self._heap) < self._top:
            heapq.heappush(self._heap, entry)
        elif entry > self._heap[0]:
            heapq.heapreplace(self._heap, entry)

    def answers(self) -> list[tuple]:
        return [(score, None if key == math.inf else -key) for score, key in self._heap]


def search(tree: Tree, item: np.ndarray, weights: np.ndarray, keys: list, best: Best, scratch: np.ndarray) -> int:
    """Depth-first branch and bound for one item; ``scratch`` is zeros, one per term. Returns leaves seen."""
    bounds = np.zeros(len(tree.begin), np.int64)
    for term in item.tolist():
        some = slice(tree.stops[term], tree.stops[term + 1])
        bounds[tree.nodes[some]] += weights[term] * tree.most[some]
    bounds = bounds.tolist()
    scratch[item] = weights[item]
    todo, seen = [0], 0
    while todo:
        node = todo.pop()
        if bounds[node] < best.least:
            continue
        if tree.children[node]:
            todo += sorted((c for c in tree.children[node] if bounds[c] >= best.least), key=bounds.__getitem__)
            continue
        seen += 1
        begin, end = tree.begin[node], tree.end[node]
        starts = tree.starts[begin:end]
        a, b = tree.starts[begin], tree.starts[end]
        sums = np.concatenate([[0], np.cumsum(scratch[tree.terms[a:b]] * tree.values[a:b])])
        scores = sums[tree.starts[begin + 1 : end + 1] - a] - sums[starts - a]
        for at in np.flatnonzero(scores >= best.least).tolist():
            best.add(int(scores[at]), keys[tree.order[begin + at]])
    scratch[item] = 0
    return seen


def _trees(batches: Iterator[pa.RecordBatch], documents: int, entries: int) -> Iterator[pa.RecordBatch]:
    """Documents for a tree: ``documents`` of them, or fewer with ``entries`` terms."""
    waiting: list[pa.RecordBatch] = []
    count = size = 0
    for batch in batches:
        while len(batch):
            ends = np.cumsum(batch["terms"].value_lengths().to_numpy(zero_copy_only=False))
            take = min(documents - count, int(np.searchsorted(ends, entries - size, "right")))
            take = max(take, 0 if waiting else 1)
            if take:
                waiting.append(batch.slice(0, take))
                count, size = count + take, size + int(ends[take - 1])
                batch = batch.slice(take)
            if len(batch) or count >= documents:
                yield pa.concat_batches(waiting)
                waiting, count, size = [], 0, 0
    if waiting:
        yield pa.concat_batches(waiting)


def _item_groups(items: DataFrame, item_key: str, limit: int) -> Iterator[pa.Table]:
    rows = items.select(F.col(item_key).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first()["n"]
    # Each group is bounded by the limit, with room for the unevenness of a hash.
    groups = 1 if size <= limit else 2 * -(-size // limit)
    for g in range(groups):
        part = rows if groups == 1 else rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == g)
        found = part.toArrow().combine_chunks()
        if len(found):
            yield found


def _search_group(documents: DataFrame, items: pa.Table, items_type: T.DataType, top: int, key: str, shape: dict) -> DataFrame:
    spark = documents.sparkSession
    vocabulary = Vocabulary(items.column("text").cast(pa.string()).combine_chunks())
    vectors = kept(term_vectors(documents, spark.sparkContext.broadcast(vocabulary), key), "vectors")
    sizes = vectors.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("all")).first()
    # One row per term of the items, which are bounded.
    counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    df = np.zeros(vocabulary.size, np.int64)
    df[counts["term"].to_numpy()] = counts["df"].to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * sizes["n"] + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    # The most frequent term is number 0; ties keep their order.
    by_df = np.argsort(-df, kind="stable")
    number = np.empty(vocabulary.size, np.int64)
    number[by_df] = np.arange(vocabulary.size)
    weights = weights[by_df]
    asked = [np.sort(number[i]) for i in vocabulary.items]
    sent = spark.sparkContext.broadcast((number, weights, asked, items.column("item").combine_chunks()))

    wide = F.lit(_LENGTH).cast("decimal(2,0)") * F.col("n").cast("decimal(16,0)") * F.lit(sizes["n"]).cast("decimal(18,0)")
    m = F.call_function("div", wide, F.lit(max(1, sizes["all"])).cast("decimal(20,0)")) + (100 - _LENGTH)
    rows = vectors.filter(F.size("terms") > 0).select(key, m.alias("m"), "terms", "tfs")
    names = ["__row", "item", key, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, weights, asked, ids = sent.value
        best = [Best(top) for _ in asked]
        scratch = np.zeros(len(weights), np.int64)
        keys_type = None
        for batch in _trees(batches, shape["documents"], shape["entries"]):
            keys_type = batch[key].type
            lists = batch["terms"]
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(lengths)])
            terms, tfs = number[lists.flatten().to_numpy()], batch["tfs"].flatten().to_numpy()
            ranked = np.lexsort((terms, np.repeat(np.arange(len(lengths)), lengths)))
            tree = make_tree(starts, terms[ranked], tfs[ranked], batch["m"].to_numpy(), len(weights), shape["leaf"])
            keys = batch[key].to_pylist()
            for item, found in zip(asked, best):
                search(tree, item, weights, keys, found, scratch)
        if keys_type is None:
            return
        out = [(at, key, score) for at, found in enumerate(best) for score, key in found.answers()]
        at, keys, scores = ([r[k] for r in out] for k in range(3))
        columns = [pa.array(at, pa.int64()), ids.take(pa.array(at, pa.int64())), pa.array(keys, keys_type), pa.array(scores, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType(
        [
            T.StructField("__row", T.LongType()),
            T.StructField("item", items_type),
            T.StructField(key, documents.schema[key].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    found = rows.mapInArrow(run, schema)
    order = Window.partitionBy("__row").orderBy(F.desc("score"), F.asc_nulls_first(key))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def best_documents(
    documents: DataFrame,
    items: DataFrame,
    top: int = TOP,
    key: str = "doc_id",
    item_key: str = "item_id",
    items_bytes: int = ITEMS_BYTES,
    tree_documents: int = DOCUMENTS,
    tree_entries: int = ENTRIES,
    leaf: int = LEAF,
) -> DataFrame:
    """``item_key, rank, key, score``: the ``top`` documents of each item with a score above 0.

    The key is a whole number.
    """
    shape = {"documents": tree_documents, "entries": tree_entries, "leaf": leaf}
    kind = items.schema[item_key].dataType
    rows = documents.select(key, "text")
    parts = [_search_group(rows, group, kind, top, key, shape) for group in _item_groups(items, item_key, items_bytes)]
    if not parts:
        empty = [T.StructField("item", kind), T.StructField("rank", T.IntegerType()), rows.schema[key], T.StructField("score", T.LongType())]
        parts = [documents.sparkSession.createDataFrame([], T.StructType(empty))]
    picked = [p.select(F.col("item").alias(item_key), "rank", key, "score") for p in parts]
    return reduce(DataFrame.unionByName, picked)
