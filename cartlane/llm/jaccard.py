"""N-gram Jaccard join: rare-first prefixes, length, positional and suffix filters, one verification.

A document is the set of its distinct shingles of ``WORDS`` words, known by 64-bit hashes. Equal
sets are one class, known by a hash of the set, before anything is joined. The shingles of a set
are ordered from rare to frequent by a table of ``COUNTERS`` counts made over all documents; any
order gives the same links, a good one few candidates. Two sets that link share a shingle
among their first ones, their prefixes, so classes meet on prefix shingles:

- length: the smaller set has to be large enough for the larger;
- position: the shingles shared so far and those left behind the last of them have to suffice;
- suffix: the sets fall into ``PARTS`` parts by hash, whose smaller sizes have to add up;
- what is left is verified once, on whole sets.

For components the pairs of a group of near copies are not made. Each shingle has a centre, its
class that shares most with others: of copies that were edited here and there, the one edited
least. First the classes meet their centres, and what links is contracted. A class belongs to the
centre near it that shares most of all, and so may that centre: the last one on this way is its home.
Two classes of one home differ in as many shingles as what they differ from the home in differs. So they
meet on these items, again rare first, by one prefix for partners of all sizes, and only if one of them
does not link to the home. Classes of different homes meet on the shingle itself. Classes of one component do not
meet again. Nothing is lost: every pair that shares a prefix shingle is of one of these kinds.

Defined results: null and empty texts, and texts without words, have no shingles and link with
nothing, nor with each other; a text of one or two words is one shingle; rows with the same id
are separate documents under one id; a class with null ids only has a null component; extra
columns are ignored or kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlane.llm.components import connected
from cartlane.llm.shared import bit_filter, bounded, dropped, fetched, filter_place, in_filter, kept
from cartlane.llm.texts import RangeHash, byte_table, chunks, flat, lowered, mixed, words

#: Words in a shingle, and the least similarity in hundredths.
WORDS, PERCENT = 3, 90

#: Counters for the order of shingles, and parts of the suffix filter.
COUNTERS, PARTS = 1 << 23, 16

#: From this similarity on, in hundredths, a class is near a centre.
NEAR = 60
#: Classes of a shingle from which on each is compared with the centre.
CROWD = 16

_BLOCK = 1 << 17
_MOST = 2**16 - 1
#: Sets that a task remembers to send once only.
_SEEN = 1 << 20

# The bytes between words.
_WORD = byte_table(lambda b: b not in (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D))


def shingle_sets(texts: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = flat(texts)
    data = lowered(data)
    begins, ends, before = words(data, offsets, _WORD)
    hashed = RangeHash(data)(begins, ends)
    total = np.zeros(len(hashed), np.uint64)
    for j in range(size):
        scale = np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) % 2**64)
        total[: len(hashed) - j] += mixed(hashed[j:] + np.uint64(j)) * scale
    total = mixed(total)
    out = []
    for a, b in zip(before.tolist(), before[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(total[a : b - size + 1]))
        elif b > a:
            short = xxhash.xxh3_64_intdigest(hashed[a:b].tobytes(), seed=b - a)
            out.append(np.array([short], np.uint64))
        else:
            out.append(total[:0])
    return out


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def _class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


_SETS = "id long, cls long, n int, parts array<int>, task int, block int, counts binary"


def _described(documents: DataFrame, key: str, size: int) -> DataFrame:
    """A row per document, and rows with the task's counts of shingles by block of counters."""
    rows = documents.select(F.col(key).cast("long").alias("id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint16)
        schema = pa.schema(
            [
                ("id", pa.int64()), ("cls", pa.int64()), ("n", pa.int32()), ("parts", pa.list_(pa.int32())),
                ("task", pa.int32()), ("block", pa.int32()), ("counts", pa.binary()),
            ]
        )
        for chunk in chunks(batches):
            sets = shingle_sets(chunk.column(1), size)
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            slots, seen = np.unique((every % np.uint64(COUNTERS)).astype(np.int64), return_counts=True)
            counts[slots] = np.minimum(counts[slots].astype(np.int64) + seen, _MOST)
            none = [None] * len(sets)
            values = [
                [i.as_py() for i in chunk.column(0)], [_class_of(s) for s in sets], [len(s) for s in sets],
                [np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=PARTS) for s in sets], none, none, none,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)
        task = TaskContext.get().partitionId()
        for block in range(COUNTERS // _BLOCK):
            part = counts[block * _BLOCK : (block + 1) * _BLOCK]
            if part.any():
                row = [None, None, None, None, task, block, zlib.compress(part.tobytes(), 1)]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    return rows.mapInArrow(run, _SETS)


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(_BLOCK, np.uint64)
    for counts in pdf["counts"]:
        total += np.frombuffer(zlib.decompress(counts), np.uint16)
    counts = np.minimum(total, _MOST).astype(np.uint16)
    return pd.DataFrame(
        {"task": [int(pdf["task"].iloc[0])], "block": [int(pdf["block"].iloc[0])], "counts": [zlib.compress(counts.tobytes(), 1)]}
    )


def _counters(described: DataFrame) -> list[bytes]:
    """All tasks' counts added up: one table of fixed size, in compressed blocks. At most 256 tables meet in one task."""
    rows = described.filter("block IS NOT NULL").select("task", "block", "counts")
    for _ in range(2):
        rows = rows.withColumn("task", F.floor(F.col("task") / 256).cast("int"))
        rows = rows.groupBy("task", "block").applyInPandas(_added, "task int, block int, counts binary")
    blocks = [zlib.compress(bytes(2 * _BLOCK), 1)] * (COUNTERS // _BLOCK)
    for r in fetched(rows):  # one row per block, and per 65,536 tasks
        one, two = (np.frombuffer(zlib.decompress(c), np.uint16).astype(np.uint32) for c in (blocks[r["block"]], r["counts"]))
        blocks[r["block"]] = zlib.compress(np.minimum(one + two, _MOST).astype(np.uint16).tobytes(), 1)
    return blocks


def _prefixes(documents: DataFrame, counters: list[bytes], size: int, percent: int) -> DataFrame:
    """``token, cls, n, pos``: the rarest shingles of each class. Copies in one task are sent once."""
    sent = documents.sparkSession.sparkContext.broadcast(counters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint16)
        for block, part in enumerate(sent.value):
            counts[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(zlib.decompress(part), np.uint16)
        seen: set[int] = set()
        for chunk in chunks(batches):
            tokens, classes, sizes, places = [], [], [], []
            for shingles in shingle_sets(chunk.column(0), size):
                cls = _class_of(shingles)
                if not len(shingles) or cls in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(cls)
                p = prefix_size(len(shingles), percent)
                order = np.lexsort((shingles, counts[(shingles % np.uint64(COUNTERS)).astype(np.int64)]))[:p]
                tokens.append(shingles[order])
                classes.append(np.full(p, cls, np.int64))
                sizes.append(np.full(p, len(shingles), np.int32))
                places.append(np.arange(1, p + 1, dtype=np.int32))
            if tokens:
                arrays = [np.concatenate(tokens).view(np.int64), *(np.concatenate(x) for x in (classes, sizes, places))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["token", "cls", "n", "pos"])

    return documents.select("text").mapInArrow(run, "token long, cls long, n int, pos int")


def _enough(shared: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether so many shared shingles make a link of sets of sizes ``a`` and ``b``; whole numbers only."""
    return F.lit(100 + percent).cast("long") * shared >= F.lit(percent).cast("long") * (a + b)


def _fits(a: Column, b: Column, percent: int) -> Column:
    """The length filter."""
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``a, b`` that the length and suffix filters let pass, with their sizes and a document of each."""
    one, two = (
        classes.select(F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("parts").alias(f"p{x}"), F.col("least").alias(f"id_{x}"))
        for x in "ab"
    )
    met = pairs.select("a", "b").join(one, "a").join(two, "b").filter(_fits(F.col("na"), F.col("nb"), percent))
    shared = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.least(x, y)), F.lit(0), lambda n, x: n + x)
    return met.filter(_enough(shared, F.col("na"), F.col("nb"), percent)).select("a", "b", "na", "nb", "id_a", "id_b")


_COMPARED = "a long, b long, na int, nb int, overlap int, added array<long>, lacking array<long>"


def _compared(documents: DataFrame, key: str, classes: DataFrame, pairs: DataFrame, size: int, near: int) -> DataFrame:
    """``overlap`` of the whole sets of each pair; for those at least ``near`` what ``b`` added to ``a`` and lacks.

    The texts travel, one document of each class, since they are smaller than their sets. Only
    documents whose id may be asked for leave their task. ``pairs`` may hold these ids as ``id_a, id_b``.
    """
    asked = pairs
    if "id_a" not in pairs.columns:
        for x in "ab":
            asked = asked.join(classes.select(F.col("cls").alias(x), F.col("least").alias(f"id_{x}")), x)
    asked = kept(asked.select("a", "b", "na", "nb", "id_a", "id_b"), "asked")
    filters = []

    def texts(column: str, name: str) -> DataFrame:
        bits = documents.sparkSession.sparkContext.broadcast(bit_filter(asked.select(column), column))
        filters.append(bits)
        id_ = F.col(key).cast("long")
        rows = documents.select(id_.alias(name), F.col("text").alias(f"text_{name}"), filter_place(id_).alias("place"))

        def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(in_filter(bits.value, batch.column(2).to_numpy(zero_copy_only=False))))

        return rows.mapInArrow(likely, rows.schema).drop("place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "na", "nb", "text_one", "text_two"]
        for chunk in chunks(chunks(batches, "text_one"), "text_two"):
            a, b, na, nb = (chunk.column(names.index(c)).to_pylist() for c in ("a", "b", "na", "nb"))
            first = shingle_sets(chunk.column(names.index("text_one")), size)
            second = shingle_sets(chunk.column(names.index("text_two")), size)
            rows = []
            for i, (x, y) in enumerate(zip(first, second)):
                # Another document may bear the same id.
                if _class_of(x) != a[i] or _class_of(y) != b[i]:
                    continue
                both = np.intersect1d(x, y, assume_unique=True)
                added = lacking = None
                if 100 * len(both) >= near * (len(x) + len(y) - len(both)):
                    added = np.setdiff1d(y, both, assume_unique=True).view(np.int64)
                    lacking = np.setdiff1d(x, both, assume_unique=True).view(np.int64)
                rows.append((a[i], b[i], na[i], nb[i], len(both), added, lacking))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = list(zip(*rows)) or [()] * len(types)
            fields = [f.split()[0] for f in _COMPARED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], fields)

    two = texts("id_b", "two")
    met = asked.join(two, asked["id_b"].eqNullSafe(two["two"])).drop("two", "id_b")
    one = texts("id_a", "one")
    met = met.join(one, met["id_a"].eqNullSafe(one["one"])).select("a", "b", "na", "nb", "text_one", "text_two")
    compared = kept(met.mapInArrow(run, _COMPARED), "compared")
    dropped(asked)
    for bits in filters:
        bits.destroy()
    return compared


def _met(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs ``x_*, y_*`` of rows with one token and different labels and homes, one of them asking.

    ``rows`` are prefix shingles with ``cls, n, pos, label, home, asks``. The length filter and, at this one
    token, the position filter are part of the join: at their first common shingle two that link pass
    both, later ones need not.
    """
    several = rows.groupBy("token").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.min("home").alias("first"), F.max("home").alias("last"), F.max("asks").alias("any"),
    )
    open_ = rows.join(several.filter("any AND low < high AND first < last").select("token"), "token", "left_semi")
    open_ = kept(open_, "open")
    names = [c for c in rows.columns if c != "token"]
    x = open_.select("token", *[F.col(c).alias(f"x_{c}") for c in names])
    y = open_.select(F.col("token").alias("y_token"), *[F.col(c).alias(f"y_{c}") for c in names])
    rest = F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos"))
    condition = (
        (F.col("token") == F.col("y_token"))
        & (F.col("x_cls") < F.col("y_cls"))
        & (F.col("x_label") != F.col("y_label"))
        & (F.col("x_home") != F.col("y_home"))
        & (F.col("x_asks") | F.col("y_asks"))
        & _fits(F.col("x_n"), F.col("y_n"), percent)
        & _enough(rest + 1, F.col("x_n"), F.col("y_n"), percent)
    )
    return x.join(y, condition).drop("y_token")


def _shared(prefixes: DataFrame, percent: int) -> DataFrame:
    """``token, cls, n, pos, size``: the prefix shingles at which a class may link with another; ``size`` classes have it.

    Prefixes are shuffled once. Of each shingle the classes stay that have a partner by the length filter and, as far as
    this shingle alone tells, by the position filter: what one pair would fail in ``_met`` anyway is not moved again.
    Partners are looked for next to a class in the order of sizes: if one that is smaller fits, so does the next
    smaller one; one that is larger and fits has to be reached from the place of the shingle, and the next larger one is nearer.
    """
    all_, by_size = Window.partitionBy("token"), Window.partitionBy("token").orderBy("n", "cls")
    # Only shingles of two classes or more can make a pair. Copies in several tasks come more than once.
    rows = prefixes.repartition("token").withColumns({"low": F.min("cls").over(all_), "high": F.max("cls").over(all_)})
    rows = rows.filter("low < high").drop("low", "high").distinct()
    rest = F.col("n") - F.col("pos")
    rows = rows.withColumns(
        {
            "size": F.count(F.lit(1)).over(all_), "small": F.min("n").over(all_), "large": F.max("n").over(all_),
            "rest": F.min(rest).over(all_), "below": F.lag("n").over(by_size), "above": F.lead("n").over(by_size),
        }
    )
    small, large, n, below, above = (F.col(c) for c in ("small", "large", "n", "below", "above"))
    pair = _fits(small, large, percent) & _enough(F.col("rest") + 1, small, large, percent)
    smaller = F.coalesce(_fits(below, n, percent), F.lit(False))
    larger = F.coalesce(_fits(n, above, percent) & _enough(rest + 1, n, above, percent), F.lit(False))
    return rows.filter(F.when(F.col("size") == 2, pair).otherwise(smaller | larger)).select("token", "cls", "n", "pos", "size")


class _Join:
    """What both forms of the join share: classes, and prefix shingles that classes have in common."""

    def __init__(self, documents: DataFrame, key: str, size: int, percent: int):
        self._all, self._key, self._size, self._percent = bounded(documents).select(key, "text"), key, size, percent
        described = kept(_described(documents, key, size), "shingled")
        self.documents = described.filter("block IS NULL").select("id", "cls", "n", "parts")
        classes = self.documents.filter("n > 0").groupBy("cls").agg(
            F.min("id").alias("least"), F.first("n").alias("n"), F.first("parts").alias("parts")
        )
        self.classes = kept(classes, "classes")
        self.buckets = kept(_shared(_prefixes(documents, _counters(described), size, percent), percent), "buckets")

    def compared(self, pairs: DataFrame, near: int = 101) -> DataFrame:
        return _compared(self._all, self._key, self.classes, pairs, self._size, near)

    def links(self, compared: DataFrame) -> DataFrame:
        return compared.filter(_enough(F.col("overlap"), F.col("na"), F.col("nb"), self._percent))

    def possible(self, met: DataFrame, done: DataFrame | None) -> DataFrame:
        """Pairs of ``x_cls, y_cls`` that met on shingles, by the position, length and suffix filters."""
        counted = met.groupBy(F.col("x_cls").alias("a"), F.col("y_cls").alias("b")).agg(
            F.count(F.lit(1)).alias("shared"),
            *(F.max(c).alias(c) for c in ("x_n", "y_n", "x_pos", "y_pos")),
        )
        rest = F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos"))
        found = counted.filter(_enough(F.col("shared") + rest, F.col("x_n"), F.col("y_n"), self._percent))
        if done is not None:
            found = found.join(done.select("a", "b"), ["a", "b"], "left_anti")
        return _plausible(found, self.classes, self._percent)


def similar_classes(
    documents: DataFrame, key: str = "doc_id", size: int = WORDS, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """All links: ``a, b, na, nb, overlap`` between classes of equal sets, and ``id, cls, n`` of the documents.

    Each pair of classes with a common prefix shingle is looked at, also in groups of near copies.
    """
    join = _Join(documents, key, size, percent)
    rows = join.buckets.drop("size").withColumns({"label": F.col("cls"), "home": F.col("cls"), "asks": F.lit(True)})
    found = join.compared(join.possible(_met(rows, percent), None))
    return join.links(found).select("a", "b", "na", "nb", "overlap").distinct(), join.documents.select("id", "cls", "n")


def _centres(buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The buckets with the ``centre`` of each shingle: of its classes the one that shares most shingles with
    most. And how much each class shares, its ``degree``."""
    shares = kept(buckets.groupBy("cls").agg(F.sum(F.col("size") - 1).alias("degree")), "degrees")
    most = buckets.join(shares, "cls").groupBy("token").agg(F.max(F.struct("degree", "cls")).alias("most"))
    centres = most.select("token", F.col("most.cls").alias("centre"))
    return kept(buckets.join(centres, "token"), "centred"), shares


def _spokes(centred: DataFrame, percent: int) -> DataFrame:
    """``a, b``: a centre and a class with which it shares a quarter of the prefix of the smaller one, or a
    shingle of many classes: what is near its centre need not meet the many."""
    sizes = centred.filter("cls = centre").groupBy("cls").agg(F.first("n").alias("na")).withColumnRenamed("cls", "centre")
    counted = centred.filter("cls <> centre").groupBy("centre", "cls").agg(
        F.count(F.lit(1)).alias("shared"), F.max("size").alias("crowd"), F.first("n").alias("nb")
    )
    met = counted.join(sizes, "centre")
    smaller = F.least("na", "nb")
    prefix = smaller - F.ceil(F.lit(percent) * smaller / 100) + 1
    close = ((F.col("shared") * 4 >= prefix) | (F.col("crowd") >= CROWD)) & _fits(F.col("na"), F.col("nb"), NEAR)
    return kept(met.filter(close).select(F.col("centre").alias("a"), F.col("cls").alias("b"), "na", "nb"), "spokes")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    roots = labels.select(F.col("node").alias("cls"), F.col("root"))
    return rows.join(roots, "cls", "left").withColumn("label", F.coalesce("root", "cls")).drop("root")


def _belonging(compared: DataFrame, degrees: DataFrame) -> DataFrame:
    """Of each class that is near a centre the comparison with the one of them that shares most: ``a`` is that centre."""
    near = compared.filter("added IS NOT NULL").dropDuplicates(["a", "b"])
    ranked = near.join(degrees.withColumnRenamed("cls", "a"), "a")
    most = ranked.groupBy("b").agg(F.max(F.struct("degree", "a")).alias("most")).select("b", F.col("most.a").alias("a"))
    return kept(near.join(most, ["a", "b"]), "belonging")


def _homes(belonging: DataFrame, classes: DataFrame) -> DataFrame:
    """``cls, n, home, c, items``: each class with the last centre that its centres lead to, of ``c`` shingles, and
    the shingles that only one of the two has.

    A centre may belong to another one, that shares more; so the way ends. What differs from that one is
    what differs from the first and the two differ in, less what is in both.
    """
    state = belonging.select("b", F.col("a").alias("home"), F.concat("added", "lacking").alias("items"))
    state = kept(state.withColumnRenamed("b", "cls"), "homes")
    while True:
        further = state.select(F.col("cls").alias("home"), F.col("home").alias("next"), F.col("items").alias("more"))
        onward = state.join(further, "home", "left")
        if onward.filter("next IS NOT NULL").isEmpty():
            break
        differ = F.concat(F.array_except("items", "more"), F.array_except("more", "items"))
        state = onward.select(
            "cls", F.coalesce("next", "home").alias("home"), F.when(F.col("next").isNull(), F.col("items")).otherwise(differ).alias("items")
        )
        state = kept(state, "homes")
    sizes = classes.select("cls", "n")
    return state.join(sizes, "cls").join(sizes.select(F.col("cls").alias("home"), F.col("n").alias("c")), "home")


def _most_apart(sizes: Column, percent: int) -> Column:
    """How many shingles only one of two sets may have, if they link and their sizes add up to ``sizes``."""
    return F.floor(F.lit(100 - percent) * sizes / F.lit(100 + percent))


def _prefixes_at_home(near: DataFrame, partners: DataFrame, asking: bool, percent: int) -> DataFrame:
    """``home, token`` and the class: the first of its items, by which it meets any of the partners.

    Two that link differ from home in at least ``need`` items in common, half of what is left when all they
    may differ in is taken from all they have. So they share one of the first ``d - need + 1``, by any order.
    A partner that asks differs from home in more than the two sizes allow. The larger it is, the more, and
    by as much the pair may differ in more: its size cancels out. So one prefix does for partners of all sizes.
    """
    n, c, d = F.col("n"), F.col("c"), F.col("d")
    sizes = partners.groupBy("home").agg(F.min("n").alias("smallest"), F.max("n").alias("largest"))
    met = near.join(sizes, "home")
    least = F.greatest(F.col("smallest"), F.ceil(F.lit(percent) * n / 100))
    most = F.least(F.col("largest"), F.floor(F.lit(100) * n / percent))
    apart = _most_apart(n + most, percent)
    need = F.greatest(F.lit(1), F.ceil((d + F.greatest(F.lit(1), d - apart) - apart) / 2))
    if asking:
        need = F.greatest(need, F.ceil((d + _most_apart(c - n, percent) + 1) / 2))
    ready = met.withColumn("take", (d - need + 1).cast("int")).filter((least <= most) & (F.col("take") > 0))
    entries = F.posexplode(F.slice("items", F.lit(1), F.col("take"))).alias("at", "token")
    return ready.select("home", "cls", "label", "n", "d", entries)


def _links_at_home(homes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the links between classes of one home that have different labels.

    Two sets differ in as many shingles as what they differ from a third in differs. So classes of one home are
    joined by these items: few of them, the rarest of the group first, as in the join on whole sets.
    A class that links to its home has the label of the home; one that does not is asking.
    """
    near = homes.withColumn("d", F.size("items"))
    near = near.withColumn("asks", F.col("d") > _most_apart(F.col("n") + F.col("c"), percent))
    to_home = near.filter("NOT asks").select(F.col("cls").alias("a"), F.col("home").alias("b"))
    of_home = labels.select(F.col("node").alias("home"), F.col("root").alias("home_label"))
    near = _labelled(near, labels).join(of_home, "home", "left")
    near = near.withColumn("label", F.when(F.col("asks"), F.col("label")).otherwise(F.coalesce("home_label", "home")))
    near = kept(near.drop("home_label"), "near")
    groups = near.groupBy("home").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("asks").alias("any"))
    near = near.join(groups.filter("any AND low < high").select("home"), "home", "left_semi")

    items = near.select("home", "cls", F.explode("items").alias("token"))
    counts = items.groupBy("home", "token").agg(F.count(F.lit(1)).alias("holders"))
    order = F.sort_array(F.collect_list(F.struct("holders", "token")))
    ordered = items.join(counts, ["home", "token"]).groupBy("cls").agg(F.transform(order, lambda e: e["token"]).alias("items"))
    near = kept(near.drop("items").join(ordered, "cls"), "ordered")

    asking, others = near.filter("asks"), near.filter("NOT asks")
    pairs = []
    for one, two in ((asking, asking), (asking, others)):
        x = _prefixes_at_home(one, two, two is asking, percent)
        y = x if two is asking else _prefixes_at_home(two, one, True, percent)
        x = x.select("home", "token", *[F.col(v).alias(f"x_{v}") for v in ("cls", "label", "n", "d", "at")])
        y = y.select(
            F.col("home").alias("home_y"), F.col("token").alias("token_y"),
            *[F.col(v).alias(f"y_{v}") for v in ("cls", "label", "n", "d", "at")],
        )
        need = F.ceil((F.col("x_d") + F.col("y_d") - _most_apart(F.col("x_n") + F.col("y_n"), percent)) / 2)
        # Zero-based places: what is behind the first common item, and that one.
        rest = F.least(F.col("x_d") - F.col("x_at"), F.col("y_d") - F.col("y_at"))
        condition = (
            (F.col("home") == F.col("home_y"))
            & (F.col("token") == F.col("token_y"))
            & (F.col("x_label") != F.col("y_label"))
            & _fits(F.col("x_n"), F.col("y_n"), percent)
            & (rest >= need)
        )
        condition = condition & (F.col("x_cls") < F.col("y_cls")) if two is asking else condition
        pairs.append(x.join(y, condition).select("x_cls", "y_cls").distinct())
    pairs = kept(pairs[0].unionByName(pairs[1]), "pairs")
    one = near.select(F.col("cls").alias("x_cls"), F.col("n").alias("nx"), F.col("d").alias("dx"), F.col("items").alias("ix"))
    two = near.select(F.col("cls").alias("y_cls"), F.col("n").alias("ny"), F.col("d").alias("dy"), F.col("items").alias("iy"))
    apart = F.col("dx") + F.col("dy") - 2 * F.size(F.array_intersect("ix", "iy"))
    both = pairs.join(one, "x_cls").join(two, "y_cls").filter(apart <= _most_apart(F.col("nx") + F.col("ny"), percent))
    return to_home.unionByName(both.select(F.col("x_cls").alias("a"), F.col("y_cls").alias("b")))


def components(documents: DataFrame, key: str = "doc_id", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``n_shingles`` and ``component_id`` of every document: the smallest id that links lead to."""
    join = _Join(documents, key, size, percent)
    centred, degrees = _centres(join.buckets)
    dropped(join.buckets)
    compared = join.compared(_spokes(centred, percent), NEAR)
    labels = kept(connected(join.links(compared).select("a", "b")), "labels")
    homes = kept(_homes(_belonging(compared, degrees), join.classes), "homes")
    around = kept(_links_at_home(homes, labels, percent), "links")
    # Classes of different homes meet on the shingle itself: one of the two does not have the home that
    # the centre of the shingle has.
    of_class = homes.select("cls", "home")
    of_centre = homes.select(F.col("cls").alias("centre"), F.col("home").alias("main"))
    rows = _labelled(centred, labels).join(of_class, "cls", "left").join(of_centre, "centre", "left")
    home, main = F.coalesce("home", "cls"), F.coalesce("main", "centre")
    rows = rows.select("token", "cls", "n", "pos", "label", home.alias("home"), (home != main).alias("asks"))
    done = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    others = join.links(join.compared(join.possible(_met(rows, percent), done)))
    # The later links join components of the first.
    found = around.union(others.select("a", "b"))
    root_a = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    root_b = labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    linked = found.join(root_a, "a", "left").join(root_b, "b", "left")
    merged = kept(connected(linked.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))), "labels")
    classes = (
        join.classes.select("cls", "least")
        .join(labels.select(F.col("node").alias("cls"), "root"), "cls", "left")
        .withColumn("first", F.coalesce("root", "cls"))
        .drop("root")
        .join(merged.select(F.col("node").alias("first"), "root"), "first", "left")
        .select("cls", "least", F.coalesce("root", "first").alias("root"))
    )
    classes = kept(classes, "class-roots")
    dropped(join.classes, centred, degrees, compared, labels, homes, around, merged)
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = classes.join(smallest, "root").select("cls", "component_id")
    return (
        join.documents.join(by_class, "cls", "left")
        .select(
            F.col("id").alias(key),
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        )
    )


def one_of_each(documents: DataFrame, key: str = "doc_id", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The document with the smallest id of each component, and those that link with nothing; columns as they were.

    Of rows that share the id and the text, all stay: the id is what a document is known by.
    """
    found = components(documents, key, size, percent)
    stays = found.filter(F.col(key).isNull() | (F.col(key) == F.col("component_id"))).select(F.col(key).alias("__stays")).distinct()
    return documents.join(stays, documents[key].eqNullSafe(stays["__stays"]), "left_semi")
