"""Source divergence audit: how far the words of each source are from the other sources of its language.

Counting is a sort of pointers. A task holds some megabytes of documents as Arrow buffers, ordered by
language and source, and one pointer per word to the place where it begins; no word is copied. The
pointers go through a multikey quicksort, eight bytes of the words at a time: a slice is split in
three around a pivot, and the middle part goes on behind those eight bytes. Slices below ``SLICE``
pointers are sorted at once. The sort is stable, so in a run of equal words the pointers of one source
and of one document stand together: the lengths of these runs are the source's count and its number
of documents. Spark adds up the runs of all tasks by language and term.

Each kept term is a row of counts by source. Pairs of sources are compared in shards of ``TERMS``
terms, each with its sources' rows, so a language of any size is dealt evenly; the sums of the shards
are added up, half of the pairs only, as the measure is symmetric.

Defined results: null text, language and source are empty strings; every row of documents is a
document of its own, repeated ids or not; a language without kept terms has pairs of value 0 and no
terms; ties are ordered by item; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlane.llm.shared import bounded, kept
from cartlane.llm.texts import Keys, byte_table, chunks, flat, lowered, strings, words

#: Documents of its language from which on a term is kept, and ranks of the report on terms.
LEAST_DOCS, TOP = 10, 10

#: Bytes of text whose pointers are sorted together, and pointers that are sorted without a pivot.
TEXT_BYTES, SLICE = 16 << 20, 1 << 15

#: Kept terms in a shard, and numbers that a task compares at once.
TERMS, CELLS = 1 << 13, 1 << 20

# Letters in lower case and all that is not ASCII.
_INSIDE = byte_table(lambda b: 0x61 <= b <= 0x7A or b >= 0x80)


def sort_pointers(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the words, stable, and whether each in that order differs from the one before it."""
    keys_at = Keys(data)
    order = np.empty(len(begins), np.int64)
    fresh = np.zeros(len(begins), bool)
    slices = [(np.arange(len(begins)), 0, 0)]
    while slices:
        pointers, depth, at = slices.pop()
        keys = keys_at(begins[pointers] + depth, ends[pointers])
        if len(pointers) <= SLICE:
            order[at : at + len(pointers)], fresh[at : at + len(pointers)] = _settled(keys_at, begins, ends, pointers, keys, depth)
            continue
        some = np.sort(keys[:: max(1, len(keys) // 99)])
        pivot = some[len(some) // 2]
        low, high = keys < pivot, keys > pivot
        middle = pointers[~(low | high)]
        below = int(low.sum())
        slices += [(pointers[high], depth, at + below + len(middle)), (pointers[low], depth, at)]
        if pivot & np.uint64(0xFF):
            slices.append((middle, depth + 8, at + below))
        else:  # the words have ended: a run of equal ones
            order[at + below : at + below + len(middle)] = middle
            fresh[at + below] = True
    return order, fresh


def _settled(keys_at: Keys, begins, ends, pointers, keys, depth) -> tuple[np.ndarray, np.ndarray]:
    """A small slice in order: by the next eight bytes within runs that are equal so far."""
    ranked = np.argsort(keys, kind="stable")
    pointers, keys = pointers[ranked], keys[ranked]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    opened = np.flatnonzero(keys & np.uint64(0xFF))
    while len(opened):
        depth += 8
        run = np.cumsum(fresh)[opened]
        some = pointers[opened]
        keys = keys_at(begins[some] + depth, ends[some])
        ranked = np.lexsort((keys, run))
        pointers[opened], keys = some[ranked], keys[ranked]
        # ``run`` is ascending, so it is not changed by the sort.
        fresh[opened[1:]] = (keys[1:] != keys[:-1]) | (run[1:] != run[:-1])
        opened = opened[(keys & np.uint64(0xFF)) != 0]
    return pointers, fresh


def count_runs(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row per language, source and term of these documents: occurrences ``n`` and documents ``docs``."""
    group = pc.dictionary_encode(pc.binary_join_element_wise(batch["lang"], batch["source"], "\0"))
    codes = group.indices.to_numpy(zero_copy_only=False)
    by_group = np.argsort(codes, kind="stable")
    batch, codes = batch.take(pa.array(by_group)), codes[by_group]
    data, offsets = flat(batch["text"])
    data = lowered(data)
    begins, ends, before = words(data, offsets, _INSIDE)
    order, fresh = sort_pointers(data, begins, ends)
    document = np.repeat(np.arange(len(batch)), np.diff(before))[order]
    source = codes[document]
    new_document, new_source = fresh.copy(), fresh.copy()
    new_document[1:] |= document[1:] != document[:-1]
    new_source[1:] |= source[1:] != source[:-1]
    at = np.flatnonzero(new_source)
    first = order[at]
    docs = np.add.reduceat(new_document, at, dtype=np.int64) if len(at) else np.zeros(0, np.int64)
    rows = pa.array(document[at])
    return pa.RecordBatch.from_arrays(
        [
            batch["lang"].take(rows),
            batch["source"].take(rows),
            strings(data, begins[first], ends[first]),
            pa.array(np.diff(at, append=len(order)), pa.int64()),
            pa.array(docs, pa.int64()),
        ],
        ["lang", "source", "term", "n", "docs"],
    )


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of up to ``TEXT_BYTES`` of text or one row, joined from smaller ones."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in chunks(batches, limit=TEXT_BYTES):
        n = pc.sum(pc.binary_length(batch["text"])).as_py() or 0
        if waiting and size + n > TEXT_BYTES:
            yield pa.concat_batches(waiting)
            waiting, size = [], 0
        waiting.append(batch)
        size += n
    if waiting:
        yield pa.concat_batches(waiting)


def kept_terms(documents: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, term, source, n``, with ``total`` of the language, and ``first`` on one row of each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            yield count_runs(batch)

    runs = bounded(_texts(documents)).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    # The runs are few rows per task already; one shuffle serves the sums by source and by term.
    sums = runs.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    counted = sums.withColumns(
        {
            "total": F.sum("n").over(term),
            "__docs": F.sum("docs").over(term),
            "first": F.row_number().over(term.orderBy("source")) == 1,
        }
    )
    return counted.filter(F.col("__docs") >= least_docs).select("lang", "term", "source", "n", "total", "first")


def _share(n: Column, size: Column) -> Column:
    """1 and the whole billionths of ``n`` in ``size``, exact beyond 64 bits in between."""
    scaled = F.lit(1_000_000_000).cast("decimal(10,0)") * n.cast("decimal(20,0)")
    return F.call_function("div", scaled, size.cast("decimal(20,0)")) + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _sums_of_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each pair of sources the sum over the terms of one shard."""
    groups = pdf[pdf["term"].isna()].sort_values("source")
    cells = pdf[pdf["term"].notna()]
    names, none = groups["source"].to_numpy(object), groups["p"].to_numpy(np.int64)
    column = pd.Index(names).get_indexer(cells["source"])
    row, terms = pd.factorize(cells["term"])
    ranked = np.argsort(row, kind="stable")
    row, column, p = row[ranked], column[ranked], cells["p"].to_numpy(np.int64)[ranked]
    block = max(1, CELLS // max(1, len(names)))
    sums = np.zeros((len(names), len(names)), np.int64)
    for begin in range(0, len(terms), block):
        a, b = np.searchsorted(row, (begin, begin + block))
        table = np.repeat(none[None, :], min(block, len(terms) - begin), axis=0)
        table[row[a:b] - begin, column[a:b]] = p[a:b]
        for i in range(len(names) - 1):
            mine, other = table[:, i : i + 1], table[:, i + 1 :]
            sums[i, i + 1 :] += ((mine - other) ** 2 // (mine + other)).sum(axis=0)
    i, j = np.triu_indices(len(names), 1)
    return pd.DataFrame({"lang": pdf["lang"].iloc[0], "a": names[i], "b": names[j], "value": sums[i, j]})


def source_divergence(documents: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources (``pair``) and telling terms (``term``).

    A share is taken of the counts of kept terms with two more each, in billionths and one more. The
    value of a term is the square of the difference of two shares by their sum, rounded down. Pairs have
    the sum over all kept terms; terms, with those above the language's own share, the best ``top``.
    """
    cells = kept(kept_terms(documents, least_docs), "terms")
    languages = cells.groupBy("lang").agg(F.sum("n").alias("__words"), F.count_if("first").alias("__terms"))
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("__own"))
    zero = F.lit(0).cast("long")
    groups = _texts(documents).select("lang", "source").distinct().join(languages, "lang", "left").join(own, ["lang", "source"], "left")
    groups = groups.select(
        "lang",
        "source",
        *(F.coalesce(c, zero).alias(c) for c in ("__words", "__terms", "__own")),
        F.greatest(F.lit(1).cast("long"), F.ceil(F.col("__terms") / TERMS)).alias("__shards"),
    )
    groups = kept(groups, "sources")
    size = F.col("__own") + 2 * F.col("__terms")
    shares = cells.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        _share(F.col("n") + 2, size).alias("p"),
        _share(F.col("total") + 2, F.col("__words") + 2 * F.col("__terms")).alias("q"),
        F.pmod(F.xxhash64("term"), F.col("__shards")).alias("shard"),
    )

    shard = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__shards") - 1)).alias("shard")
    none = F.when(F.col("__terms") > 0, _share(F.lit(2), F.when(size > 0, size))).otherwise(1).alias("p")
    rows = shares.select("lang", "source", "term", "p", "shard").unionByName(
        groups.select("lang", "source", F.lit(None).cast("string").alias("term"), none, shard)
    )
    sums = rows.groupBy("lang", "shard").applyInPandas(_sums_of_pairs, "lang string, a string, b string, value long")
    pairs = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in ("ab", "ba"))))
    pairs = pairs.select("lang", both.alias("__pair"), "value").select("lang", "__pair.source", "__pair.item", "value")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    telling = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    telling = telling.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(telling.withColumn("part", F.lit("term")).select(columns))
    )
