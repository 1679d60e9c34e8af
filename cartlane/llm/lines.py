"""Line dedup: a line that stands in many documents stays in one of them.

Lines are known by a 128-bit hash of their key: stripped of white space at both ends, in lower
case. The hashes of lines found in enough documents are dealt to shards. A shard is one row: a
minimal perfect hash, and arrays of fingerprints, counts and largest document ids in the order
of its slots. Documents send their line hashes to the shards, where they probe the arrays;
no line text moves. A shard that many lines ask for (a line of a third of all documents) is
copied, so that no task answers more than ``PROBES`` lines.

A document is known by its id and a hash of its text, so that what it loses is never more than its own
lines, also where many rows share an id or have none.

Defined results: null and empty texts are one empty line; rows with the same id count as
documents of their own, and all keep what the id keeps; a null id is smaller than any other;
short keys and empty lines always stay; columns other than the text are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlane.llm.perfect import PerfectHash
from cartlane.llm.shared import bounded, kept
from cartlane.llm.texts import chunks

#: Code points of a key that counts, and documents from which on its lines go.
LEAST_CHARS, LEAST_DOCS = 20, 3

#: Line hashes in a shard, and lines that one task answers; both on average.
SHARD_KEYS, PROBES = 1 << 18, 1 << 20

# The white space around a key.
_SPACE = " \t\n\x0b\x0c\r"
_LOWER = {c: c + 32 for c in range(65, 91)}


def key_hash(line: str) -> tuple[int, int] | None:
    """The hash of a line's key as two signed 64-bit numbers; none if the key is too short."""
    if len(line) < LEAST_CHARS:
        return None
    key = line.strip(_SPACE)
    if len(key) < LEAST_CHARS:
        return None
    digest = xxhash.xxh3_128_digest(key.translate(_LOWER) if not key.islower() else key)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def line_hashes(documents: DataFrame, key: str) -> DataFrame:
    """One row per document and distinct key that is long enough: ``id, body, high, low``; ``body`` is the text's hash."""
    rows = bounded(documents).select(F.col(key).cast("long").alias("id"), F.xxhash64("text").alias("body"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            ids, bodies, high, low = [], [], [], []
            for at, body, text in zip(*(chunk.column(i).to_pylist() for i in range(3))):
                for hashed in {h for line in text.split("\n") if (h := key_hash(line))}:
                    ids.append(at)
                    bodies.append(body)
                    high.append(hashed[0])
                    low.append(hashed[1])
            columns = [pa.array(c, pa.int64()) for c in (ids, bodies, high, low)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "body", "high", "low"])

    return rows.mapInArrow(run, "id long, body long, high long, low long")


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = pdf["high"].to_numpy(np.int64).view(np.uint64)
    # Two lines may share the first half of the hash: the array of such keys has them all.
    _, first = np.unique(keys, return_index=True)
    rest = np.setdiff1d(np.arange(len(keys)), first)
    found = PerfectHash.build(keys[first])
    order = np.empty(len(first), np.int64)
    order[found.slots(keys[first])] = first
    order = np.concatenate([order, rest])
    largest = pdf["largest"]
    row = {
        "shard": pdf["shard"].iloc[0],
        "sizes": list(found.sizes),
        "bits": found.bits,
        "slots": len(first),
        "keys": keys[rest].tobytes(),
        "prints": pdf["low"].to_numpy(np.int64)[order].tobytes(),
        "counts": np.minimum(pdf["n"].to_numpy(np.int64), 2**32 - 1).astype(np.uint32)[order].tobytes(),
        "largest": largest.fillna(0).to_numpy(np.int64)[order].tobytes(),
        "none": largest.isna().to_numpy()[order].tobytes(),
    }
    return pd.DataFrame([row])


_SHARD = (
    "shard int, sizes array<long>, bits binary, slots long, keys binary, prints binary, counts binary,"
    " largest binary, none binary"
)


def line_index(hashes: DataFrame, least_docs: int = LEAST_DOCS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """The shards of the lines found in at least ``least_docs`` documents, one row each."""
    repeated = kept(
        hashes.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("largest")).filter(F.col("n") >= least_docs),
        "repeated-lines",
    )
    shards = max(1, -(-repeated.count() // shard_keys))
    shard = F.pmod(F.xxhash64("high"), F.lit(shards)).cast("int")
    return repeated.withColumn("shard", shard).groupBy("shard").applyInPandas(_build, _SHARD)


def _answer(probes: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    columns = [c for c in probes.columns if c not in ("shard", "copy")]
    if not len(probes) or not len(shard):
        return probes[columns].iloc[:0]
    row = shard.iloc[0]
    found = PerfectHash(tuple(row["sizes"]), row["bits"])
    prints = np.frombuffer(row["prints"], np.int64)
    largest, none = np.frombuffer(row["largest"], np.int64), np.frombuffer(row["none"], bool)
    keys, low = probes["high"].to_numpy(np.int64).view(np.uint64), probes["low"].to_numpy(np.int64)
    slots = found.slots(keys)
    slots[(slots >= 0) & (prints[slots] != low)] = -1
    for at, key in enumerate(np.frombuffer(row["keys"], np.uint64)):
        at += row["slots"]
        slots[(keys == key) & (prints[at] == low)] = at
    ids = probes["id"]
    keeps = np.where(ids.isna(), none[slots], ~none[slots] & (largest[slots] == ids.fillna(0).to_numpy(np.int64)))
    return probes[columns][(slots >= 0) & ~keeps]


def lines_to_drop(hashes: DataFrame, index: DataFrame, probes: int = PROBES) -> DataFrame:
    """The rows of ``hashes``, with whatever else they say of their document, whose lines the documents lose."""
    shards = index.count()
    if not shards:
        return hashes.limit(0)
    shard = F.pmod(F.xxhash64("high"), F.lit(shards)).cast("int")
    asked = hashes.withColumn("shard", shard)
    copies = asked.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(probes)).cast("int").alias("copies"))
    dealt = asked.join(copies, "shard").withColumn("copy", F.pmod(F.xxhash64(*hashes.columns, F.lit(1)), F.col("copies")).cast("int"))
    copied = index.join(copies, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return (
        dealt.select("shard", "copy", *hashes.columns)
        .groupBy("shard", "copy")
        .cogroup(copied.drop("copies").groupBy("shard", "copy"))
        .applyInPandas(_answer, hashes.schema)
    )


def _thinned(documents: DataFrame, key: str) -> DataFrame:
    """``__rest`` (the other columns), ``text`` less the repeated lines, ``__lines`` before and ``__dropped``.

    The documents are read twice and shuffled once, to meet the lines they lose.
    """
    hashes = kept(line_hashes(documents, key), "line-hashes")
    index = kept(line_index(hashes), "line-index")
    # A document's distinct lines at most: bounded by its own text, however many rows have that id and text.
    lost = lines_to_drop(hashes, index).groupBy("id", "body").agg(F.collect_set(F.struct("high", "low")).alias("__lost"))
    rest = F.struct(*(f"`{c}`" for c in documents.columns if c != "text")).alias("__rest")
    inner = documents.select(F.col(key).cast("long").alias("__id"), F.xxhash64("text").alias("__body"), rest, "text")
    same = inner["__id"].eqNullSafe(lost["id"]) & (inner["__body"] == lost["body"])
    rows = inner.join(lost, same, "left").select("__rest", "text", "__lost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            lines, dropped, left = [], [], []
            for text, lost in zip(chunk.column(1).to_pylist(), chunk.column(2).to_pylist()):
                cut = text.split("\n")
                if lost:
                    gone = {(x["high"], x["low"]) for x in lost}
                    stay = [line for line in cut if key_hash(line) not in gone]
                else:
                    stay = cut
                lines.append(len(cut))
                dropped.append(len(cut) - len(stay))
                left.append("\n".join(stay))
            arrays = [chunk.column(0), pa.array(left, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["__rest", "text", "__lines", "__dropped"])

    kind = rows.schema["__rest"].dataType.simpleString()
    return rows.mapInArrow(run, f"__rest {kind}, text string, __lines long, __dropped long")


def drop_repeated_lines(documents: DataFrame, key: str = "doc_id", length: str | None = None) -> DataFrame:
    """The documents with their text less the repeated lines; ``length`` names a column with its code points."""
    columns = []
    for c in documents.columns:
        column = F.col("text") if c == "text" else F.col(f"__rest.`{c}`")
        if c == length:
            column = F.when(F.col("__dropped") > 0, F.length("text")).otherwise(column).cast(documents.schema[c].dataType)
        columns.append(column.alias(c))
    return _thinned(documents, key).select(*columns)


def line_digests(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """``n_lines``, ``n_dropped`` and the SHA-256 of the lines that stay, one row per document."""
    return _thinned(documents.select(key, "text"), key).select(
        F.col(f"__rest.`{key}`").alias(key),
        F.col("__lines").alias("n_lines"),
        F.col("__dropped").alias("n_dropped"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"),
    )
