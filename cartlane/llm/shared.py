"""Tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cartlane.plans.scratch import remove, written


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: read again at will, with no lineage to redo."""
    return written(df, name)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of ``kept`` that nothing reads any more."""
    for table in tables:
        for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
            remove(table.sparkSession, folder)


#: Parts in which the driver fetches a few large rows: each part is a job of its own.
FETCHES = 8


def fetched(rows: DataFrame) -> Iterator[Row]:
    """A bounded number of rows, one part after the other; they are made by all tasks before."""
    return rows.repartition(FETCHES).toLocalIterator()


#: Rows of texts that Spark hands to a Python worker at once.
BATCH_ROWS = 1000

_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded(documents: DataFrame) -> DataFrame:
    """The documents, in a session that hands over no more than ``BATCH_ROWS`` texts at once.

    Spark's own 10,000 rows are for short ones: a batch stands in memory several times, inside the JVM
    and outside. A lower setting stays.
    """
    conf = documents.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(_BATCH_SETTING, BATCH_ROWS)
    return documents


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


#: Places of a bit filter: its size is fixed, whatever goes in.
FILTER_BITS = 1 << 23


def filter_place(column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def bit_filter(values: DataFrame, column: str) -> bytes:
    """The places of all values as bits: 1 MB at most, however many values there are.

    A value that is not in may find its bit set, so an exact join has to follow; the filter saves
    that join from moving what it would drop.
    """
    place = filter_place(column)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    word = values.select((place / 64).cast("long").alias("word"), bit.alias("bit"))
    # FILTER_BITS / 64 rows at most.
    found = word.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return out.tobytes()


def in_filter(bits: bytes, places: np.ndarray) -> np.ndarray:
    words = np.frombuffer(bits, np.uint64)[places // 64]
    return (words >> (places % 64).astype(np.uint64)) & np.uint64(1) == 1
