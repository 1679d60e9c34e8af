"""Repeats taken out of a stream, without a horizon.

The state of a key and a block of log positions is the set of positions seen, as intervals without
gaps: late records close gaps, and nothing is forgotten. A block has 65,536 positions, so a key
with many records has many small states, and they are dealt to many tasks.

Each call of the processor and each state costs far more than a record, and most keys have a few
records in a block. So keys that are whole numbers share a state, 1,024 in a row: the sets of a block lie side
by side, with a gap between two keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cartlane.sources.sinks import write_batch

#: Bits of a log position within its block.
BLOCK_BITS = 16

#: Bits of a key within the range of keys that share a state.
KEY_BITS = 10

# Without an underscore in front: Spark hands rows to the processor as named tuples.
_KEYS, _BLOCK, _PLACE = "range_of_keys", "block_of_log", "place_in_both"

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: the store that a stateful processor needs.
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def known(begins: np.ndarray, ends: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which places lie in one of the intervals, which are in order and apart."""
    at = np.searchsorted(begins, places, "right") - 1
    return (at >= 0) & (places <= np.append(ends, -1)[at])


def joined(begins: np.ndarray, ends: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals with new places among them, none next to another."""
    begins, ends = np.concatenate([begins, places]), np.concatenate([ends, places])
    order = np.argsort(begins)
    begins, ends = begins[order], ends[order]
    apart = begins[1:] > ends[:-1] + 1
    return begins[np.append(True, apart)[: len(begins)]], ends[np.append(apart, True)[: len(ends)]]


class Seen(StatefulProcessor):
    """Passes on the first record of each place, with these columns."""

    def __init__(self, columns: list[str]):
        self._columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "begins array<bigint>, ends array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        begins, ends = (np.array(v, np.int64) for v in (self._seen.get() if self._seen.exists() else ([], [])))
        for frame in rows:
            frame = frame.drop_duplicates(_PLACE)
            new = frame[~known(begins, ends, frame[_PLACE].to_numpy(np.int64))]
            begins, ends = joined(begins, ends, new[_PLACE].to_numpy(np.int64))
            yield new[self._columns]
        self._seen.update((begins.tolist(), ends.tolist()))

    def close(self) -> None:
        pass


def first_records(changes: DataFrame) -> DataFrame:
    """The stream of changes, each ``id`` and ``lsn`` once: records that share them are one record."""
    keys, place = F.col("id"), F.col("lsn").bitwiseAND((1 << BLOCK_BITS) - 1).cast("long")
    if isinstance(changes.schema["id"].dataType, T.IntegralType):
        keys = F.shiftright("id", KEY_BITS)
        # One bit more than a block has: the last place of a key is not next to the first one of another.
        place += F.shiftleft(F.col("id").bitwiseAND((1 << KEY_BITS) - 1).cast("long"), BLOCK_BITS + 1)
    block = F.shiftright("lsn", BLOCK_BITS)
    grouped = changes.select("*", keys.alias(_KEYS), block.alias(_BLOCK), place.alias(_PLACE)).groupBy(_KEYS, _BLOCK)
    return grouped.transformWithStateInPandas(Seen(changes.columns), changes.schema, "Append", "None")


def write_once(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs the stream over what is there and adds each record to the log once.

    The query has a session of its own with the store that the state needs; the caller's is as before.
    """
    conf = changes.sparkSession.conf
    before = conf.get(_PROVIDER)
    conf.set(_PROVIDER, _ROCKSDB)
    try:
        return (
            first_records(changes)
            .writeStream.option("checkpointLocation", checkpoint)
            .outputMode("append")
            .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.set(_PROVIDER, before)
