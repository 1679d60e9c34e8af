"""A snapshot taken in chunks while the log goes on, handed over without loss.

A chunk of a table is read between two log positions, ``low`` before and ``high`` after. Its rows
are of some time in between. A row whose key has a record in that window may be older or newer than
the record, so the record counts and the row goes. Any other row was the same all through the window:
it stands for all records up to ``low`` and is older than any after ``high``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlane.plans.stabbing import stab

SNAPSHOT = "r"


def with_snapshot(log: DataFrame, rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """The decoded changes of a table with the rows of its snapshot among them.

    ``rows`` has ``id``, ``chunk`` and columns of the table; ``chunks`` has ``chunk, low, high`` and
    ``read_at``, the time it was read. Columns that only one side has are null on the other.
    """
    spans = chunks.select("chunk", (F.col("low") + 1).alias("__low"), (F.col("high") + 1).alias("__high"))
    inside = stab(log.select("id", "lsn"), spans, "lsn", "__low", "__high")
    # One row per key and chunk, however many records a key has.
    beaten = inside.select("id", "chunk").distinct()
    snapshot = rows.join(chunks, "chunk").join(beaten, ["id", "chunk"], "left_anti")
    changes = snapshot.withColumns(
        {
            "op": F.lit(SNAPSHOT),
            "lsn": F.col("high"),
            "deleted": F.lit(False),
            "changed_at": F.col("read_at"),
        }
    ).drop("chunk", "low", "high", "read_at")
    return log.unionByName(changes, allowMissingColumns=True)
