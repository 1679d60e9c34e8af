"""Tables and files as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlane.schemas import SEEDS, TABLES

POSITION = ["file_path", "block_start", "row_in_task"]

# What stands for no value in a file, quoted or not.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str = "id",
    partitions: int = 1,
    bounds: tuple[int, int] | None = None,
    **options: str,
) -> DataFrame:
    """A database table; with ``bounds`` of the key, read by many tasks at once."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if bounds is not None:
        low, high = bounds
        reader = reader.options(
            partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions)
        )
    return reader.load()


def read_csv(spark: SparkSession, path: str, schema: str, position: bool = False) -> DataFrame:
    """A CSV file with a header row, its columns found by name.

    The file may hold more columns than ``schema`` names, in any order. ``NULL_TOKENS`` are null,
    which a column is before it is read as its type; anything else of a wrong type is an error. ``position`` adds
    columns whose order is the order of rows in the file: the block's place in the file and
    a number that grows inside the block.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    value = {f.name: F.when(~F.col(f.name).isin(NULL_TOKENS), F.col(f.name)) for f in T.StructType.fromDDL(schema).fields}
    columns = [value[f.name].cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema).fields]
    if position:
        columns += [
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("row_in_task"),
        ]
    return raw.select(*columns)


def seed_table(spark: SparkSession, name: str) -> DataFrame:
    """The seed rows of a lookup table with ids from 1 on."""
    names = [c.name for c in TABLES[name].columns if c.name not in ("id", "created_at")]
    return literal_rows(spark, ["id", *names], [(i, *row) for i, row in enumerate(SEEDS[name], 1)])


def literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small table written in the query, so that Spark knows its exact size."""

    def text(value) -> str:
        if isinstance(value, int):
            return f"CAST({value} AS BIGINT)"
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def seed_if_empty(seed: DataFrame, target: DataFrame) -> DataFrame:
    """The seed rows when the target has none, else nothing."""
    one = target.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return seed.filter(one.scalar() == 0)
