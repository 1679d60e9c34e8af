"""The feed as a stream or as a batch of JSON lines in a column ``value``.

Every stream has a bound on what one trigger takes in, since one key may hold much of it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_FILES = 1000
MAX_RECORDS = 5_000_000


def feed_files(spark: SparkSession, path: str) -> DataFrame:
    """All change records in a folder of JSON lines."""
    return spark.read.text(path)


def feed_file_stream(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    """Change records from files as they appear in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def topic_options(servers: str, prefix: str, schema: str = "public", max_records: int = MAX_RECORDS) -> dict[str, str]:
    """Options for the topics ``prefix.schema.<table>``, from the first record on."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribePattern": re.escape(f"{prefix}.{schema}.") + ".*",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(max_records),
    }


def feed_topic_stream(spark: SparkSession, servers: str, prefix: str, **options) -> DataFrame:
    """Change records from the broker. Needs Spark's Kafka package on the class path."""
    topics = spark.readStream.format("kafka").options(**topic_options(servers, prefix, **options)).load()
    return topics.select(F.col("value").cast("string").alias("value"))
