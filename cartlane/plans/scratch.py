"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or the one the session's context was given.

    A local session with neither gets a folder of its own, which goes when the process ends. On
    a cluster the folder has to be set, since a machine's own disk is gone with the machine. The
    session is only read.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is not None:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="cartlane-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return _OWN[0]


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/cartlane-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses, in the application's part of the shared folder."""
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from a scratch table: short lineage, known size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder in any store that Spark writes to, if it is there."""
    store, place = _store(spark, path)
    store.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _store(spark, path)
    return store.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if there is no such folder."""
    store, place = _store(spark, path)
    return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def drop_scratch(spark: SparkSession) -> None:
    """Deletes all scratch tables of this application. A job calls it when its results are written."""
    remove(spark, _application_folder(spark))
