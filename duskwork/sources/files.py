"""Files of a table on whatever store Spark is set up for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    handle = jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(conf), handle


def exists(spark: SparkSession, path: str) -> bool:
    store, handle = _path(spark, path)
    return store.exists(handle)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    store, handle = _path(spark, path)
    store.delete(handle, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    store, handle = _path(spark, path)
    if not store.exists(handle):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(handle) if s.isDirectory())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of all data files below ``path``; names with a leading dot or underscore don't count."""
    store, handle = _path(spark, path)
    found, waiting = [], [handle] if store.exists(handle) else []
    while waiting:
        for status in store.listStatus(waiting.pop()):
            if status.getPath().getName()[0] in "._":
                continue
            if status.isDirectory():
                waiting.append(status.getPath())
            else:
                found.append(status.getPath().toString())
    return sorted(found)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")
