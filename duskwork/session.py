"""A Spark session with the settings the operators are planned for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


# Runtime Bloom filters: a large table that is joined with far fewer keys is filtered before its
# shuffle. Built for keys of up to a gigabyte, and as many bits as 40 million of them need.
RUNTIME_FILTERS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "40000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(1 << 28),
}


def local_session(
    name: str = "duskwork", cores: int | str | None = None, partitions: int = 8, **settings: str
) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own.

    Adaptive execution (on by default) chooses joins by measured size, splits
    skewed partitions and merges small ones.
    """
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
    )
    for key, value in {**RUNTIME_FILTERS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
