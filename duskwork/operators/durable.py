"""Cutting lineage where one frame feeds several outputs."""

from __future__ import annotations

import re
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Frames of reuse_keys, and whether they are few.
_settled: weakref.WeakKeyDictionary[DataFrame, bool] = weakref.WeakKeyDictionary()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="duskwork-checkpoint-")
    context.setCheckpointDir(folder)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for written frames, on the storage that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def reuse(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it on the shared storage.

    For key sets and change frames that several output tables are derived
    from: they are read back from shared files, survive lost executors, and give
    every output the same rows and the same assigned keys. As Parquet, so that only the
    columns a join needs are read, and the planner knows their size.
    """
    folder = scratch_folder(df.sparkSession, "frame")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row as Spark estimates them from the types."""
    return df.sparkSession._jvm.org.apache.spark.sql.types.StructType.fromDDL(df._jdf.schema().toDDL()).defaultSize()


def reuse_keys(df: DataFrame, most: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``reuse`` for the keys of changed rows, marked for broadcast if few.

    The rows are counted once they are written. Up to ``most`` of them, and ``most_bytes`` at the
    width of their types, joins with a table of any size leave that table where it is;
    beyond, the mark is left out and the join shuffles. Only joined columns are sent.
    """
    kept = reuse(df)
    rows = kept.count()
    few = rows <= most and rows * row_bytes(kept) <= most_bytes
    kept = F.broadcast(kept) if few else kept
    _settled[kept] = few
    return kept


def settled(df: DataFrame) -> bool:
    """Whether a frame came from :func:`reuse_keys`, so that reading it costs no more than its rows."""
    return df in _settled


def ranged(keys: DataFrame, settled_frame: DataFrame) -> DataFrame:
    """Keys taken from a settled frame, between the least and greatest first key if they are many.

    Says nothing new about them, but a semi join hands the range on to the scan of the
    large table, and a filtered side is what lets Spark build its runtime Bloom filter
    from it (``session.RUNTIME_FILTERS``). Rows with a NULL key are left out: they match nothing.
    """
    first = keys.schema.fields[0]
    if _settled[settled_frame] or not isinstance(first.dataType, (NumericType, StringType, DateType, TimestampType, TimestampNTZType)):
        return keys
    column = F.col(f"`{first.name}`")
    low, high = keys.agg(F.min(column), F.max(column)).first()
    if low is None:
        return keys.limit(0)
    return keys.where((column >= F.lit(low).cast(first.dataType)) & (column <= F.lit(high).cast(first.dataType)))
