"""What the training-data operators share: tables, Arrow mapping, written frames."""

from __future__ import annotations

import bisect
import ctypes
import itertools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from duskwork.operators.durable import ensure_checkpoint_dir

KINDS = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
}
# Rows handled at once inside an Arrow batch: bounds Python objects, whatever the texts' length.
SLICE_ROWS = 256
# Bytes of an Arrow batch on its way to a worker, where the session has Spark's own 64 MB: both sides hold some of them.
BATCH_SETTING, SPARKS_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 4 << 20

_written: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    fields = [field.strip().split(" ", 1) for field in ddl.split(",")]
    return pa.schema([pa.field(name, KINDS[kind.strip()]) for name, kind in fields])


def map_slices(df: DataFrame, function: Callable, ddl: str) -> DataFrame:
    """``mapInArrow`` where ``function`` gets slices of rows and yields column lists.

    ``function(slices)`` is a generator over :class:`pyarrow.RecordBatch` slices of
    at most ``SLICE_ROWS`` rows of one partition, in order, so it can keep state
    and flush at the end; each yielded value is a list of columns in the order of ``ddl``.
    """
    schema = arrow_schema(ddl)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(slices(batches)):
            arrays = [
                column if isinstance(column, pa.Array) else pa.array(column, field.type)
                for column, field in zip(columns, schema)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        give_back()

    return df.mapInArrow(run, ddl)


def give_back() -> None:
    """Return freed memory to the system: a worker stays between tasks, next to the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Lower the size of Arrow batches for this session, unless it was set to something else."""
    if spark.conf.get(BATCH_SETTING, str(SPARKS_BATCH)).rstrip("b") == str(SPARKS_BATCH):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


class Intervals:
    """Intervals by start, with the greatest end up to each: asks about all of them take a bisection."""

    def __init__(self, spans: list[tuple[int, int]]):
        ordered = sorted(spans)
        self.starts = [start for start, _ in ordered]
        self.ends = list(itertools.accumulate((end for _, end in ordered), max))

    def reach(self, start: int) -> int:
        """Greatest end of the intervals that begin at or before ``start``, -1 without any."""
        place = bisect.bisect_right(self.starts, start)
        return self.ends[place - 1] if place else -1

    def contain(self, start: int, end: int) -> bool:
        """Whether one of them holds the whole stretch."""
        return self.reach(start) >= end

    def meet(self, start: int, end: int) -> bool:
        """Whether one of them shares a place with the stretch; ends are exclusive."""
        return self.reach(end - 1) > start


def texts_of(part: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice; null counts as empty."""
    return [text or "" for text in part.column(column).to_pylist()]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage: readers don't recompute it and a lost executor loses nothing.
    The folder is the one of ``spark.checkpoint.dir``; ``release`` deletes what a
    session has written there once no returned frame needs it.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    _written.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession) -> None:
    """Delete the frames that ``written`` made in this session."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in _written.pop(spark.sparkContext.applicationId, []):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
