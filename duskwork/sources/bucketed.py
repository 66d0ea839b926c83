"""Tables laid out by key bucket, so that a change writes back only the buckets it touches.

Each bucket is a partition folder. A change finds the buckets of its keys, reads these
alone (the bucket column prunes the scan), and replaces them by a dynamic partition
overwrite; all other files stay as they are.

A change goes through two steps under a run name: its new buckets are first staged
completely beside the table, then put in place. A rerun under the same name finds what
was finished: staged buckets are not computed again and a run that was put in place
does nothing. So a driver that is lost at any point can be started again. Frames
that were read before a change must be read again after it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwork.operators.filters import drop_matching, keys_of
from duskwork.operators.keys import bucket_of
from duskwork.operators.mutate import Sets, delete_keys, merge_upsert, update_from, update_keys
from duskwork.sources import files

BUCKET = "key_bucket"


@dataclass(frozen=True)
class Layout:
    """Where a table lies, its key columns, its columns as DDL, and 16**digits buckets.

    A bucket should hold some hundred megabytes: with fewer buckets a change writes too
    many rows back, with more of them it opens too many files.
    """

    folder: str
    key: tuple[str, ...]
    schema: str
    digits: int = 2

    def bucket(self) -> Column:
        # The letter keeps a partition value like 1e5 from being read as a number.
        return F.concat(F.lit("b"), bucket_of(self.key, self.digits))

    def staged(self, run: str) -> str:
        return f"{self.folder}/_runs/{run}"


@dataclass(frozen=True)
class Change:
    """The table after a change, and the buckets that were written."""

    table: DataFrame
    buckets: list[str]


def with_bucket(df: DataFrame, layout: Layout) -> DataFrame:
    return df.withColumn(BUCKET, layout.bucket())


def write_buckets(df: DataFrame, folder: str, **options: str) -> None:
    """Write rows by bucket; adaptive execution joins small buckets in a task and splits large ones."""
    df.hint("rebalance", F.col(BUCKET)).write.options(**options).mode("overwrite").partitionBy(BUCKET).parquet(folder)


def lay_out(df: DataFrame, layout: Layout) -> DataFrame:
    """Write a table by bucket for the first time and read it back."""
    if files.data_files(df.sparkSession, layout.folder):
        raise FileExistsError(layout.folder)
    write_buckets(with_bucket(df, layout), layout.folder)
    return read_laid_out(df.sparkSession, layout)


def read_laid_out(spark: SparkSession, layout: Layout, folder: str | None = None) -> DataFrame:
    """The table with its bucket column, which jobs may carry along."""
    return spark.read.schema(f"{layout.schema}, {BUCKET} string").parquet(folder or layout.folder)


def touched_buckets(keys: DataFrame, layout: Layout) -> list[str]:
    """Buckets in which one of ``keys`` may lie: at most as many as the layout has."""
    return sorted(r[0] for r in keys_of(keys, list(layout.key)).select(layout.bucket().alias(BUCKET)).distinct().collect())


def in_buckets(df: DataFrame, buckets: list[str]) -> DataFrame:
    """Rows of the given buckets, and rows that have none yet; prunes the scan of a laid-out table."""
    return df.where(F.col(BUCKET).isin(buckets) | F.col(BUCKET).isNull())


def staged_buckets(spark: SparkSession, layout: Layout, run: str) -> list[str]:
    """The buckets that a run has staged."""
    return sorted(r[0] for r in spark.read.schema(f"{BUCKET} string").parquet(f"{layout.staged(run)}/buckets").collect())


def filled_buckets(spark: SparkSession, folder: str) -> list[str]:
    """Buckets that have a folder, which are those with rows."""
    return [name.removeprefix(f"{BUCKET}=") for name in files.folders(spark, folder) if name.startswith(f"{BUCKET}=")]


def stage(
    spark: SparkSession, layout: Layout, keys: DataFrame, rows_in: Callable[[list[str]], DataFrame], run: str
) -> None:
    """Write the new rows of the buckets of ``keys`` beside the table, once per run.

    ``rows_in`` makes them from the list of buckets; a row of another bucket is an error.
    """
    staged = layout.staged(run)
    if files.finished(spark, f"{staged}/buckets"):
        return
    buckets = touched_buckets(keys, layout)
    write_buckets(with_bucket(rows_in(buckets), layout), f"{staged}/rows")
    strange = set(filled_buckets(spark, f"{staged}/rows")) - set(buckets)
    if strange:
        raise ValueError(f"{layout.folder}: changed rows outside the touched buckets, in {sorted(strange)}")
    listed = spark.createDataFrame([(b,) for b in buckets], f"{BUCKET} string")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{staged}/buckets")


def put_in_place(spark: SparkSession, layout: Layout, run: str) -> Change:
    """Overwrite the staged buckets in the table; a bucket without rows left is removed."""
    staged, buckets = layout.staged(run), staged_buckets(spark, layout, run)
    if not files.finished(spark, f"{staged}/done"):
        filled = set(filled_buckets(spark, f"{staged}/rows"))
        if filled:
            write_buckets(read_laid_out(spark, layout, f"{staged}/rows"), layout.folder, partitionOverwriteMode="dynamic")
        for bucket in buckets:
            if bucket not in filled:
                files.delete(spark, f"{layout.folder}/{BUCKET}={bucket}")
        spark.range(0).write.mode("overwrite").parquet(f"{staged}/done")
        files.delete(spark, f"{staged}/rows")
    return Change(read_laid_out(spark, layout), buckets)


def rewrite(
    spark: SparkSession, layout: Layout, keys: DataFrame, change: Callable[[DataFrame], DataFrame], run: str
) -> Change:
    """Replace the buckets of ``keys`` by what ``change`` makes of their rows."""
    stage(spark, layout, keys, lambda buckets: change(in_buckets(read_laid_out(spark, layout), buckets).drop(BUCKET)), run)
    return put_in_place(spark, layout, run)


def stage_new(spark: SparkSession, layout: Layout, rows: DataFrame, run: str) -> None:
    """Write rows with new keys beside the table, once per run."""
    if not files.finished(spark, f"{layout.staged(run)}/rows"):
        write_buckets(with_bucket(rows, layout), f"{layout.staged(run)}/rows")


def put_new(spark: SparkSession, layout: Layout, run: str) -> Change:
    """Add the staged rows to the table; old files stay.

    If an earlier try was begun, rows whose key is in the table already are left out; only
    buckets of the new keys are looked at for that.
    """
    staged = layout.staged(run)
    if not files.finished(spark, f"{staged}/done"):
        rows = read_laid_out(spark, layout, f"{staged}/rows")
        if files.exists(spark, f"{staged}/begun"):
            held = in_buckets(read_laid_out(spark, layout), filled_buckets(spark, f"{staged}/rows"))
            rows = drop_matching(rows, held, list(layout.key))
        spark.range(0).write.mode("overwrite").parquet(f"{staged}/begun")
        rows.hint("rebalance", F.col(BUCKET)).write.mode("append").partitionBy(BUCKET).parquet(layout.folder)
        spark.range(0).write.mode("overwrite").parquet(f"{staged}/done")
    return Change(read_laid_out(spark, layout), filled_buckets(spark, f"{staged}/rows"))


def append(spark: SparkSession, layout: Layout, rows: DataFrame, run: str) -> Change:
    """Add rows with new keys; a rerun adds nothing twice."""
    stage_new(spark, layout, rows, run)
    return put_new(spark, layout, run)


def update_keys_in(spark: SparkSession, layout: Layout, keys: DataFrame, sets: Sets, run: str) -> Change:
    """Set columns where the row's key occurs in ``keys``; the key itself may not be set."""
    if set(sets) & set(layout.key):
        raise ValueError(f"the key {layout.key} cannot be changed in place")
    return rewrite(spark, layout, keys, lambda old: update_keys(old, keys, layout.key, sets), run)


def delete_keys_in(spark: SparkSession, layout: Layout, keys: DataFrame, run: str) -> Change:
    return rewrite(spark, layout, keys, lambda old: delete_keys(old, keys, layout.key), run)


def update_from_in(
    spark: SparkSession, layout: Layout, source: DataFrame, copies: Mapping[str, str], run: str, sets: Sets | None = None
) -> Change:
    """Overwrite columns with those of the matching source row; a source with two rows for a key is an error."""
    if (set(copies) | set(sets or {})) & set(layout.key):
        raise ValueError(f"the key {layout.key} cannot be changed in place")
    return rewrite(spark, layout, source, lambda old: update_from(old, source, list(layout.key), copies, sets), run)


def merge_in(spark: SparkSession, layout: Layout, source: DataFrame, update: Sets, insert: Sets, run: str) -> Change:
    """Update rows that have a source row and insert source rows that have none, bucket by bucket."""

    def merged(old: DataFrame) -> DataFrame:
        return merge_upsert(old, source, list(layout.key), update, insert)

    return rewrite(spark, layout, source, merged, run)
