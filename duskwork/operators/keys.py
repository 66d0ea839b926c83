"""New identifiers for appended rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3


def highest(df: DataFrame, key: str) -> Column:
    """Greatest key in use, 0 for an empty table, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias(key)).scalar()


def bucket_of(order: Sequence[str], digits: int = BUCKET_DIGITS) -> Column:
    """Hash bucket of a row, as ``digits`` hexadecimal characters."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in order])
    return F.substring(F.md5(text.cast("binary")), 1, digits)


def assign_ordinals(df: DataFrame, order: Sequence[str], column: str, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Number the rows 1, 2, 3, ... without bringing them together.

    ``order`` must identify a row. Rows are dealt into hash buckets and numbered
    by bucket, then by ``order``: bucket sizes give each bucket its first
    number, and each bucket counts on its own. There are at most 16**digits
    bucket sizes, which bounds both the running total and the broadcast. The
    numbers depend on the rows alone, so computing them again (a retried task, a
    second output) gives the same ones. ``df`` is read twice: hand in a written
    or checkpointed frame when it is costly.
    """
    dealt = df.withColumn("__bucket", bucket_of(order, digits))
    sizes = dealt.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "__bucket", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before")
    )
    within = Window.partitionBy("__bucket").orderBy(*order)
    numbered = dealt.withColumn("__n", F.row_number().over(within)).join(F.broadcast(starts), "__bucket")
    return numbered.select(*df.columns, (F.col("__before") + F.col("__n")).alias(column))


def assign_keys(
    df: DataFrame, order: Sequence[str], key: str, existing: DataFrame | Column, existing_key: str | None = None
) -> DataFrame:
    """Give each row a key above every key of ``existing``, or above a last key."""
    last = existing if isinstance(existing, Column) else highest(existing, existing_key or key)
    numbered = assign_ordinals(df, order, key)
    return numbered.withColumn(key, last + F.col(key))


def with_row_ids(df: DataFrame, key: str, existing: DataFrame | Column) -> DataFrame:
    """Unique ids above those of ``existing`` (or a last key), for rows nothing else refers to.

    No shuffle: ids are unique but leave gaps, and are final once written.
    """
    last = existing if isinstance(existing, Column) else highest(existing, key)
    return df.withColumn(key, last + F.lit(1) + F.monotonically_increasing_id())
