"""Tables laid out by the period of a change date, so that a mark prunes the files to read.

A change date is a yyyymmdd key or a moment. Each month is a partition folder, and rows
are sorted by the date inside, so row groups are skipped by their statistics as well. A
filter "changed since" then needs the month next to the date: ``changed_since`` adds
it for tables that have it and is the plain comparison for others.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from duskwork.functions.dates import key_of, moment

PERIOD = "change_period"
# Rows without a date: they have changed at no known time.
NO_PERIOD = 0


def period_of(df: DataFrame, column: str) -> Column:
    """Month of a change date as yyyymm."""
    kind = df.schema[column].dataType
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        month = F.year(column) * 100 + F.month(column)
    else:
        month = F.floor(F.col(column) / 100)
    return F.coalesce(month.cast("int"), F.lit(NO_PERIOD))


def write_clustered(df: DataFrame, folder: str, column: str, mode: str = "errorifexists") -> None:
    """Write or (``mode="append"``) add rows by month, sorted by date inside a file.

    Adaptive execution joins small months in a task and splits large ones.
    """
    dealt = df.withColumn(PERIOD, period_of(df, column)).hint("rebalance", F.col(PERIOD))
    dealt.sortWithinPartitions(PERIOD, column).write.mode(mode).partitionBy(PERIOD).parquet(folder)


def read_clustered(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, {PERIOD} int").parquet(folder)


def changed_since(df: DataFrame, column: str, since: int | datetime) -> Column:
    """Condition "changed after ``since``" (a date key or a moment), which also prunes months of a clustered table."""
    after = F.col(column) > (F.lit(since) if isinstance(since, int) else moment(since))
    if PERIOD not in df.columns:
        return after
    return after & (F.col(PERIOD) >= (since if isinstance(since, int) else key_of(since)) // 100)
