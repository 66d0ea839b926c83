"""The latest rows per key as a maintained table, merged with each night's new rows.

Ranking the full history every night reads all of it. The state holds the latest rows
of each key, ties included; merged with the latest of a night it gives what ranking the
history would, also for rows that arrive late. Laid out by key, only buckets of keys with new rows are
read and written, and a night that was merged once is not merged again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duskwork.operators.filters import Keys
from duskwork.operators.ranking import latest_per_key
from duskwork.sources.bucketed import Change, Layout, rewrite


def merge_latest(state: DataFrame, rows: DataFrame, key: Keys, ts: str) -> DataFrame:
    """The state after ``rows``, each of them new."""
    return latest_per_key(state.unionByName(latest_per_key(rows.select(*state.columns), key, ts)), key, ts)


def maintain_latest(spark: SparkSession, layout: Layout, rows: DataFrame, ts: str, night: str) -> Change:
    """Merge the rows of a night into a laid-out state; running a night again changes nothing."""
    return rewrite(spark, layout, rows, lambda state: merge_latest(state, rows, list(layout.key), ts), night)
