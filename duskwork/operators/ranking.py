"""Newest-N, latest-per-key and first-per-key.

A single key may own a large part of the table, so none of these sorts a whole
group in one task: latest values come from a map-side combined maximum, and the
newest-N cut-off is found from salted sub-groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwork.operators.filters import Keys, join_side, key_list

SALTS = 64


def newest_cutoffs(df: DataFrame, key: str, ts: str, counts: Sequence[int], salts: int = SALTS) -> DataFrame:
    """For each key, its n-th newest timestamp for every n in ``counts``.

    Columns: the key and ``newest_<n>``, NULL where the key has fewer than n
    timed rows. Each salted sub-group passes on at most max(counts) timestamps. Salts go by
    input partition as well as by time, so many rows with one time are spread too.
    """
    deepest = max(counts)
    timed = df.where(F.col(ts).isNotNull()).select(
        key, ts, F.pmod(F.xxhash64(ts, F.spark_partition_id()), F.lit(salts)).alias("__salt")
    )
    newest_first = F.col(ts).desc()
    part = Window.partitionBy(key, "__salt").orderBy(newest_first)
    whole = Window.partitionBy(key).orderBy(newest_first)
    ranked = (
        timed.withColumn("__n", F.row_number().over(part)).where(F.col("__n") <= deepest)
        .select(key, ts)
        .withColumn("__n", F.row_number().over(whole)).where(F.col("__n") <= deepest)
    )
    return ranked.groupBy(key).agg(
        *[F.max(F.when(F.col("__n") == n, F.col(ts))).alias(f"newest_{n}") for n in counts]
    )


def beyond_newest(df: DataFrame, key: str, ts: str, n: int) -> DataFrame:
    """Rows for which at least ``n`` rows of the same key are strictly newer.

    Equal timestamps do not count against each other, and a row without a
    timestamp has nothing newer than it.
    """
    if n <= 0:
        return df
    cutoff = f"newest_{n}"
    cutoffs = join_side(newest_cutoffs(df, key, ts, [n]).dropna(subset=[cutoff]), key)
    return df.join(cutoffs, key).where(F.col(ts) < F.col(cutoff)).select(*df.columns)


def latest_per_key(df: DataFrame, key: Keys, ts: str) -> DataFrame:
    """Rows carrying the greatest ``ts`` of their key, ties included.

    Ranks are limited within each input partition before the shuffle, so of a
    key only its latest rows per partition travel, and the table is read once.
    """
    names = key_list(key)
    newest = Window.partitionBy(*names).orderBy(F.col(ts).desc())
    timed = df.dropna(subset=[*names, ts]).withColumn("__rank", F.rank().over(newest))
    return timed.where(F.col("__rank") == 1).select(*df.columns)


def first_per_key(df: DataFrame, key: Keys, order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``.

    The row limit is applied within each input partition before the shuffle.
    """
    w = Window.partitionBy(*key_list(key)).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")


def lookup_per_key(df: DataFrame, key: Keys, value: str) -> DataFrame:
    """Greatest ``value`` of each key (combined map-side)."""
    return df.groupBy(*key_list(key)).agg(F.max(value).alias(value))
