"""Row filters: age, class-dependent limits, existence, bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.functions.dates import days_before, moment
from duskwork.operators.durable import ranged, settled

Keys = str | Sequence[str]


def key_list(on: Keys) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def is_aged(ts: Column | str, days: float | str, as_of: datetime) -> Column:
    """At least ``days`` days old, counted to the second.

    Written as "not after a fixed moment" so that the filter reaches the scan.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts <= moment(days_before(as_of, days))


def aged(df: DataFrame, ts: str, days: float | str, as_of: datetime) -> DataFrame:
    return df.where(is_aged(ts, days, as_of))


def class_limit(kind: Column | str, special: Mapping[str, Column], default: Column) -> Column:
    """The limit that belongs to the class in ``kind``."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    out = default
    for value, limit in special.items():
        out = F.when(kind == value, limit).otherwise(out)
    return out


def oldest_allowed(
    kind: Column | str, special_days: Mapping[str, float | str], default_days: float | str, as_of: datetime
) -> Column:
    """Moment at or before which a row of class ``kind`` counts as too old."""
    return class_limit(
        kind,
        {value: moment(days_before(as_of, days)) for value, days in special_days.items()},
        moment(days_before(as_of, default_days)),
    )


def outside_band(value: Column | str, floor: Column | str, ceiling: Column | str) -> Column:
    """At or below the floor, or at or above the ceiling."""
    value, floor, ceiling = (F.col(c) if isinstance(c, str) else c for c in (value, floor, ceiling))
    return (value <= floor) | (value >= ceiling)


def keys_of(df: DataFrame, on: Keys) -> DataFrame:
    """Distinct non-NULL key rows."""
    names = key_list(on)
    return df.select(*names).dropna(how="any", subset=names).distinct()


def join_side(unique: DataFrame, on: Keys) -> DataFrame:
    """A de-duplicated frame made ready to be one side of a large join.

    Adaptive execution splits a skewed sort-merge join only when an exchange
    stands directly below each sort; an aggregate in between switches that
    off. Moving the (already reduced) rows once more keeps it on, so a key that
    holds a large share of the other side is spread over many tasks.
    """
    return unique.repartition(F.xxhash64(*key_list(on)))


def with_match(df: DataFrame, keys: DataFrame, on: Keys, flag: str) -> DataFrame:
    """``df`` plus a boolean column telling whether its key occurs in ``keys``.

    One join serves the rows that match, those that do not, and an update of
    either. A NULL key matches nothing. The keys are made distinct before they
    are shuffled to the join, so no row of ``df`` is multiplied.
    """
    names = key_list(on)
    marked = join_side(keys_of(keys, names), names).withColumn(flag, F.lit(True))
    return df.join(marked, names, "left").select(
        *df.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag)
    )


def matching_side(keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """``keys`` as the right side of a semi or anti join, which repeated keys don't harm.

    Settled keys are taken as they lie: their size is known, and Spark can build a
    runtime filter from many of them. Others are made distinct where they are read.
    """
    if settled(keys):
        return ranged(keys.select(*names).dropna(how="any", subset=list(names)), keys)
    return join_side(keys_of(keys, names), names)


def keep_matching(df: DataFrame, keys: DataFrame, on: Keys) -> DataFrame:
    """EXISTS: rows whose key occurs in ``keys``."""
    names = key_list(on)
    return df.join(matching_side(keys, names), names, "left_semi").select(*df.columns)


def drop_matching(df: DataFrame, keys: DataFrame, on: Keys) -> DataFrame:
    """NOT EXISTS: rows whose key does not occur in ``keys``; NULL keys stay."""
    names = key_list(on)
    return df.join(matching_side(keys, names), names, "left_anti").select(*df.columns)
