"""Picking up what changed since the last successful run."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.functions.dates import BEGINNING
from duskwork.operators.filters import Keys, drop_matching, keep_matching
from duskwork.sources.codes import MARK_OVERLAP_DAYS, SUCCESS


def last_success(
    log: DataFrame, jobs: DataFrame, lookback: int = MARK_OVERLAP_DAYS,
    name: str = "eod_proc_name", when: str = "eod_date", status: str = "status",
) -> DataFrame:
    """For every job in ``jobs`` (column ``name``): the moment to start from.

    Last success minus the overlap, or the beginning of 1990 for a job that
    never succeeded.
    """
    ends = log.where(F.col(status) == SUCCESS).groupBy(name).agg(F.max(when).alias("__last"))
    mark = F.coalesce(
        F.col("__last") - F.make_dt_interval(F.lit(lookback)), F.lit(BEGINNING.isoformat(sep=" ")).cast("timestamp_ntz")
    )
    return jobs.select(name).distinct().join(ends, name, "left").select(name, mark.alias("mark"))


def high_water_mark(
    log: DataFrame, job: str, lookback: int = MARK_OVERLAP_DAYS,
    name: str = "eod_proc_name", when: str = "eod_date", status: str = "status",
) -> datetime:
    """Moment from which ``job`` has to look at changes (one value to the driver).

    Known as a plain value before the plan is built, it can be pushed into the
    scan of the changed table.
    """
    last = log.where((F.col(name) == job) & (F.col(status) == SUCCESS)).agg(F.max(when)).first()[0]
    return BEGINNING if last is None else last - timedelta(days=lookback)


def incremental_new(
    source: DataFrame, changed: Column, existing: DataFrame, on: Keys,
    settle: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Changed rows whose key is not present yet.

    The overlap of the mark does no harm: rows taken in before are present.
    ``settle`` may write out the changed rows and mark them for broadcast; only
    present keys among them are then looked at, not all of ``existing``.
    """
    rows = settle(source.where(changed))
    return drop_matching(rows, keep_matching(existing, rows, on), on)
