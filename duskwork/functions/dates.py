"""Pinned "as of" time, day arithmetic and yyyymmdd keys.

Nothing here reads the clock: each job gets one ``as_of`` value, so a rerun with
the same inputs gives the same tables. All timestamps are without time zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
BEGINNING = datetime(1990, 1, 1)


def moment(when: datetime) -> Column:
    """A timestamp literal without time zone."""
    return F.expr(f"TIMESTAMP_NTZ'{when.isoformat(sep=' ')}'")


def days_before(as_of: datetime, days: float | int | str) -> datetime:
    """``as_of`` minus a (possibly fractional) number of days."""
    return as_of - timedelta(days=float(days))


def key_of(when: datetime) -> int:
    """yyyymmdd number of a Python datetime."""
    return int(when.strftime("%Y%m%d"))


def date_key(c: Column) -> Column:
    """yyyymmdd number of a timestamp column."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def stamp_text(c: Column) -> Column:
    """Timestamp as text for audit rows."""
    return F.date_format(c, STAMP_FORMAT)


def last_run_stamp(when: datetime) -> str:
    """Year, day, month: the fixed layout of the last-run parameter."""
    return when.strftime("%Y%d%m")
