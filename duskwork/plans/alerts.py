"""Alerts on values outside a band."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.operators.filters import keep_matching, outside_band
from duskwork.operators.joins import derived_key_join
from duskwork.operators.ranking import latest_per_key
from duskwork.plans.job import JobResult, Tables

# --- fixed values ---
FUND_LOG_NAME = "AlertByFund"
ACCOUNT_LOG_NAME = "AlertByPlanAccount"
# The latest prices of each fund and values of each account, maintained by ``operators.latest``.
LATEST_PRICE, LATEST_VALUE = "latest_price", "latest_account_value"


def band_alert(
    alerts: DataFrame, values: DataFrame, alert_key: str, value_key: str, *, when: str = "effdate",
    value: str = "ubidpr", floor: str = "floor", ceiling: str = "ceiling", maintained: bool = False,
) -> DataFrame:
    """Alerts whose latest value is at or beyond a bound, with that value.

    Several values at the latest moment are all looked at. Only series with an
    alert are ranked; ``maintained`` values (``operators.latest``) are the latest
    ones already.
    """
    series = values.select(F.col(value_key).cast("string").alias("__series"), when, value)
    wanted = keep_matching(series, alerts.select(F.col(alert_key).cast("string").alias("__series")), "__series")
    latest = wanted if maintained else latest_per_key(wanted, "__series", when)
    latest = latest.select("__series", value)
    pairs = derived_key_join(alerts, latest, F.col(alert_key).cast("string"), F.col("__series"))
    return pairs.where(outside_band(value, floor, ceiling)).select(*alerts.columns, value)


def alert_by_fund(tables: Tables, as_of: datetime) -> JobResult:
    """Fund alerts against the latest bid price; rows in ``out['alerts']``.

    A maintained table ``latest_price`` takes the place of the price history.
    """
    alerts = tables["fund_alert"].select("fund_alert_id", "user_id", "floor", "ceiling")
    maintained = LATEST_PRICE in tables
    prices = tables[LATEST_PRICE if maintained else "ifsdmvprcpf"]
    rows = band_alert(alerts, prices, "fund_alert_id", "vrtfnd", maintained=maintained)
    return JobResult({}, (FUND_LOG_NAME,), None, {"alerts": rows})


def alert_by_account(tables: Tables, as_of: datetime) -> JobResult:
    """Account alerts against ``account_value`` (acct_id, effdate, ubidpr),
    which the caller supplies; rows in ``out['alerts']``.

    A maintained table ``latest_account_value`` takes its place.
    """
    alerts = tables["acct_alert"].select("acct_id", "user_id", "floor", "ceiling")
    maintained = LATEST_VALUE in tables
    values = tables[LATEST_VALUE if maintained else "account_value"]
    rows = band_alert(alerts, values, "acct_id", "acct_id", maintained=maintained)
    return JobResult({}, (ACCOUNT_LOG_NAME,), None, {"alerts": rows})
