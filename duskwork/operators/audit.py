"""Audit trail rows and run log rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwork.functions.dates import moment
from duskwork.functions.text import joined, piped
from duskwork.operators.filters import drop_matching
from duskwork.operators.keys import with_row_ids
from duskwork.operators.mutate import append_rows
from duskwork.sources.codes import AUDIT_TYPE, FAILURE, PROCESS_USER, SUCCESS

AUDIT_COLUMNS = ("action", "table_nm", "dt_created", "created_by", "audit_type", "data1", "data2")
LOG_COLUMNS = ("eod_proc_name", "eod_date", "status", "dt_created", "created_by", "remarks")
LOG_SCHEMA = (
    "eod_proc_name string, eod_date timestamp_ntz, status string, "
    "dt_created timestamp_ntz, created_by string, remarks string"
)


def _text(slot: Column | Sequence[Column] | None) -> Column:
    if slot is None:
        return F.lit(None).cast("string")
    return piped(*slot) if isinstance(slot, (list, tuple)) else joined(slot)


def audit_rows(
    changes: DataFrame,
    action: str,
    table: str | Column,
    before: Column | Sequence[Column] | None,
    after: Column | Sequence[Column] | None,
    as_of: datetime,
) -> DataFrame:
    """One audit row per changed row, without its id.

    ``before`` and ``after`` are a list of columns, joined by pipes with empty
    slots for NULLs, or one text column, or None for an empty side.
    """
    return changes.select(
        F.lit(action).alias("action"),
        (F.lit(table) if isinstance(table, str) else table).alias("table_nm"),
        moment(as_of).alias("dt_created"),
        F.lit(PROCESS_USER).alias("created_by"),
        F.lit(AUDIT_TYPE).alias("audit_type"),
        _text(before).alias("data1"),
        _text(after).alias("data2"),
    )


def append_audit(trail: DataFrame, rows: DataFrame) -> DataFrame:
    """The audit trail with new rows, each under an id of its own."""
    return append_rows(trail, with_row_ids(rows, "audit_id", trail))


def run_log(outcomes: DataFrame, name: str, status: str, as_of: datetime, error: str | None = None) -> DataFrame:
    """Run log rows for a frame of outcomes (columns: job name, status, error text)."""
    return outcomes.select(
        F.col(name).alias("eod_proc_name"),
        moment(as_of).alias("eod_date"),
        F.col(status).alias("status"),
        moment(as_of).alias("dt_created"),
        F.lit(PROCESS_USER).alias("created_by"),
        (F.col(error) if error else F.lit(None)).cast("string").alias("remarks"),
    )


def run_log_row(spark: SparkSession, job: str, as_of: datetime, error: str | None = None) -> DataFrame:
    """The run log row of one job: success, or failure with its error text."""
    status = SUCCESS if error is None else FAILURE
    return spark.createDataFrame([(job, as_of, status, as_of, PROCESS_USER, error)], LOG_SCHEMA)


def enqueue_requests(queue: DataFrame, candidates: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Add requests whose key is not queued yet: (new queue, added rows)."""
    added = drop_matching(candidates, queue, key)
    return append_rows(queue, added), added
