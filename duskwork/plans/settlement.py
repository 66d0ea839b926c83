"""Settling ordered transactions that have no open feedback."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.functions.text import trimmed
from duskwork.operators.audit import audit_rows
from duskwork.operators.durable import reuse_keys
from duskwork.operators.filters import drop_matching, keep_matching
from duskwork.operators.mutate import update_keys
from duskwork.plans.job import JobResult, Tables
from duskwork.sources.codes import ORDERED, SUCCEEDED, YES

# --- fixed values ---
LOG_NAME = "TransactionApproval"
ACTION = "TrxApp"


def ready_to_settle(transactions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Ordered transactions that have no feedback row other than 'Y'.

    A transaction without any feedback row is ready as well.
    """
    ordered = reuse_keys(transactions.where(F.col("trx_status") == ORDERED))
    blocking = feedback.where(F.col("fdbkind") != YES).select(trimmed("ztranref").alias("reference_id"))
    # of all feedback, only that on ordered transactions takes part
    return drop_matching(ordered, keep_matching(blocking, ordered, "reference_id"), "reference_id")


def settle_transactions(tables: Tables, as_of: datetime) -> JobResult:
    transactions = tables["trx_ut"].select("trx_ut_id", "trx_status", "reference_id")
    ready = reuse_keys(ready_to_settle(transactions, tables["ifsdmutrnpf"]))
    new = update_keys(tables["trx_ut"], ready, "trx_ut_id", {"trx_status": F.lit(SUCCEEDED)})
    audit = audit_rows(
        ready, ACTION, "TRX_UT",
        [F.col("trx_ut_id"), F.col("trx_status")], [F.col("trx_ut_id"), F.lit(SUCCEEDED)], as_of,
    )
    return JobResult({"trx_ut": new}, (LOG_NAME,), audit, touched={"trx_ut": ready})
