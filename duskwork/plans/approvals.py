"""Expiring approvals nobody acted on."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from duskwork.functions.dates import moment, stamp_text
from duskwork.operators.audit import audit_rows
from duskwork.operators.durable import reuse_keys
from duskwork.operators.filters import is_aged, keep_matching, with_match
from duskwork.operators.mutate import cascade, is_true, update_keys
from duskwork.plans.job import JobResult, Tables, union_audit
from duskwork.sources.codes import EXPIRED, PENDING, TRANSACTION_TYPE
from duskwork.sources.params import number_param

# --- fixed values ---
LOG_NAME = "DelExpTrnReqWOApp"
ACTION = "EOD4.1"
DAYS = "PENDINGAPPROVAL_DAYS"


def _cells(status: Column, updated: Column) -> list[Column]:
    return [
        F.col("pending_approval_id"), F.col("pending_type"), status, F.col("submitted_by"),
        stamp_text(F.col("dt_submitted")), F.col("updated_by"), updated, F.col("ref_pending_approval_id"),
        F.col("next_approver_id1"), F.col("next_approver_id2"),
    ]


def expire_approvals(tables: Tables, as_of: datetime) -> JobResult:
    """Old pending approvals: with a transaction they go, children first;
    others that are not transaction approvals become expired."""
    days = number_param(tables["r_sysparam"], DAYS)
    approvals = tables["pending_approval"]
    stale = approvals.where(is_aged("dt_submitted", days, as_of) & (F.col("pending_status") == PENDING))
    stale = reuse_keys(stale)
    # of all transactions, only those of stale approvals take part
    theirs = keep_matching(tables["trx_ut"].select("pending_approval_id"), stale, "pending_approval_id")
    marked = with_match(stale, theirs, "pending_approval_id", "has_trx")
    touched = reuse_keys(marked.where(F.col("has_trx") | is_true(F.col("pending_type") != TRANSACTION_TYPE)))
    deleted, expired = touched.where("has_trx"), touched.where(~F.col("has_trx"))

    new, gone = cascade(
        tables, "pending_approval", deleted, "pending_approval_id",
        [
            ("trx_ut", "pending_approval", "pending_approval_id", "pending_approval_id"),
            ("trx_ut_detail", "trx_ut", "trx_ut_id", "trx_ut_id"),
            ("pending_approval_history", "pending_approval", "pending_approval_id", "pending_approval_id"),
        ],
        settle=reuse_keys,
    )
    new["pending_approval"] = update_keys(
        new["pending_approval"], expired, "pending_approval_id", {"pending_status": F.lit(EXPIRED)}
    )
    before = _cells(F.col("pending_status"), stamp_text(F.col("dt_updated")))
    after = _cells(F.lit(EXPIRED), stamp_text(moment(as_of)))
    audit = union_audit(
        audit_rows(deleted, ACTION, "PENDING_APPROVAL", before, None, as_of),
        audit_rows(expired, ACTION, "PENDING_APPROVAL", before, after, as_of),
    )
    return JobResult(new, (LOG_NAME,), audit, touched={**gone, "pending_approval": touched})
