"""Moving old transactions and their approvals to the history tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.functions.text import joined
from duskwork.operators.audit import audit_rows
from duskwork.operators.durable import reuse_keys
from duskwork.operators.filters import is_aged, with_match
from duskwork.operators.mutate import delete_where, is_true, rows_for, same_shape
from duskwork.plans.job import JobResult, Tables, union_audit
from duskwork.sources.bucketed import BUCKET
from duskwork.sources.codes import TRANSACTION_TYPE
from duskwork.sources.params import number_param

# --- fixed values ---
LOG_NAME = "HkpTrnHist"
DAYS = "TRX_HISTORY_DURATION_MONTH"  # holds days, in spite of its name
RENAMED = {"fee_structure_type": "fee_stucture_type"}  # archive column: source column


def split_by_parent(children: DataFrame, parents: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(children of the given parents, all other children)."""
    marked = with_match(children, parents, on, "__moves")
    return marked.where("__moves").drop("__moves"), marked.where("NOT __moves").drop("__moves")


def _audit(rows: DataFrame, table: str, key: str, as_of: datetime) -> DataFrame:
    label = lambda name: joined(f"{name} ", F.col(key))
    return audit_rows(rows, LOG_NAME, table, label(table), label(f"{table}_HIST"), as_of)


def all_mapped(source: DataFrame, mapped: Iterable[str], what: str) -> None:
    """Raise if a source column has no place in the archive: its values would be lost with the row."""
    lost = sorted(set(source.columns) - set(mapped))
    if lost:
        raise ValueError(f"{what}: no archive column for {lost}")


def archive_transactions(tables: Tables, as_of: datetime) -> JobResult:
    """Aged transactions with their details, and aged transaction approvals with
    their histories, leave the live tables for the history tables."""
    days = number_param(tables["r_sysparam"], DAYS)
    trx, approvals = tables["trx_ut"], tables["pending_approval"]
    old_trx: Column = is_aged("dt_created", days, as_of)
    old_approval: Column = (F.col("pending_type") == TRANSACTION_TYPE) & is_aged("dt_submitted", days, as_of)

    archive = tables["trx_ut_hist"]
    mapping = {c: RENAMED.get(c, c) for c in archive.columns if RENAMED.get(c, c) in trx.columns}
    # A bucket column belongs to the layout of the live table and stays behind.
    moved_trx, moved_approvals = (df.drop(BUCKET) for df in (trx.where(is_true(old_trx)), approvals.where(is_true(old_approval))))
    trx_keys = reuse_keys(moved_trx.select("trx_ut_id").distinct())
    approval_keys = reuse_keys(moved_approvals.select("pending_approval_id").distinct())
    details, details_left = split_by_parent(tables["trx_ut_detail"], trx_keys, "trx_ut_id")
    histories, histories_left = split_by_parent(
        tables["pending_approval_history"], approval_keys, "pending_approval_id"
    )
    left = {
        "trx_ut": delete_where(trx, old_trx),
        "trx_ut_detail": details_left,
        "pending_approval": delete_where(approvals, old_approval),
        "pending_approval_history": histories_left,
    }
    details, histories = details.drop(BUCKET), histories.drop(BUCKET)
    kept_details = [c for c in tables["trx_ut_detail_hist"].columns if c in details.columns]
    all_mapped(moved_trx, mapping.values(), "trx_ut")
    all_mapped(details, kept_details, "trx_ut_detail")
    same_shape(tables["pending_approval_hist"], moved_approvals)
    same_shape(tables["pending_approval_history_hist"], histories)
    archived = {
        "trx_ut_hist": rows_for(archive, moved_trx, mapping),
        "trx_ut_detail_hist": details.select(*kept_details),
        "pending_approval_hist": moved_approvals,
        "pending_approval_history_hist": histories,
    }
    audit = union_audit(
        _audit(details, "TRX_UT_DETAIL", "trx_ut_detail_id", as_of),
        _audit(moved_trx, "TRX_UT", "trx_ut_id", as_of),
        _audit(histories, "PENDING_APPROVAL_HISTORY", "pending_approval_id", as_of),
        _audit(moved_approvals, "PENDING_APPROVAL", "pending_approval_id", as_of),
    )
    keys = {
        "trx_ut": trx_keys, "trx_ut_detail": trx_keys,
        "pending_approval": approval_keys, "pending_approval_history": approval_keys,
    }
    return JobResult.of(tables, (LOG_NAME,), left, archived, audit, touched=keys)
