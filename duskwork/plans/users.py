"""Dormant users and password reset requests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.functions.dates import last_run_stamp, moment
from duskwork.functions.text import code
from duskwork.operators.audit import audit_rows, enqueue_requests
from duskwork.operators.durable import reuse_keys
from duskwork.operators.filters import is_aged, join_side, keep_matching, oldest_allowed
from duskwork.operators.mutate import update_keys
from duskwork.operators.ranking import first_per_key
from duskwork.plans.job import JobResult, Tables
from duskwork.sources.codes import DORMANT, INTERNAL_USER, NO, PROCESS_USER, ROLE_SYSTEM, YES
from duskwork.sources.params import number_param, param, set_param

# --- fixed values ---
DORMANT_LOG_NAME = "DormantUserID"
DORMANT_ACTION = "DormantUID"
RESET_LOG_NAME = "GenPwdForFrontEnd"
RESET_ACTION = "ResetPW"
LAST_RUN = "PASSWORD_RESET_DATE_LAST_RUN"
ADDRESS = ("cltaddr01", "cltaddr02", "cltaddr03", "cltaddr04", "cltaddr05")


def dormant(
    users: DataFrame, kinds: DataFrame, role_holders: DataFrame, as_of: datetime, *,
    special_days: float, other_days: float, user: str = "user_id", kind: str = "user_type",
    last: str = "dt_last_login", special: str = INTERNAL_USER,
) -> DataFrame:
    """Users whose last login is too long ago for their kind and who hold one of
    the roles listed in ``role_holders``.

    A user of several kinds is judged by the shortest period.
    """
    bounds = kinds.groupBy(user).agg(
        F.max(oldest_allowed(kind, {special: special_days}, other_days, as_of)).alias("__oldest")
    ).dropna(subset=[user])
    stale = users.where(is_aged(last, min(special_days, other_days), as_of))
    stale = stale.join(join_side(bounds, user), user).where(F.col(last) <= F.col("__oldest")).select(*users.columns)
    return keep_matching(stale, role_holders, user)


def set_dormant(tables: Tables, as_of: datetime) -> JobResult:
    """Users idle for too long become dormant, unless all their roles are system roles."""
    params, users = tables["r_sysparam"], tables["r_user"]
    holders = tables["r_user_role"].select("user_id", "role_id").join(
        tables["r_role"].where(F.col("role_type") != ROLE_SYSTEM).select("role_id"), "role_id"
    )
    idle = dormant(
        users.where(F.col("status") != DORMANT), tables["r_user_info"], holders, as_of,
        special_days=number_param(params, "DORMANT_PERIOD_ADMIN"),
        other_days=number_param(params, "DORMANT_PERIOD_USER"),
    )
    idle = reuse_keys(idle.select("user_id", "status"))
    new = update_keys(users, idle, "user_id", {
        "status": F.lit(DORMANT), "updated_by": F.lit(PROCESS_USER), "dt_updated": moment(as_of),
    })
    audit = audit_rows(
        idle, DORMANT_ACTION, "R_USER",
        [F.col("user_id"), F.col("status")], [F.col("user_id"), F.lit(DORMANT)], as_of,
    )
    return JobResult({"r_user": new}, (DORMANT_LOG_NAME,), audit, touched={"r_user": idle})


def queue_password_resets(tables: Tables, as_of: datetime) -> JobResult:
    """Users asked to reset: one queued request each, flag cleared."""
    params, users = tables["r_sysparam"], tables["r_user"]
    param(params, LAST_RUN)  # has to exist exactly once
    flagged = users.where(F.col("pwd_regen_flag") == YES).select("user_id", "login_id", "pwd_regen_flag")
    links = tables["r_user_info"].select("user_id", "user_info_id", code("clntnum").alias("client"))
    clients = tables["ifsdmclntpf"].select(code("clntnum").alias("client"), F.col("zemailadd").alias("email"), *ADDRESS)
    asked = flagged.join(links, "user_id").join(clients, "client")
    order: list[Column | str] = ["user_info_id", "client", "email", *ADDRESS]
    asked = reuse_keys(first_per_key(asked, "user_id", order).drop("client", "user_info_id"))
    requests = asked.drop("pwd_regen_flag").withColumn("user_id", F.col("user_id").cast("string"))
    queue, added = enqueue_requests(tables["r_user_process"], requests, "user_id")
    new = {
        "r_user_process": queue,
        "r_user": update_keys(users, asked, "user_id", {"pwd_regen_flag": F.lit(NO)}),
        "r_sysparam": set_param(params, LAST_RUN, last_run_stamp(as_of)),
    }
    audit = audit_rows(
        asked, RESET_ACTION, "R_USER",
        [F.col("user_id"), F.col("pwd_regen_flag")], [F.col("user_id"), F.lit(NO)], as_of,
    )
    return JobResult(new, (RESET_LOG_NAME,), audit, touched={"r_user": asked, "r_user_process": added})
