"""A night of jobs in order, which a restart takes up behind the last finished one.

Every job is a run of its own under the night's folder (``run_job``): its tables are
written and a list of them commits it. A restart with the same steps reads the finished
runs back, puts buckets in place that were staged but not replaced, and computes only
what is missing. The moment the night counts from is written when it begins, so a
restart the next morning gives the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwork.plans.approvals import LOG_NAME as EXPIRY_LOG_NAME
from duskwork.plans.approvals import expire_approvals
from duskwork.plans.archive import LOG_NAME as ARCHIVE_LOG_NAME
from duskwork.plans.archive import archive_transactions
from duskwork.plans.intake import (
    ACCOUNT_LOG_NAME, AGENT_LOG_NAME, INVESTOR_LOG_NAME, investor_roles, new_accounts, new_agents, new_investors,
    staged_portfolios,
)
from duskwork.plans.job import Job, Tables, run_job
from duskwork.plans.mailbox import PURGE_LOG_NAME, purge_mailboxes
from duskwork.plans.refresh import USERS_LOG_NAME, refresh_users
from duskwork.plans.settlement import LOG_NAME as SETTLEMENT_LOG_NAME
from duskwork.plans.settlement import settle_transactions
from duskwork.plans.users import DORMANT_LOG_NAME, RESET_LOG_NAME, queue_password_resets, set_dormant
from duskwork.sources import files
from duskwork.sources.bucketed import Layout

View = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Step:
    """A job under the name its failure is logged by."""

    name: str
    job: Job


# Agents before investors, accounts before roles, and whatever asks for a reset before the requests.
INTAKE_NIGHT = (
    Step(AGENT_LOG_NAME, new_agents), Step(INVESTOR_LOG_NAME, new_investors), Step(ACCOUNT_LOG_NAME, new_accounts),
    Step("STAGED_PORTFOLIO", staged_portfolios), Step("INVESTOR_ROLE", investor_roles),
    Step(USERS_LOG_NAME, refresh_users), Step(RESET_LOG_NAME, queue_password_resets),
)


# Approvals expire before their transactions are archived or settled.
HOUSEKEEPING_NIGHT = (
    Step(EXPIRY_LOG_NAME, expire_approvals), Step(ARCHIVE_LOG_NAME, archive_transactions),
    Step(SETTLEMENT_LOG_NAME, settle_transactions), Step(PURGE_LOG_NAME, purge_mailboxes),
    Step(DORMANT_LOG_NAME, set_dormant),
)


class NightStopped(RuntimeError):
    """A job failed: ``tables`` are as the job before left them, with the failure in the run log."""

    def __init__(self, step: Step, tables: dict[str, DataFrame]):
        super().__init__(f"{step.name} failed; see the run log")
        self.step, self.tables = step, tables


def run_name(night: str, number: int, step: Step) -> str:
    return f"{night}/{number:02d}-" + re.sub(r"\W+", "-", step.name)


def begin(spark: SparkSession, steps: Sequence[Step], as_of: datetime, folder: str, night: str) -> datetime:
    """The moment the night counts from: the one given at its first start."""
    place, names = f"{folder}/{night}/begun", [s.name for s in steps]
    if not files.finished(spark, place):
        rows = spark.createDataFrame([(as_of, names)], "as_of timestamp_ntz, steps array<string>")
        rows.coalesce(1).write.mode("overwrite").parquet(place)
        return as_of
    first = spark.read.parquet(place).first()
    if list(first["steps"]) != names:
        raise ValueError(f"night {night} was begun with the steps {list(first['steps'])}")
    return first["as_of"]


def run_night(
    spark: SparkSession, steps: Sequence[Step], tables: Tables, as_of: datetime, folder: str, night: str,
    layouts: Mapping[str, Layout] | None = None, views: Mapping[str, View] | None = None,
) -> dict[str, DataFrame]:
    """Run the steps, each on the tables the one before left, and return the last state.

    ``tables`` is the state the night begins with, also at a restart; tables with a layout
    may have been changed in place meanwhile. ``views`` are tables made from others,
    renewed before each step. A job that fails stops the night (:class:`NightStopped`).
    """
    as_of = begin(spark, steps, as_of, folder, night)
    state = dict(tables)
    for number, step in enumerate(steps, 1):
        state.update({name: view(state) for name, view in (views or {}).items()})
        run = run_name(night, number, step)
        state = run_job(spark, step.job, step.name, state, as_of, folder, layouts, run)
        if not files.finished(spark, f"{folder}/{run}/written"):
            raise NightStopped(step, state)
    return state


def report(spark: SparkSession, steps: Sequence[Step], folder: str, night: str) -> DataFrame:
    """number, name, state (done, failed or open), failures: one row per step, from what the runs have written."""
    rows = []
    for number, step in enumerate(steps, 1):
        place = f"{folder}/{run_name(night, number, step)}"
        failures = len(files.folders(spark, f"{place}/failed"))
        done = files.finished(spark, f"{place}/written")
        rows.append((number, step.name, "done" if done else "failed" if failures else "open", failures))
    return spark.createDataFrame(rows, "number int, name string, state string, failures int")


def roles_in_use(tables: Tables) -> DataFrame:
    """The view of users and their roles."""
    return tables["r_user_role"].select("user_id", F.col("role_id"))
