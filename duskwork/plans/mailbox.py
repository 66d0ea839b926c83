"""Emptying mailboxes and mailing the annual report."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.functions.dates import moment, stamp_text
from duskwork.functions.text import code, full_name
from duskwork.operators.audit import audit_rows
from duskwork.operators.durable import reuse, reuse_keys
from duskwork.operators.filters import class_limit, join_side, keep_matching, oldest_allowed
from duskwork.operators.keys import assign_keys
from duskwork.operators.mutate import delete_keys, update_where
from duskwork.operators.ranking import first_per_key, newest_cutoffs
from duskwork.operators.sequences import last_key, reserved
from duskwork.plans.job import JobResult, Tables
from duskwork.sources.codes import ACTIVE, COMPLETED, INTERNAL_USER, MAIL_USER, PENDING, YES
from duskwork.sources.params import number_param

# --- fixed values ---
PURGE_LOG_NAME = "DeleteMailbox"
PURGE_ACTION = "DeleteMB"
PURGE_TABLES = "MAIL,MAIL.DTL"
MAILING_LOG_NAME = "AnnualReport"
SENDER = "SYSTEM"
MAIL_TYPE = "I"
SUBJECT = "Fund Information"


def overfull(
    mail: DataFrame, owners: DataFrame, as_of: datetime, *, days: tuple[float, float], newest: tuple[float, float],
    owner: str = "owner_id", user: str = "user_id", kind: str = "user_type", ts: str = "dt_created",
    special: str = INTERNAL_USER,
) -> DataFrame:
    """Mails that are too old, or behind enough newer ones of the same owner.

    ``days`` and ``newest`` give the limits for the ``special`` kind of owner
    and for all others. An owner listed more than once is held to the strictest
    of its limits; mails without a listed owner stay.
    """
    count_special, count_other = (math.ceil(n) for n in newest)
    counts = sorted({n for n in (count_special, count_other) if n > 0})
    limits = owners.groupBy(F.col(user).alias(owner)).agg(
        F.max(oldest_allowed(kind, {special: days[0]}, days[1], as_of)).alias("__oldest"),
        F.min(class_limit(kind, {special: F.lit(count_special)}, F.lit(count_other))).alias("__newest"),
    ).dropna(subset=[owner])
    if counts:
        limits = limits.join(newest_cutoffs(mail, owner, ts, counts), owner, "left")
    cutoff = F.lit(None).cast("timestamp_ntz")
    for n in counts:
        cutoff = F.when(F.col("__newest") == n, F.col(f"newest_{n}")).otherwise(cutoff)
    limits = limits.select(owner, "__oldest", "__newest", cutoff.alias("__cutoff"))
    gone = (F.col(ts) <= F.col("__oldest")) | (F.col("__newest") <= 0) | (F.col(ts) < F.col("__cutoff"))
    return mail.join(join_side(limits, owner), owner).where(gone).select(*mail.columns)


def purge_mailboxes(tables: Tables, as_of: datetime) -> JobResult:
    """Delete mails over the age or count limit of their owner's user type."""
    params = tables["r_sysparam"]
    doomed = overfull(
        tables["mail"], tables["r_user_info"], as_of,
        days=(number_param(params, "MAIL_MAX_DAYS_ADMIN"), number_param(params, "MAIL_MAX_DAYS_NON_ADMIN")),
        newest=(number_param(params, "MAIL_MAX_MESSAGES_ADMIN"), number_param(params, "MAIL_MAX_MESSAGES_NON_ADMIN")),
    )
    doomed = reuse_keys(doomed.select("mail_id", "subject", "dt_created").distinct())
    keys = doomed.select("mail_id")
    new = {name: delete_keys(tables[name], keys, "mail_id") for name in ("mail_dtl_content", "mail_dtl", "mail")}
    before = [F.col("mail_id"), stamp_text(F.col("dt_created")), F.col("subject")]
    audit = audit_rows(doomed, PURGE_ACTION, PURGE_TABLES, before, None, as_of)
    return JobResult(new, (PURGE_LOG_NAME,), audit, touched=dict.fromkeys(new, keys))


def addressed(recipients: DataFrame, names: DataFrame, users: DataFrame) -> DataFrame:
    """Recipients who have both a name and a user (one row per client in each)."""
    return recipients.join(join_side(names, "client"), "client").join(join_side(users, "client"), "client")


def mail_annual_report(tables: Tables, as_of: datetime) -> JobResult:
    """One mail per pending template and recipient, with the template's files.

    Recipients unknown as client or user get none; ``out['skipped']`` counts
    them per template.
    """
    pending = tables["mail_temp"].where(F.col("status") == PENDING).select("mail_temp_id", "message")
    recipients = tables["mail_temp_rcpt"].select("mail_temp_id", code("clntnum").alias("client"))
    recipients = reuse_keys(keep_matching(recipients, pending, "mail_temp_id"))
    clients = keep_matching(tables["ifsdmclntpf"].withColumn("client", code("clntnum")), recipients, "client")
    names = first_per_key(clients, "client", ["surname", "givname", "race"]).select(
        "client", full_name("race", "surname", "givname").alias("to")
    )
    users = keep_matching(tables["r_user_info"].withColumn("client", code("clntnum")), recipients, "client")
    users = first_per_key(users, "client", ["user_info_id"]).select("client", F.col("user_id").alias("owner_id"))

    # message texts are joined last: they do not travel through the numbering
    sent = reuse(addressed(recipients, names, users))
    sent = reuse(assign_keys(sent, ["mail_temp_id", "client"], "mail_id", last_key(tables, "mail", "mail_id")))
    mails = sent.join(pending, "mail_temp_id").select(
        "mail_id", "owner_id", F.lit(SENDER).alias("from"), "to", "message", F.lit(MAIL_TYPE).alias("mail_type"),
        F.lit(SUBJECT).alias("subject"), moment(as_of).alias("dt_mail"), F.lit(MAIL_USER).alias("created_by"),
        moment(as_of).alias("dt_created"), F.lit(ACTIVE).alias("status"), F.lit(YES).alias("new_mail_flag"),
    )
    files = sent.select("mail_temp_id", "mail_id").join(
        tables["mail_temp_file"].select("mail_temp_id", "attachment_id"), "mail_temp_id"
    ).select("mail_id", "attachment_id")
    asked = recipients.groupBy("mail_temp_id").agg(F.count(F.lit(1)).alias("asked"))
    done = sent.groupBy("mail_temp_id").agg(F.count(F.lit(1)).alias("done"))
    skipped = asked.join(done, "mail_temp_id", "left").select(
        "mail_temp_id", (F.col("asked") - F.coalesce("done", F.lit(0))).alias("skipped")
    )
    new = {
        "mail_temp": update_where(
            tables["mail_temp"], F.col("status") == PENDING, {"status": F.lit(COMPLETED)}
        ),
        **reserved(tables, {("mail", "mail_id"): sent}),
    }
    appended = {"mail": mails, "mail_dtl": files}
    return JobResult.of(tables, (MAILING_LOG_NAME,), new, appended, out={"skipped": skipped})
