"""Audit rows of each job, and the run log row of one that fails, on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from duskwork.catalog import stand_ins
from duskwork.catalog.intake import _INTAKE
from duskwork.catalog.registry import AFTER_EVENTS, AFTER_ORDERS, Source, query
from duskwork.catalog.retention import _MAIL_GONE, _OLD_ORDERS
from duskwork.operators.audit import LOG_SCHEMA
from duskwork.operators.durable import scratch_folder
from duskwork.plans.approvals import LOG_NAME as EXPIRY, expire_approvals
from duskwork.plans.archive import archive_transactions
from duskwork.plans.intake import new_agents, new_investors, open_accounts
from duskwork.plans.job import JobResult, run_job
from duskwork.plans.mailbox import purge_mailboxes
from duskwork.plans.settlement import settle_transactions
from duskwork.plans.users import queue_password_resets, set_dormant


def _trail(result: JobResult):
    return result.audit.select("action", "table_nm", "data1", "data2")


@query(f"""
SELECT 'DeleteMB' AS action, 'MAIL,MAIL.DTL' AS table_nm,
       event_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || event_type AS data1, NULL AS data2
FROM events WHERE event_id IN ({_MAIL_GONE})
""")
def audit_mailboxes(source: Source):
    return _trail(purge_mailboxes(stand_ins.mail_tables(source), AFTER_EVENTS))


@query(f"""
WITH old AS (SELECT * FROM orders WHERE {_OLD_ORDERS}),
gone AS (
  SELECT 'TRX_UT' AS t, o_orderkey AS id FROM old
  UNION ALL SELECT 'TRX_UT_DETAIL', l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM old)
  UNION ALL SELECT 'PENDING_APPROVAL', o_orderkey FROM old WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT 'PENDING_APPROVAL_HISTORY', l_orderkey FROM lineitem
            WHERE l_orderkey IN (SELECT o_orderkey FROM old WHERE o_orderpriority = '1-URGENT'))
SELECT 'HkpTrnHist' AS action, t AS table_nm, t || ' ' || id AS data1, t || '_HIST ' || id AS data2 FROM gone
""")
def audit_archive(source: Source):
    return _trail(archive_transactions(stand_ins.archive_tables(source), AFTER_ORDERS))


@query("""
WITH last AS (SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id)
SELECT 'DormantUID' AS action, 'R_USER' AS table_nm, l.user_id || '|A' AS data1, l.user_id || '|D' AS data2
FROM last l JOIN customer ON c_custkey = l.user_id JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey
WHERE r_name <> 'AFRICA' AND l.ts <= TIMESTAMP '2024-01-31'
  - CASE WHEN c_mktsegment = 'BUILDING' THEN INTERVAL 12 HOUR ELSE INTERVAL 6 HOUR END
""")
def audit_dormant(source: Source):
    return _trail(set_dormant(stand_ins.login_tables(source), AFTER_EVENTS))


@query(f"""{_INTAKE}
SELECT 'NEW_AGENT' AS action, 'R_USER,R_USER_INFO' AS table_nm, NULL AS data1, user_id || '|' || user_id || '|' || client AS data2
FROM agent
""")
def audit_advisers(source: Source):
    return _trail(new_agents(stand_ins.client_tables(source), AFTER_ORDERS))


@query(f"""{_INTAKE}
SELECT 'NEW_USER' AS action, 'R_USER,R_USER_INFO,R_USER_ROLE' AS table_nm, NULL AS data1,
       user_id || '|' || user_id || '|' || (user_id - (SELECT max(user_id) FROM users)) || '|' || client AS data2
FROM investor
""")
def audit_investors(source: Source):
    return _trail(new_investors(stand_ins.client_tables(source), AFTER_ORDERS))


@query(f"""{_INTAKE},
opened AS (
  SELECT o.chdrcoy, o.chdrnum, o.main, o.joint, c.entity_id AS created_id, coalesce(c.entity_id, e.entity_id) AS entity_id,
         row_number() OVER (PARTITION BY o.main, o.joint ORDER BY o.chdrcoy, o.chdrnum) AS n,
         (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')
         + row_number() OVER (ORDER BY substr(md5(o.chdrcoy || '|' || o.chdrnum), 1, 3), o.chdrcoy, o.chdrnum) AS acctid
  FROM opening o LEFT JOIN created c ON c.main = o.main AND c.joint = o.joint
  LEFT JOIN entity e ON e.main = o.main AND o.joint = '')
SELECT 'NEW_ACCT' AS action, ',R_CUSTOMER,R_CUSTUSER_MATRIX' AS table_nm, NULL AS data1,
       '|' || entity_id || '|' || main || '|' || joint AS data2 FROM created
UNION ALL
SELECT 'NEW_ACCT', CASE WHEN n = 1 AND created_id IS NOT NULL THEN 'PLAN_ACCT,R_CUSTOMER,R_CUSTUSER_MATRIX' ELSE 'PLAN_ACCT' END,
       NULL, acctid || '|' || chdrcoy || '|' || chdrnum || '|' || entity_id FROM opened
""")
def audit_accounts(source: Source):
    return _trail(open_accounts(stand_ins.intake_tables(source), AFTER_ORDERS))


@query("""
SELECT DISTINCT 'ResetPW' AS action, 'R_USER' AS table_nm, user_id || '|Y' AS data1, user_id || '|N' AS data2
FROM events JOIN customer ON c_custkey = user_id WHERE event_type = 'signup' AND value > 60
""")
def audit_resets(source: Source):
    return _trail(queue_password_resets(stand_ins.reset_tables(source), AFTER_EVENTS))


@query("""
SELECT 'TrxApp' AS action, 'TRX_UT' AS table_nm, o_orderkey || '|ORD' AS data1, o_orderkey || '|SUC' AS data2 FROM orders
WHERE o_orderstatus = 'P' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus <> 'F')
""")
def audit_settlement(source: Source):
    transactions = source.orders.select(
        F.col("o_orderkey").alias("trx_ut_id"), F.col("o_orderkey").cast("string").alias("reference_id"),
        F.when(F.col("o_orderstatus") == "P", "ORD").otherwise(F.col("o_orderstatus")).alias("trx_status"),
    )
    feedback = source.lineitem.select(
        F.col("l_orderkey").cast("string").alias("ztranref"),
        F.when(F.col("l_linestatus") == "F", "Y").otherwise("N").alias("fdbkind"),
    )
    return _trail(settle_transactions({"trx_ut": transactions, "ifsdmutrnpf": feedback}, AFTER_ORDERS))


@query("""
SELECT 'DelExpTrnReqWOApp' AS eod_proc_name, 'F' AS status, 'EOD_PROCESS' AS created_by,
       'parameter PENDINGAPPROVAL_DAYS: expected one row, found several' AS remarks,
       count(*) AS approvals, count(*) FILTER (WHERE o_orderstatus = 'P') AS pending FROM orders
""")
def failed_run(source: Source):
    """The run log row of a job that fails, next to what is left of its table: everything."""
    spark = source.spark
    tables = stand_ins.approval_tables(source)
    tables["r_sysparam"] = tables["r_sysparam"].union(tables["r_sysparam"])
    tables["eod_log"] = stand_ins.empty(spark, LOG_SCHEMA)
    state = run_job(spark, expire_approvals, EXPIRY, tables, AFTER_ORDERS, scratch_folder(spark, "failed"))
    left = state["pending_approval"].agg(
        F.count(F.lit(1)).alias("approvals"), F.count(F.when(F.col("pending_status") == "PND", 1)).alias("pending")
    )
    log = state["eod_log"].select("eod_proc_name", "status", "created_by", "remarks")
    return log.join(left, F.lit(True))
