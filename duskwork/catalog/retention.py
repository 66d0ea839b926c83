"""Retention, expiry, archive, settlement and dormancy on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from duskwork.catalog import stand_ins
from duskwork.catalog.registry import AFTER_EVENTS, AFTER_ORDERS, Source, query
from duskwork.operators.filters import aged, keep_matching
from duskwork.plans.approvals import expire_approvals
from duskwork.plans.archive import archive_transactions
from duskwork.plans.mailbox import overfull, purge_mailboxes
from duskwork.plans.settlement import settle_transactions
from duskwork.plans.users import set_dormant

_STALE = """
  o_orderstatus = 'P' AND o_orderdate <= TIMESTAMP '2001-08-02' - INTERVAL 1500 DAY
"""
_DOOMED = f"""
  SELECT o_orderkey FROM orders WHERE {_STALE}
  AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
"""


@query(f"SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey IN ({_DOOMED})")
def retention_semi(source: Source):
    stale = aged(source.orders.where(F.col("o_orderstatus") == "P"), "o_orderdate", 1500, AFTER_ORDERS)
    returned = source.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return keep_matching(stale, returned, "o_orderkey").select("o_orderkey", "o_custkey", "o_orderdate")


@query(f"""
SELECT o_orderkey AS pending_approval_id,
       CASE WHEN {_STALE} AND o_orderpriority <> '1-URGENT' THEN 'EXP'
            WHEN o_orderstatus = 'P' THEN 'PND' ELSE o_orderstatus END AS pending_status
FROM orders WHERE o_orderkey NOT IN ({_DOOMED})
""")
def expire_pending(source: Source):
    result = expire_approvals(stand_ins.approval_tables(source), AFTER_ORDERS)
    return result.tables["pending_approval"].select("pending_approval_id", "pending_status")


@query(f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_orderkey NOT IN ({_DOOMED})
""")
def cascade_delete(source: Source):
    left = expire_approvals(stand_ins.approval_tables(source), AFTER_ORDERS).tables["trx_ut_detail"]
    return left.select(
        F.col("trx_ut_id").alias("l_orderkey"), "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )


@query(f"""
SELECT 'EOD4.1' AS action, 'PENDING_APPROVAL' AS table_nm,
       o_orderkey || '|' || CASE WHEN o_orderpriority = '1-URGENT' THEN 'TRA' ELSE 'ADM' END || '|PND|'
         || o_orderpriority || '|' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '||||' || o_custkey || '|' AS data1,
       CASE WHEN o_orderkey IN ({_DOOMED}) THEN NULL ELSE
         o_orderkey || '|ADM|EXP|' || o_orderpriority || '|' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         || '||2001-08-02 00:00:00||' || o_custkey || '|' END AS data2
FROM orders WHERE {_STALE} AND (o_orderkey IN ({_DOOMED}) OR o_orderpriority <> '1-URGENT')
""")
def audit_trail_rows(source: Source):
    result = expire_approvals(stand_ins.approval_tables(source), AFTER_ORDERS)
    return result.audit.select("action", "table_nm", "data1", "data2")


_MAIL_LIMITS = """
  SELECT e.event_id, e.user_id, e.ts,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN 28 ELSE 27 END AS days,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN 60 ELSE 50 END AS newest,
         rank() OVER (PARTITION BY e.user_id ORDER BY e.ts DESC) - 1 AS newer
  FROM events e JOIN customer c ON c.c_custkey = e.user_id
"""
_MAIL_GONE = f"""
  SELECT event_id FROM ({_MAIL_LIMITS})
  WHERE ts <= TIMESTAMP '2024-01-31' - days * INTERVAL 1 DAY OR newer >= newest
"""


@query(f"SELECT event_id, user_id, ts FROM events WHERE event_id IN ({_MAIL_GONE})")
def mailbox_purge(source: Source):
    owners = source.customer.select(F.col("c_custkey").alias("user_id"), stand_ins.user_kind().alias("user_type"))
    mail = source.events.select("event_id", "user_id", "ts")
    return overfull(mail, owners, AFTER_EVENTS, days=(28, 27), newest=(60, 50), owner="user_id", ts="ts")


@query(f"SELECT event_id AS mail_id, event_type AS attachment_id FROM events WHERE event_id NOT IN ({_MAIL_GONE})")
def mailbox_left(source: Source):
    return purge_mailboxes(stand_ins.mail_tables(source), AFTER_EVENTS).tables["mail_dtl"]


_OLD_ORDERS = "o_orderdate <= TIMESTAMP '2001-08-02' - INTERVAL 2000 DAY"


@query(f"""
SELECT o_orderkey AS trx_ut_id, o_custkey AS account_id, o_orderpriority AS fee_structure_type
FROM orders WHERE {_OLD_ORDERS}
""")
def archive_moved(source: Source):
    moved = archive_transactions(stand_ins.archive_tables(source), AFTER_ORDERS).tables["trx_ut_hist"]
    return moved.select("trx_ut_id", "account_id", "fee_structure_type")


_DETAIL = "l_orderkey AS trx_ut_id, CAST(l_linenumber AS BIGINT) AS trx_ut_detail_id, l_partkey AS fund_id"


@query(f"SELECT {_DETAIL} FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE {_OLD_ORDERS})")
def archive_details(source: Source):
    moved = archive_transactions(stand_ins.archive_tables(source), AFTER_ORDERS).tables["trx_ut_detail_hist"]
    return moved.select("trx_ut_id", "trx_ut_detail_id", "fund_id")


@query(f"SELECT {_DETAIL} FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {_OLD_ORDERS})")
def archive_kept(source: Source):
    kept = archive_transactions(stand_ins.archive_tables(source), AFTER_ORDERS).tables["trx_ut_detail"]
    return kept.select("trx_ut_id", "trx_ut_detail_id", "fund_id")


@query(f"""
SELECT l_orderkey AS pending_approval_id, CAST(l_linenumber AS BIGINT) AS seq, l_returnflag AS note FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE {_OLD_ORDERS} AND o_orderpriority = '1-URGENT')
""")
def archive_approval_histories(source: Source):
    return archive_transactions(stand_ins.archive_tables(source), AFTER_ORDERS).tables["pending_approval_history_hist"]


@query("""
SELECT o_orderkey AS trx_ut_id,
       CASE WHEN o_orderstatus = 'P' AND NOT EXISTS (
              SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus <> 'F')
            THEN 'SUC' WHEN o_orderstatus = 'P' THEN 'ORD' ELSE o_orderstatus END AS trx_status
FROM orders
""")
def settle_ready(source: Source):
    transactions = source.orders.select(
        F.col("o_orderkey").alias("trx_ut_id"), F.col("o_orderkey").cast("string").alias("reference_id"),
        F.when(F.col("o_orderstatus") == "P", "ORD").otherwise(F.col("o_orderstatus")).alias("trx_status"),
    )
    feedback = source.lineitem.select(
        F.rpad(F.col("l_orderkey").cast("string"), 16, " ").alias("ztranref"),
        F.when(F.col("l_linestatus") == "F", "Y").otherwise("N").alias("fdbkind"),
    )
    state = settle_transactions({"trx_ut": transactions, "ifsdmutrnpf": feedback}, AFTER_ORDERS).tables["trx_ut"]
    return state.select("trx_ut_id", "trx_status")


@query("""
WITH last AS (SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id)
SELECT l.user_id,
       CASE WHEN l.ts <= TIMESTAMP '2024-01-31' - CASE WHEN c_mktsegment = 'BUILDING' THEN INTERVAL 12 HOUR
                                                       ELSE INTERVAL 6 HOUR END
                 AND r_name <> 'AFRICA' THEN 'D' ELSE 'A' END AS status
FROM last l LEFT JOIN customer ON c_custkey = l.user_id LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey
""")
def dormant_users(source: Source):
    return set_dormant(stand_ins.login_tables(source), AFTER_EVENTS).tables["r_user"].select("user_id", "status")
