"""A whole intake night, job after job, on the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.catalog import stand_ins
from duskwork.catalog.intake import _INTAKE
from duskwork.catalog.registry import AFTER_EVENTS, AFTER_ORDERS, Source, query
from duskwork.catalog.retention import _MAIL_LIMITS
from duskwork.operators.durable import scratch_folder
from duskwork.plans.night import HOUSEKEEPING_NIGHT, INTAKE_NIGHT, roles_in_use, run_night
from duskwork.sources.bucketed import Layout, lay_out, read_laid_out

# Users, their roles and accounts after each job; z has the users as the refresh leaves them.
_NIGHT = _INTAKE + """,
night_investor AS (
  SELECT f.*, (SELECT max(user_id) FROM users) + (SELECT count(*) FROM agent)
         + row_number() OVER (ORDER BY substr(md5(client), 1, 3), client) AS user_id
  FROM fresh f WHERE client NOT IN (SELECT client FROM agent)
  AND client IN (SELECT main FROM active UNION SELECT joint FROM active)),
everyone AS (
  SELECT user_id, client, CASE WHEN c_acctbal < 0 THEN 'I' ELSE 'A' END AS status, 'N' AS flag, false AS investor FROM users
  UNION ALL SELECT user_id, client, 'R', 'Y', false FROM agent
  UNION ALL SELECT user_id, client, CASE WHEN c_mktsegment = 'BUILDING' THEN 'I' ELSE 'R' END,
                   CASE WHEN c_mktsegment = 'BUILDING' THEN 'N' ELSE 'Y' END, true FROM night_investor),
night_account AS (
  SELECT chdrcoy, chdrnum, (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')
         + row_number() OVER (ORDER BY substr(md5(chdrcoy || '|' || chdrnum), 1, 3), chdrcoy, chdrnum) AS acctid
  FROM active WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND main IN (SELECT client FROM everyone)
  AND (joint = '' OR joint IN (SELECT client FROM everyone))),
held AS (
  SELECT user_id FROM everyone
  WHERE investor OR client IN (SELECT main FROM contract UNION SELECT joint FROM contract)),
serving AS (
  SELECT chdrcoy, lowest::VARCHAR AS agntnum FROM contract
  JOIN (SELECT l_orderkey, min(l_suppkey) AS lowest FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
ag AS (
  SELECT lpad((s_suppkey * 10)::VARCHAR, 8, '0') AS client, s_suppkey::VARCHAR AS agntnum, s_acctbal > 3000 AS live,
         CASE WHEN s_nationkey < 12 THEN '2' ELSE '3' END AS coy,
         CASE r_name WHEN 'ASIA' THEN 'I' WHEN 'EUROPE' THEN 'V' ELSE 'M' END AS kind
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
facts AS (
  SELECT e.user_id, e.client, e.status, e.flag,
    coalesce(c.c_mktsegment = 'BUILDING', false) AS off_web, coalesce(c.c_mktsegment <> 'BUILDING', false) AS on_web,
    e.client IN (SELECT main FROM active UNION SELECT joint FROM active) AS owned,
    coalesce(ag.kind = 'M' AND live, false) AS m_live, coalesce(ag.kind = 'M' AND NOT live, false) AS m_ended,
    coalesce(ag.kind = 'V' AND live, false) AS adviser,
    coalesce(live AND EXISTS (SELECT 1 FROM serving s WHERE s.agntnum = ag.agntnum AND s.chdrcoy = ag.coy), false) AS serves_live,
    e.user_id IN (SELECT user_id FROM held) AS assigned
  FROM everyone e LEFT JOIN client c ON c.client = e.client LEFT JOIN ag ON ag.client = e.client),
n1 AS (SELECT *, off_web AND status <> 'I' AS a2 FROM facts),
n2 AS (SELECT * REPLACE (CASE WHEN a2 THEN 'I' ELSE status END AS status) FROM n1),
n3 AS (SELECT *, on_web AND m_live AND status = 'I' AS b1, on_web AND m_ended AND status = 'A' AND NOT owned AS b2 FROM n2),
n4 AS (SELECT * REPLACE (CASE WHEN b2 THEN 'I' ELSE status END AS status), on_web AND adviser AND NOT assigned AS in_d FROM n3),
n5 AS (SELECT *, in_d AND serves_live AND status = 'I' AS d1, in_d AND NOT serves_live AND status <> 'I' AS d2 FROM n4),
n6 AS (SELECT * REPLACE (CASE WHEN d2 THEN 'I' ELSE status END AS status), on_web AND assigned AS in_e FROM n5),
n7 AS (SELECT *, in_e AND owned AND status = 'I' AS e1, in_e AND NOT owned AND status <> 'I' AS e2 FROM n6),
z AS (
  SELECT user_id, client, CASE WHEN e2 THEN 'I' ELSE status END AS status, flag = 'Y' OR b1 OR d1 OR e1 AS asked,
    'REFRESH USR ' || CASE WHEN e1 OR e2 THEN '2E' WHEN d1 OR d2 THEN '2D' WHEN b2 THEN '2B-ii' WHEN b1 THEN '2B' WHEN a2 THEN '2A' END AS updated_by
  FROM n7),
early AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-04')
"""


@query(f"""{_NIGHT}
SELECT 'user' AS what, user_id AS id, status AS a, 'N' AS b, updated_by AS c FROM z
UNION ALL SELECT 'role', user_id, 'A', NULL, NULL FROM held
UNION ALL SELECT 'account', acctid, chdrcoy, chdrnum, NULL FROM night_account
UNION ALL SELECT 'queued', user_id, NULL, NULL, NULL FROM early
UNION ALL SELECT 'queued', user_id, NULL, NULL, NULL FROM z WHERE asked AND user_id NOT IN (SELECT user_id FROM early)
""")
def nightly_states(source: Source):
    """Users, roles, accounts and reset requests after the seven jobs of the intake night."""
    tables = stand_ins.written_once(stand_ins.night_tables(source), stand_ins.NIGHT_DERIVED)
    folder = scratch_folder(source.spark, "night")
    state = run_night(
        source.spark, INTAKE_NIGHT, tables, AFTER_ORDERS, folder, "first", views={"v_userrole": roles_in_use}
    )
    none = F.lit(None).cast("string")
    opened = state["plan_acct"].where(F.col("created_by") == "EOD-NEWFE")
    parts = [
        state["r_user"].select(F.lit("user").alias("what"), F.col("user_id").alias("id"), F.col("status").alias("a"),
                               F.col("pwd_regen_flag").alias("b"), F.col("updated_by").alias("c")),
        state["r_user_role"].select(F.lit("role"), "user_id", "status", none, none),
        opened.select(F.lit("account"), "acctid", "chdrcoy", "chdrnum", none),
        state["r_user_process"].select(F.lit("queued"), F.col("user_id").cast("bigint"), none, none, none),
    ]
    return reduce(DataFrame.union, parts)


# All jobs look at the tables from the same moment: just after the last event.
_HOUSE = f"""
WITH trx AS (
  SELECT o_orderkey AS id, CASE WHEN o_custkey % 2 = 0 THEN 'ORD' ELSE 'NEW' END AS status, o_orderdate FROM orders
  WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')),
stale AS (
  SELECT o_orderkey AS id, o_orderpriority = '1-URGENT' AS tra, o_orderkey IN (SELECT id FROM trx) AS has_trx FROM orders
  WHERE o_orderstatus = 'P' AND o_orderdate <= TIMESTAMP '2024-01-31' - INTERVAL 9500 DAY),
left_trx AS (SELECT * FROM trx WHERE id NOT IN (SELECT id FROM stale WHERE has_trx)),
old AS (SELECT id FROM left_trx WHERE o_orderdate <= TIMESTAMP '2024-01-31' - INTERVAL 10000 DAY),
live AS (SELECT * FROM left_trx WHERE id NOT IN (SELECT id FROM old)),
approval AS (
  SELECT o_orderkey AS id, o_orderdate, o_orderpriority = '1-URGENT' AS tra,
         CASE WHEN o_orderkey IN (SELECT id FROM stale WHERE NOT has_trx AND NOT tra) THEN 'EXP'
              WHEN o_orderstatus = 'P' THEN 'PND' ELSE o_orderstatus END AS status
  FROM orders WHERE o_orderkey NOT IN (SELECT id FROM stale WHERE has_trx)),
moved AS (SELECT id FROM approval WHERE tra AND o_orderdate <= TIMESTAMP '2024-01-31' - INTERVAL 10000 DAY),
gone AS (SELECT event_id FROM ({_MAIL_LIMITS}) WHERE ts <= TIMESTAMP '2024-01-31' - days * INTERVAL 1 DAY OR newer >= newest),
last AS (SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id)
"""


@query(f"""{_HOUSE}
SELECT 'transaction' AS what, id, CASE WHEN status = 'ORD' AND NOT EXISTS (
         SELECT 1 FROM lineitem WHERE l_orderkey = id AND l_linestatus <> 'F') THEN 'SUC' ELSE status END AS state FROM live
UNION ALL SELECT 'archived transaction', id, (SELECT status FROM trx t WHERE t.id = old.id) FROM old
UNION ALL SELECT 'detail', l_orderkey, l_linenumber::VARCHAR FROM lineitem
          WHERE l_orderkey NOT IN (SELECT id FROM old) AND l_orderkey NOT IN (SELECT id FROM stale WHERE has_trx)
UNION ALL SELECT 'archived detail', l_orderkey, l_linenumber::VARCHAR FROM lineitem WHERE l_orderkey IN (SELECT id FROM old)
UNION ALL SELECT 'approval', id, status FROM approval WHERE id NOT IN (SELECT id FROM moved)
UNION ALL SELECT 'archived approval', id, status FROM approval WHERE id IN (SELECT id FROM moved)
UNION ALL SELECT 'mail', event_id, NULL FROM events WHERE event_id NOT IN (SELECT event_id FROM gone)
UNION ALL SELECT 'user', l.user_id, CASE WHEN l.ts <= TIMESTAMP '2024-01-31'
            - CASE WHEN c_mktsegment = 'BUILDING' THEN INTERVAL 12 HOUR ELSE INTERVAL 6 HOUR END AND r_name <> 'AFRICA' THEN 'D' ELSE 'A' END
          FROM last l LEFT JOIN customer ON c_custkey = l.user_id LEFT JOIN nation ON n_nationkey = c_nationkey
          LEFT JOIN region ON r_regionkey = n_regionkey
""")
def housekeeping_states(source: Source):
    """Every table of the housekeeping night behind its five jobs; transactions, approvals and users are laid out by key."""
    spark = source.spark
    tables = stand_ins.housekeeping_tables(source)
    folder = scratch_folder(spark, "house")
    layouts = {}
    for name, key in (("trx_ut", "trx_ut_id"), ("trx_ut_detail", "trx_ut_id"), ("pending_approval", "pending_approval_id"), ("r_user", "user_id")):
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tables[name].schema.fields)
        layouts[name] = Layout(f"{folder}/{name}", (key,), schema, 1)
        lay_out(tables[name], layouts[name])
        tables[name] = read_laid_out(spark, layouts[name])
    state = run_night(spark, HOUSEKEEPING_NIGHT, tables, AFTER_EVENTS, folder, "first", layouts)

    def rows(what, name, key, shown):
        shown = F.col(shown) if shown else F.lit(None)
        return state[name].select(F.lit(what).alias("what"), F.col(key).alias("id"), shown.cast("string").alias("state"))

    parts = [
        rows("transaction", "trx_ut", "trx_ut_id", "trx_status"), rows("archived transaction", "trx_ut_hist", "trx_ut_id", "trx_status"),
        rows("detail", "trx_ut_detail", "trx_ut_id", "trx_ut_detail_id"),
        rows("archived detail", "trx_ut_detail_hist", "trx_ut_id", "trx_ut_detail_id"),
        rows("approval", "pending_approval", "pending_approval_id", "pending_status"),
        rows("archived approval", "pending_approval_hist", "pending_approval_id", "pending_status"),
        rows("mail", "mail", "mail_id", None), rows("user", "r_user", "user_id", "status"),
    ]
    return reduce(DataFrame.unionByName, parts)
