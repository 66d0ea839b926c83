"""Incremental intake, key assignment and entities on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from duskwork.catalog import stand_ins
from duskwork.catalog.registry import AFTER_EVENTS, AFTER_ORDERS, Source, query
from duskwork.functions.dates import moment
from duskwork.functions.text import trimmed
from duskwork.operators.entities import joint_group, sole_member_group
from duskwork.operators.incremental import high_water_mark as mark_of
from duskwork.operators.incremental import incremental_new, last_success
from duskwork.operators.mutate import update_from
from duskwork.operators.ranking import first_per_key as first_rows
from duskwork.plans.entities import get_entities
from duskwork.plans.intake import investor_roles, new_agents, new_investors, open_accounts
from duskwork.plans.mailbox import mail_annual_report
from duskwork.plans.portfolios import copy_beneficiaries, insert_portfolios, staged_references
from duskwork.plans.users import queue_password_resets


@query("""
SELECT job, COALESCE(max(ts) - INTERVAL 5 DAY, TIMESTAMP '1990-01-01') AS mark
FROM (SELECT DISTINCT event_type AS job FROM events UNION SELECT c_mktsegment FROM customer)
LEFT JOIN events ON event_type = job AND value <= 100 GROUP BY job
""")
def high_water_mark(source: Source):
    status = F.when(F.col("value") <= 100, "S").otherwise("F")
    log = source.events.select(F.col("event_type").alias("job"), F.col("ts").alias("ended"), status.alias("status"))
    jobs = log.select("job").union(source.customer.select("c_mktsegment")).distinct()
    return last_success(log, jobs, name="job", when="ended")


@query("""
WITH m AS (SELECT max(ts) - INTERVAL 5 DAY AS mark FROM events WHERE event_type = 'purchase' AND value <= 100)
SELECT event_id, user_id, ts FROM events, m WHERE ts > mark AND user_id NOT IN (
  SELECT user_id FROM events, m WHERE event_type = 'error' AND value > 60 AND ts <= mark)
""")
def incremental_rows(source: Source):
    events = source.events
    status = F.when(F.col("value") <= 100, "S").otherwise("F")
    log = events.select(F.col("event_type").alias("job"), F.col("ts").alias("ended"), status.alias("status"))
    mark = moment(mark_of(log, "purchase", name="job", when="ended"))
    present = events.where((F.col("event_type") == "error") & (F.col("value") > 60) & (F.col("ts") <= mark))
    rows = incremental_new(events.select("event_id", "user_id", "ts"), F.col("ts") > mark, present, "user_id")
    return rows


_INTAKE = """
WITH joint AS (SELECT l_orderkey, lpad(min(l_suppkey)::VARCHAR, 8, '0') AS joint FROM lineitem GROUP BY 1),
contract AS (
  SELECT o_orderkey, o_orderdate, CASE o_orderstatus WHEN 'F' THEN '2' WHEN 'O' THEN '3' ELSE '1' END AS chdrcoy,
         o_orderkey::VARCHAR AS chdrnum, lpad(o_custkey::VARCHAR, 8, '0') AS main,
         CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE coalesce(joint, '') END AS joint,
         CASE WHEN o_orderstatus = 'F' THEN 'AND' ELSE 'JUV' END AS authority
  FROM orders LEFT JOIN joint ON l_orderkey = o_orderkey
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
active AS (SELECT * FROM contract WHERE chdrcoy IN ('2', '3')),
client AS (
  SELECT lpad(c_custkey::VARCHAR, 8, '0') AS client, c_mktsegment, c_acctbal, max(o_orderdate) AS changed
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
users AS (
  SELECT DISTINCT user_id, lpad(user_id::VARCHAR, 8, '0') AS client, c_acctbal
  FROM events JOIN customer ON c_custkey = user_id),
fresh AS (
  SELECT client, c_mktsegment, CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS email_notify_flag
  FROM client WHERE changed > TIMESTAMP '2001-07-01' AND client NOT IN (SELECT client FROM users)),
investor AS (
  SELECT *, (SELECT max(user_id) FROM users) + row_number() OVER (ORDER BY substr(md5(client), 1, 3), client) AS user_id
  FROM fresh WHERE client IN (SELECT main FROM active UNION SELECT joint FROM active)),
agent AS (
  SELECT *, (SELECT max(user_id) FROM users) + row_number() OVER (ORDER BY substr(md5(client), 1, 3), client) AS user_id
  FROM fresh WHERE c_mktsegment <> 'BUILDING' AND client IN (
    SELECT lpad((s_suppkey * 10)::VARCHAR, 8, '0') FROM supplier WHERE s_acctbal > 0)),
opening AS (
  SELECT * FROM active WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND main IN (SELECT client FROM users)
  AND (joint = '' OR joint IN (SELECT client FROM users))),
entity AS (SELECT client AS main, user_id AS entity_id FROM users WHERE c_acctbal > 5000),
missing AS (
  SELECT DISTINCT main, joint FROM opening WHERE NOT (joint = '' AND main IN (SELECT main FROM entity))),
opener AS (
  SELECT main, joint, authority FROM (
    SELECT *, row_number() OVER (PARTITION BY main, joint ORDER BY chdrcoy, chdrnum) AS n FROM opening) WHERE n = 1),
created AS (
  SELECT m.main, m.joint, (SELECT max(entity_id) FROM entity)
         + row_number() OVER (ORDER BY substr(md5(m.main || '|' || m.joint), 1, 3), m.main, m.joint) AS entity_id,
         CASE WHEN m.joint <> '' THEN 'JOI' WHEN c_mktsegment = 'MACHINERY' THEN 'COR' ELSE 'IND' END AS customer_type,
         CASE WHEN m.joint <> '' THEN o.authority END AS auth_type
  FROM missing m JOIN opener o ON o.main = m.main AND o.joint = m.joint LEFT JOIN client ON client = m.main)
"""


@query(f"""{_INTAKE}
SELECT user_id, user_id AS user_info_id, client AS clntnum, email_notify_flag,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'I' ELSE 'R' END AS status,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'N' ELSE 'Y' END AS pwd_regen_flag
FROM investor
""")
def new_users(source: Source):
    result = new_investors(stand_ins.client_tables(source), AFTER_ORDERS)
    return result.out["NEW_USER"].select(
        "user_id", "user_info_id", "clntnum", "email_notify_flag", "status", "pwd_regen_flag"
    )


@query(f"""{_INTAKE}
SELECT user_id, user_id - (SELECT max(user_id) FROM users) AS user_role_id,
       (SELECT r_regionkey::BIGINT FROM region WHERE r_name = 'ASIA') AS role_id, 'A' AS status
FROM investor
""")
def role_fanout(source: Source):
    roles = new_investors(stand_ins.client_tables(source), AFTER_ORDERS).tables["r_user_role"]
    return roles.select("user_id", "user_role_id", "role_id", "status")


@query(f"{_INTAKE} SELECT user_id, client AS clntnum, email_notify_flag FROM agent")
def new_advisers(source: Source):
    people = new_agents(stand_ins.client_tables(source), AFTER_ORDERS).out["NEW_AGENT"]
    return people.select("user_id", "clntnum", "email_notify_flag")


@query(f"""{_INTAKE}
SELECT o.chdrcoy, o.chdrnum, coalesce(c.entity_id, e.entity_id) AS entity_id,
       (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')
       + row_number() OVER (ORDER BY substr(md5(o.chdrcoy || '|' || o.chdrnum), 1, 3), o.chdrcoy, o.chdrnum) AS acctid
FROM opening o LEFT JOIN created c ON c.main = o.main AND c.joint = o.joint
LEFT JOIN entity e ON e.main = o.main AND o.joint = ''
""", name="new_accounts")
def _new_accounts(source: Source):
    opened = open_accounts(stand_ins.intake_tables(source), AFTER_ORDERS).out["NEW_ACCT"]
    return opened.select("chdrcoy", "chdrnum", "entity_id", "acctid")


@query(f"""{_INTAKE}
SELECT entity_id AS entityid, customer_type, auth_type FROM created
UNION ALL SELECT entity_id, 'IND', NULL FROM entity
""")
def new_entities(source: Source):
    result = open_accounts(stand_ins.intake_tables(source), AFTER_ORDERS)
    return result.tables["r_customer"].select("entityid", "customer_type", "auth_type")


@query(f"""{_INTAKE}
SELECT entity_id, 'JO1' AS relationship, main::BIGINT AS user_info_id FROM created
UNION ALL SELECT entity_id, 'JO2', joint::BIGINT FROM created WHERE joint <> ''
UNION ALL SELECT entity_id, 'JO1', entity_id FROM entity
""")
def entity_members(source: Source):
    return open_accounts(stand_ins.intake_tables(source), AFTER_ORDERS).tables["r_custuser_matrix"]


@query(f"""{_INTAKE}
SELECT user_id, (SELECT r_regionkey::BIGINT FROM region WHERE r_name = 'ASIA') AS role_id
FROM users WHERE client IN (SELECT main FROM contract UNION SELECT joint FROM contract)
AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
""")
def owner_roles(source: Source):
    tables = stand_ins.client_tables(source)
    holders = source.customer.where(F.col("c_mktsegment") == "AUTOMOBILE")
    none = F.lit(None)
    tables["r_user_role"] = holders.select(
        F.col("c_custkey").alias("user_role_id"), F.col("c_custkey").alias("user_id"),
        F.lit(0).cast("bigint").alias("role_id"), F.lit("A").alias("status"),
        F.lit("given").alias("created_by"), none.cast("timestamp_ntz").alias("dt_created"),
        none.cast("string").alias("updated_by"), none.cast("timestamp_ntz").alias("dt_updated"),
    )
    roles = investor_roles(tables, AFTER_ORDERS).tables["r_user_role"]
    return roles.where(F.col("created_by") != "given").select("user_id", "role_id")


@query("""
SELECT l_suppkey AS member, max(l_orderkey) AS group_id FROM (
  SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1 HAVING min(l_suppkey) = max(l_suppkey))
GROUP BY 1
""", name="sole_member_group")
def _sole_member_group(source: Source):
    members = source.lineitem.select(F.col("l_orderkey").alias("group_id"), F.col("l_suppkey").alias("member"))
    return sole_member_group(members, "group_id", "member")


_WANTED = """
  SELECT DISTINCT a.l_suppkey AS main, b.l_suppkey AS joint FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = 3 AND b.l_linenumber = 4
"""
_JOINT = """
  SELECT a.l_suppkey AS main, b.l_suppkey AS joint, max(a.l_orderkey) AS group_id FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = 1 AND b.l_linenumber = 2 GROUP BY 1, 2
"""


def _wanted_pairs(source: Source):
    line = lambda n, name: source.lineitem.where(F.col("l_linenumber") == n).select(
        "l_orderkey", F.col("l_suppkey").alias(name)
    ).distinct()
    return line(3, "main").join(line(4, "joint"), "l_orderkey").select("main", "joint").distinct()


@query(f"""
SELECT main, joint, coalesce(group_id, -999) AS group_id FROM ({_WANTED}) LEFT JOIN ({_JOINT}) USING (main, joint)
""", name="joint_group")
def _joint_group(source: Source):
    wanted = _wanted_pairs(source)
    members = source.lineitem.select(
        F.col("l_orderkey").alias("group_id"), F.col("l_suppkey").alias("member"), F.col("l_linenumber").alias("line")
    )
    found = joint_group(
        members, wanted, "group_id", "member", "line", "main", "joint", first_role=1, second_role=2
    )
    both = wanted.join(found, ["main", "joint"], "left")
    return both.select("main", "joint", F.coalesce("group_id", F.lit(-999)).alias("group_id"))


@query(f"""
WITH m AS (SELECT * FROM lineitem WHERE l_linenumber IN (1, 2)),
alone AS (SELECT s AS main, max(l_orderkey) AS entity_id FROM (
  SELECT l_orderkey, min(l_suppkey) AS s FROM m GROUP BY 1 HAVING min(l_suppkey) = max(l_suppkey)) GROUP BY 1)
SELECT lpad(main::VARCHAR, 8, '0') AS main, lpad(joint::VARCHAR, 8, '0') AS joint, coalesce(group_id, -999) AS entity_id
FROM ({_WANTED}) LEFT JOIN ({_JOINT}) USING (main, joint)
UNION ALL
SELECT lpad(s_suppkey::VARCHAR, 8, '0'), NULL, coalesce(entity_id, -999) FROM supplier LEFT JOIN alone ON main = s_suppkey
""")
def entity_lookup(source: Source):
    pairs = _wanted_pairs(source).select(
        stand_ins.client_number("main").alias("main"), stand_ins.client_number("joint").alias("joint")
    )
    singles = source.supplier.select(
        stand_ins.client_number("s_suppkey").alias("main"), F.lit("        ").alias("joint")
    )
    return get_entities(stand_ins.entity_tables(source), pairs.union(singles))


_STAGED = """
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND o_orderdate < TIMESTAMP '1996-01-01'
  JOIN part ON p_partkey = l_partkey AND p_brand = 'Brand#1'
"""


@query(f"""
SELECT DISTINCT p_partkey AS portfolio_id, l_orderkey AS acct_id, p_type AS risk_category_nm, 'EOD-NEWFE' AS created_by
{_STAGED}
""")
def portfolio_rows(source: Source):
    tables = stand_ins.intake_tables(source)
    references = tables["trx_ut"].select(trimmed("e_reference_number").alias("reference")).distinct()
    rows = insert_portfolios(tables, references, AFTER_ORDERS).tables["portfolio"]
    return rows.select("portfolio_id", "acct_id", "risk_category_nm", "created_by")


@query(f"""
SELECT DISTINCT l_partkey || '-' || l_suppkey AS reference {_STAGED}
WHERE l_shipdate > TIMESTAMP '1995-06-01'
""", name="staged_references")
def _staged_references(source: Source):
    return staged_references(stand_ins.intake_tables(source), 19950601)


@query("""
WITH last AS (
  SELECT o_custkey, p_name, p_brand FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC, l_partkey DESC) = 1)
SELECT c_custkey AS acctid, p_name AS beneficial_name, p_brand AS branch_name,
       CASE WHEN o_custkey IS NOT NULL THEN 'EOD-NEWFE' END AS updated_by
FROM customer LEFT JOIN last ON o_custkey = c_custkey
""")
def beneficiary_copy(source: Source):
    tables = stand_ins.beneficiary_tables(source)
    references = tables["trx_ut"].select(trimmed("e_reference_number").alias("reference")).distinct()
    state = copy_beneficiaries(tables, references, AFTER_ORDERS).tables["plan_acct"]
    return state.select("acctid", "beneficial_name", "branch_name", "updated_by")


@query("""
WITH ref AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
own AS (SELECT o_orderkey, o_custkey FROM orders UNION SELECT o_orderkey, 1 FROM orders WHERE o_totalprice > 400000),
n AS (SELECT o_orderkey, count(*) AS accounts, min(o_custkey) AS acctid FROM own WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1),
last AS (
  SELECT acctid, p_name FROM ref JOIN n ON o_orderkey = l_orderkey AND accounts = 1 JOIN part ON p_partkey = l_partkey
  QUALIFY row_number() OVER (PARTITION BY acctid ORDER BY l_orderkey DESC, l_partkey DESC) = 1),
bad AS (SELECT count(*) AS n FROM n WHERE accounts > 1 AND o_orderkey IN (SELECT l_orderkey FROM ref))
SELECT 'account' AS what, c_custkey AS number, p_name AS name FROM customer LEFT JOIN last ON acctid = c_custkey
UNION ALL SELECT 'ambiguous', n, NULL FROM bad
UNION ALL SELECT 'failures', 1, 'updatebeneficialplanacct' FROM bad WHERE n > 0
""")
def beneficiary_ambiguous(source: Source):
    """References that lead to a second account are left out and logged; the others go on."""
    tables = stand_ins.beneficiary_tables(source)
    second = source.orders.where(F.col("o_totalprice") > 400000).select(
        F.rpad(stand_ins.client_number("o_orderkey"), 10, " ").alias("ztranref"), F.lit("2").alias("chdrcoy"), F.lit("1").alias("chdrnum")
    )
    tables["ifsdmutrnpf"] = tables["ifsdmutrnpf"].unionByName(second)
    references = tables["trx_ut"].select(trimmed("e_reference_number").alias("reference")).distinct()
    result = copy_beneficiaries(tables, references, AFTER_ORDERS)
    accounts = result.tables["plan_acct"].select(F.lit("account").alias("what"), F.col("acctid").alias("number"), F.col("beneficial_name").alias("name"))
    bad = result.out["ambiguous_references"].agg(F.count(F.lit(1)).alias("number"))
    log = result.tables["eod_log"].groupBy("eod_proc_name").agg(F.count(F.lit(1)).alias("number"))
    return accounts.unionByName(bad.select(F.lit("ambiguous").alias("what"), "number", F.lit(None).cast("string").alias("name"))).unionByName(
        log.select(F.lit("failures").alias("what"), "number", F.col("eod_proc_name").alias("name"))
    )


@query("""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
SELECT c_custkey, coalesce(o_orderpriority, c_mktsegment) AS c_mktsegment,
       coalesce(o_totalprice, c_acctbal) AS c_acctbal, c_name
FROM customer LEFT JOIN f ON o_custkey = c_custkey AND n = 1
""")
def strict_update(source: Source):
    first = first_rows(source.orders, "o_custkey", ["o_orderdate", "o_orderkey"]).select(
        F.col("o_custkey").alias("c_custkey"), "o_orderpriority", "o_totalprice"
    )
    target = source.customer.select("c_custkey", "c_mktsegment", "c_acctbal", "c_name")
    return update_from(
        target, first, "c_custkey", {"c_mktsegment": "o_orderpriority", "c_acctbal": "o_totalprice"}
    )


@query("""
SELECT o_custkey, o_orderkey, o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
""")
def first_per_key(source: Source):
    orders = source.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return first_rows(orders, "o_custkey", ["o_orderdate", "o_orderkey"])


@query("""
WITH q AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-04'),
asked AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND value > 60)
SELECT user_id::VARCHAR AS user_id, NULL AS login_id, NULL AS email, NULL AS cltaddr01 FROM q
UNION ALL
SELECT user_id::VARCHAR, 'user' || user_id, c_name, c_mktsegment FROM asked JOIN customer ON c_custkey = user_id
WHERE user_id NOT IN (SELECT user_id FROM q)
""")
def request_queue(source: Source):
    queue = queue_password_resets(stand_ins.reset_tables(source), AFTER_EVENTS).tables["r_user_process"]
    return queue.select("user_id", "login_id", "email", "cltaddr01")


_SENT = """
WITH rcpt AS (
  SELECT n_regionkey::BIGINT AS mail_temp_id, c_custkey, lpad(c_custkey::VARCHAR, 8, '0') AS client,
         CASE WHEN c_nationkey = 3 THEN c_name || ' ' || c_mktsegment ELSE c_mktsegment || ' ' || c_name END AS "to"
  FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal > 0),
sent AS (
  SELECT *, (SELECT max(event_id) FROM events) + row_number() OVER (
    ORDER BY substr(md5(mail_temp_id || '|' || client), 1, 3), mail_temp_id, client) AS mail_id
  FROM rcpt JOIN benchmark ON item_id = mail_temp_id)
"""


@query(f"""{_SENT}
SELECT mail_id, c_custkey AS owner_id, "to", text AS message, 'Fund Information' AS subject FROM sent
""")
def mail_out(source: Source):
    mail = mail_annual_report(stand_ins.mailing_tables(source), AFTER_EVENTS).tables["mail"]
    return mail.where(F.col("from") == "SYSTEM").select("mail_id", "owner_id", "to", "message", "subject")


@query(f"""{_SENT}
SELECT mail_id, n_nationkey::BIGINT AS attachment_id FROM sent JOIN nation ON n_regionkey = mail_temp_id
""")
def mail_attachments(source: Source):
    return mail_annual_report(stand_ins.mailing_tables(source), AFTER_EVENTS).tables["mail_dtl"]
