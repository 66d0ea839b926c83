"""The refresh jobs on the given tables."""

from __future__ import annotations

from duskwork.catalog import stand_ins
from duskwork.catalog.registry import AFTER_ORDERS, Source, query
from duskwork.plans.descriptions import refresh_descriptions, refresh_notes
from duskwork.plans.refresh import refresh_accounts, refresh_users

_COMPANY = "CASE o_orderstatus WHEN 'F' THEN '2' WHEN 'O' THEN '3' ELSE '1' END"


@query("""
SELECT o_orderkey AS acctid,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN 'I'
            WHEN o_totalprice > 250000 AND o_orderstatus = 'P' THEN 'I' ELSE 'A' END AS status,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN 'REFRESH PLANACCT A'
            WHEN o_totalprice > 250000 AND o_orderstatus <> 'P' THEN 'REFRESH PLANACCT B' END AS updated_by
FROM orders
""")
def account_refresh(source: Source):
    state = refresh_accounts(stand_ins.refresh_tables(source), AFTER_ORDERS).tables["plan_acct"]
    return state.select("acctid", "status", "updated_by")


@query(f"""
WITH u AS (
  SELECT c_custkey AS user_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'I' WHEN 'MACHINERY' THEN 'R' ELSE 'A' END AS status,
         c_acctbal >= 0 AS web, c_mktsegment <> 'HOUSEHOLD' AS external FROM customer),
ag AS (
  SELECT s_suppkey * 10 AS user_id, s_suppkey, CASE WHEN s_nationkey < 12 THEN '2' ELSE '3' END AS coy,
         CASE r_name WHEN 'ASIA' THEN 'V' WHEN 'EUROPE' THEN 'I' ELSE 'M' END AS kind, s_acctbal > 3000 AS live
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
k AS (
  SELECT {_COMPANY} AS coy, o_custkey, lowest FROM orders
  LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS lowest FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
  WHERE o_orderpriority = '1-URGENT'),
act AS (SELECT * FROM k WHERE coy IN ('2', '3')),
own AS (SELECT o_custkey AS user_id FROM act UNION SELECT lowest FROM act WHERE lowest IS NOT NULL),
held AS (
  SELECT DISTINCT o_custkey AS user_id, CASE o_orderstatus WHEN 'F' THEN 'V' WHEN 'O' THEN 'I' ELSE 'M' END AS kind FROM orders),
facts AS (
  SELECT u.*, web AND external AS ok, user_id IN (SELECT user_id FROM own) AS owned,
    user_id IN (SELECT user_id FROM ag WHERE kind = 'M' AND live) AS m_live,
    user_id IN (SELECT user_id FROM ag WHERE kind = 'M' AND NOT live)
      AND user_id NOT IN (SELECT user_id FROM ag WHERE live) AS m_ended,
    user_id IN (SELECT user_id FROM ag WHERE live AND s_suppkey IN (SELECT lowest FROM act WHERE lowest IS NOT NULL)) AS served,
    (SELECT count(*) FROM held h WHERE h.user_id = u.user_id) AS kinds,
    user_id IN (SELECT user_id FROM held WHERE kind = 'V') AS v, user_id IN (SELECT user_id FROM held WHERE kind = 'I') AS i,
    user_id IN (SELECT user_id FROM ag WHERE live AND kind = 'V')
      AND user_id NOT IN (SELECT user_id FROM ag WHERE live AND kind <> 'V') AS only_v,
    user_id IN (SELECT ag.user_id FROM ag JOIN k ON k.lowest = s_suppkey AND k.coy = ag.coy WHERE live) AS serves_live
  FROM u),
a AS (SELECT *, NOT web AND status <> 'I' AS a2 FROM facts),
b AS (SELECT * REPLACE (CASE WHEN a2 THEN 'I' ELSE status END AS status) FROM a),
c AS (SELECT *, ok AND m_live AND status = 'I' AS b1, ok AND m_ended AND status = 'A' AND NOT owned AS b2 FROM b),
d AS (SELECT * REPLACE (CASE WHEN b2 THEN 'I' ELSE status END AS status), ok AND kinds = 2 AND v AND i AS in_c FROM c),
e AS (SELECT *, in_c AND (served OR owned) AND status = 'I' AS c1, in_c AND NOT (served OR owned) AND status <> 'I' AS c2 FROM d),
f AS (SELECT * REPLACE (CASE WHEN c2 THEN 'I' ELSE status END AS status), ok AND only_v AND NOT i AS in_d FROM e),
g AS (SELECT *, in_d AND serves_live AND status = 'I' AS d1, in_d AND NOT serves_live AND status <> 'I' AS d2 FROM f),
h AS (SELECT * REPLACE (CASE WHEN d2 THEN 'I' ELSE status END AS status),
             ok AND i AND NOT (external AND kinds > 1) AS in_e FROM g),
z AS (SELECT *, in_e AND owned AND status = 'I' AS e1, in_e AND NOT owned AND status <> 'I' AS e2 FROM h)
SELECT user_id, CASE WHEN e2 THEN 'I' ELSE status END AS status,
       CASE WHEN b1 OR c1 OR d1 OR e1 THEN 'Y' ELSE 'N' END AS pwd_regen_flag,
       'REFRESH USR ' || CASE WHEN e1 OR e2 THEN '2E' WHEN d1 OR d2 THEN '2D' WHEN c1 OR c2 THEN '2C' WHEN b2 THEN '2B-ii'
                              WHEN b1 THEN '2B' WHEN a2 THEN '2A' END AS updated_by
FROM z
""")
def user_refresh(source: Source):
    state = refresh_users(stand_ins.refresh_tables(source), AFTER_ORDERS).tables["r_user"]
    return state.select("user_id", "status", "pwd_regen_flag", "updated_by")


@query("""
WITH brand AS (SELECT 'B' || split_part(p_brand, '#', 2) AS crtable, max(p_retailprice) AS top FROM part GROUP BY 1),
frequency AS (SELECT DISTINCT substr(o_orderpriority, 1, 1) AS billfreq FROM orders),
item AS (
  SELECT DISTINCT 'EX' || substr(o_orderpriority, 1, 1) || o_orderstatus || '1' AS item FROM orders
  UNION SELECT DISTINCT 'EX**' || CASE WHEN p_size > 25 THEN 'F' ELSE '-' END || substr(p_type, 1, 2) FROM part),
k AS (
  SELECT crtable, billfreq, chdrcoy,
         CASE WHEN chdrcoy = '1' THEN CASE WHEN top > 1000 THEN 'F' ELSE 'O' END ELSE '-' END AS ind
  FROM brand, frequency, (VALUES ('1'), ('2'), ('3')) c(chdrcoy)),
p AS (
  SELECT *, CASE WHEN EXISTS (SELECT 1 FROM item WHERE item LIKE 'EX' || billfreq || ind || '%')
                 THEN 'EX' || billfreq || ind || '%' ELSE 'EX**' || ind || '%' END AS pattern FROM k),
s AS (SELECT chdrcoy, billfreq, crtable, item AS noteitem, 'text of ' || item AS notedesc FROM p JOIN item ON item LIKE pattern)
SELECT * FROM s UNION ALL
SELECT '1', '1', crtable, 'EX1F1', 'old' FROM brand b WHERE NOT EXISTS (
  SELECT 1 FROM s WHERE s.chdrcoy = '1' AND s.billfreq = '1' AND s.crtable = b.crtable AND s.noteitem = 'EX1F1')
""")
def note_refresh(source: Source):
    return refresh_notes(stand_ins.note_tables(source), AFTER_ORDERS).tables["r_explanatory_notes"]


@query("""
WITH line AS (
  SELECT l_orderkey, l_partkey, l_returnflag AS unityp, 'T' || l_linestatus AS batctrcde, 'S' || l_linenumber AS sacstyp,
         l_shipdate FROM lineitem),
k AS (
  SELECT DISTINCT 'C' || substr(o_orderpriority, 1, 1) AS cnttype, unityp, batctrcde, sacstyp FROM orders JOIN (
    SELECT DISTINCT a.l_orderkey, a.unityp, b.batctrcde, b.sacstyp FROM line a JOIN line b USING (l_orderkey, l_partkey)
    UNION SELECT l_orderkey, 'Z', batctrcde, sacstyp FROM line WHERE unityp = 'N') ON l_orderkey = o_orderkey),
item AS (
  SELECT DISTINCT 'x' || batctrcde || sacstyp || unityp AS item FROM line
  UNION SELECT DISTINCT '****' || sacstyp || unityp FROM line),
pointer AS (
  SELECT DISTINCT 'T' || o_orderstatus || 'C' || substr(o_orderpriority, 1, 1) || 'A' AS item
  FROM orders),
s AS (
  SELECT k.*, CASE
    WHEN batctrcde || sacstyp = 'TFS1' AND EXISTS (SELECT 1 FROM pointer WHERE item LIKE '%' || batctrcde || cnttype || unityp || '%')
      THEN 'text of TARGET77'
    ELSE coalesce(
      (SELECT 'text of ' || min(item) FROM item WHERE item LIKE '%' || batctrcde || sacstyp || unityp || '%'),
      (SELECT 'text of ' || min(item) FROM item WHERE item LIKE '%****' || sacstyp || unityp || '%'),
      (SELECT 'text of ' || min(item) FROM item WHERE item LIKE '%****' || sacstyp || '%'),
      CASE WHEN batctrcde = 'TO' THEN 'ASIA' END) END AS trandesc
  FROM k)
SELECT * FROM s UNION ALL
SELECT DISTINCT 'C' || substr(o_orderpriority, 1, 1), 'A', 'TF', 'S7', 'old' FROM orders WHERE NOT EXISTS (
  SELECT 1 FROM s WHERE cnttype = 'C' || substr(o_orderpriority, 1, 1) AND unityp = 'A' AND batctrcde = 'TF' AND sacstyp = 'S7')
""")
def description_refresh(source: Source):
    return refresh_descriptions(stand_ins.description_tables(source), AFTER_ORDERS).tables["r_trx_description"]
