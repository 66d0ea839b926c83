"""Alerts, joins, lookups and code tables on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from duskwork.catalog.registry import AFTER_ORDERS, Source, query
from duskwork.functions.text import like_pattern
from duskwork.operators.joins import all_combinations, either_owner_join, pattern_matches
from duskwork.operators.joins import derived_key_join as key_join
from duskwork.operators.lookup import Step, choose_pattern
from duskwork.operators.lookup import cascade_lookup as cascade
from duskwork.operators.lookup import chunk_scan as scan_segments
from duskwork.operators.mutate import merge_upsert as upsert
from duskwork.operators.mutate import move_rows
from duskwork.operators.roles import union_distinct
from duskwork.plans.alerts import alert_by_account, alert_by_fund
from duskwork.plans.alerts import band_alert as alerts_outside


@query("""
SELECT c_custkey, value FROM customer JOIN (
  SELECT user_id, value FROM events QUALIFY rank() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
ON user_id = c_custkey WHERE value <= 5 OR value >= 50
""")
def band_alert(source: Source):
    alerts = source.customer.select("c_custkey", F.lit(5.0).alias("floor"), F.lit(50.0).alias("ceiling"))
    rows = alerts_outside(alerts, source.events, "c_custkey", "user_id", when="ts", value="value")
    return rows.select("c_custkey", "value")


@query("""
SELECT c_custkey, o_totalprice FROM customer JOIN (
  SELECT o_custkey, o_totalprice FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1)
ON o_custkey = c_custkey
WHERE o_totalprice <= 20000 OR o_totalprice >= CASE WHEN c_mktsegment = 'BUILDING' THEN 450000 ELSE 480000 END
""")
def band_alert_account(source: Source):
    ceiling = F.when(F.col("c_mktsegment") == "BUILDING", 450000.0).otherwise(480000.0)
    alerts = source.customer.select("c_custkey", F.lit(20000.0).alias("floor"), ceiling.alias("ceiling"))
    rows = alerts_outside(alerts, source.orders, "c_custkey", "o_custkey", when="o_orderdate", value="o_totalprice")
    return rows.select("c_custkey", "o_totalprice")


@query("""
SELECT r_name, l_orderkey, l_linenumber, s_suppkey, c_custkey
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = n_nationkey
""")
def multi_join(source: Source):
    c, o, li, s = source.customer, source.orders, source.lineitem, source.supplier
    n, r = source.nation, source.region
    joined = (
        li.join(s, li.l_suppkey == s.s_suppkey).join(o, li.l_orderkey == o.o_orderkey)
        .join(c, (c.c_custkey == o.o_custkey) & (c.c_nationkey == s.s_nationkey))
        .join(n, n.n_nationkey == c.c_nationkey).join(r, r.r_regionkey == n.n_regionkey)
    )
    return joined.select("r_name", "l_orderkey", "l_linenumber", "s_suppkey", "c_custkey")


@query("""
SELECT c_name, o_orderkey FROM customer JOIN orders
ON trim(split_part(c_name, '#', 2)) = lpad(o_custkey::VARCHAR, 9, '0')
""")
def derived_key_join(source: Source):
    left = source.customer.select("c_name")
    right = source.orders.select("o_orderkey", "o_custkey")
    number = F.trim(F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)))
    rows = key_join(left, right, number, F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    return rows.select("c_name", "o_orderkey")


_EITHER = """
  SELECT p_partkey, l_orderkey FROM part JOIN lineitem ON l_partkey = p_partkey
  UNION ALL SELECT p_partkey, l_orderkey FROM part JOIN lineitem ON l_suppkey = p_partkey AND l_suppkey <> l_partkey
"""


@query(f"SELECT p_partkey, l_orderkey FROM ({_EITHER})", name="either_owner_join")
def _either_owner(source: Source):
    lines = source.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    rows = either_owner_join(lines, source.part.select("p_partkey"), ["l_partkey", "l_suppkey"], "p_partkey")
    return rows.select("p_partkey", "l_orderkey")


@query(f"""
SELECT p_partkey, count(DISTINCT l_orderkey) AS orders FROM part LEFT JOIN ({_EITHER}) USING (p_partkey) GROUP BY 1
""")
def owned_count(source: Source):
    lines = source.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    parts = source.part.select("p_partkey")
    owned = either_owner_join(lines, parts, ["l_partkey", "l_suppkey"], "p_partkey")
    counts = owned.groupBy("p_partkey").agg(F.countDistinct("l_orderkey").alias("orders"))
    return parts.join(counts, "p_partkey", "left").select("p_partkey", F.coalesce("orders", F.lit(0)).alias("orders"))


@query("""
SELECT r_name, c_mktsegment, o_orderstatus FROM region,
  (SELECT DISTINCT c_mktsegment FROM customer), (SELECT DISTINCT o_orderstatus FROM orders)
""")
def crossed_keys(source: Source):
    segments = source.customer.select("c_mktsegment").distinct()
    statuses = source.orders.select("o_orderstatus").distinct()
    return all_combinations(all_combinations(source.region.select("r_name"), segments), statuses)


@query("""
WITH k AS (SELECT p_brand, r_regionkey, '%' || p_brand || r_regionkey || '%' AS specific, '%' || p_brand || '%' AS generic
           FROM (SELECT DISTINCT p_brand FROM part), region),
chosen AS (SELECT k.*, CASE WHEN EXISTS (SELECT 1 FROM part p WHERE p.p_brand LIKE specific)
                            THEN specific ELSE generic END AS pattern FROM k)
SELECT c.p_brand, c.r_regionkey, pattern, count(*) AS parts, max(p.p_partkey) AS last_part
FROM chosen c JOIN part p ON p.p_brand LIKE pattern GROUP BY ALL
""")
def pattern_fallback(source: Source):
    brands = source.part.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.max("p_partkey").alias("last")
    )
    keys = all_combinations(brands.select("p_brand"), source.region.select("r_regionkey")).select(
        "p_brand", "r_regionkey",
        like_pattern("%", F.col("p_brand"), F.col("r_regionkey"), "%").alias("specific"),
        like_pattern("%", F.col("p_brand"), "%").alias("generic"),
    )
    lookup = brands.withColumnRenamed("p_brand", "item")
    chosen, pairs = choose_pattern(keys, "specific", "generic", lookup, "item", "pattern")
    found = chosen.join(pairs, "pattern").join(lookup, "item")
    return found.groupBy("p_brand", "r_regionkey", "pattern").agg(
        F.sum("n").alias("parts"), F.max("last").alias("last_part")
    )


@query("""
WITH t AS (SELECT DISTINCT left(p_type, p_size % 7) AS item FROM part),
p AS (SELECT DISTINCT repeat('_', p_size % 9) || CASE WHEN p_partkey % 3 = 0 THEN '%' ELSE '' END AS pattern FROM part
      UNION SELECT DISTINCT '%' || left(p_type, p_size % 3) || '%_' FROM part)
SELECT pattern, count(*) AS items, min(item) AS first_item FROM p JOIN t ON item LIKE pattern GROUP BY 1
""")
def wildcard_patterns(source: Source):
    """Patterns of wildcards alone, which no literal piece can be looked up for, among others."""
    part = source.part
    tail = F.when(F.col("p_partkey") % 3 == 0, "%").otherwise("")
    blanks = part.select(F.concat(F.repeat(F.lit("_"), F.col("p_size") % 9), tail).alias("pattern"))
    short = part.select(F.concat(F.lit("%"), F.substring(F.col("p_type"), F.lit(1), F.col("p_size") % 3), F.lit("%_")))
    texts = part.select(F.substring(F.col("p_type"), F.lit(1), F.col("p_size") % 7).alias("item"))
    return pattern_matches(blanks.union(short), "pattern", texts, "item").groupBy("pattern").agg(
        F.count(F.lit(1)).alias("items"), F.min("item").alias("first_item")
    )


@query("""
WITH t AS (SELECT DISTINCT p_size || '%_' || p_brand AS item FROM part),
p AS (SELECT DISTINCT '%\\%\\_' || p_brand || '%' AS pattern FROM part UNION SELECT DISTINCT p_size || '\\%%' FROM part)
SELECT pattern, count(*) AS items, min(item) AS first_item FROM p JOIN t ON item LIKE pattern ESCAPE '\\' GROUP BY 1
""")
def escaped_patterns(source: Source):
    part = source.part
    texts = part.select(F.concat(F.col("p_size").cast("string"), F.lit("%_"), "p_brand").alias("item"))
    patterns = part.select(F.concat(F.lit("%\\%\\_"), "p_brand", F.lit("%")).alias("pattern")).union(
        part.select(F.concat(F.col("p_size").cast("string"), F.lit("\\%%")))
    )
    return pattern_matches(patterns, "pattern", texts, "item").groupBy("pattern").agg(
        F.count(F.lit(1)).alias("items"), F.min("item").alias("first_item")
    )


@query("""
WITH p AS (SELECT l_suppkey, l_extendedprice, rank() OVER (PARTITION BY l_suppkey ORDER BY CAST(l_shipdate AS DATE) DESC) AS n FROM lineitem)
SELECT s_suppkey AS fund_alert_id, s_nationkey AS user_id, 20000.0 AS floor, 80000.0 AS ceiling, l_extendedprice AS ubidpr
FROM supplier JOIN p ON l_suppkey = s_suppkey WHERE n = 1 AND (l_extendedprice <= 20000 OR l_extendedprice >= 80000)
""", name="alert_by_fund")
def _alert_by_fund(source: Source):
    tables = {
        "fund_alert": source.supplier.select(
            F.col("s_suppkey").alias("fund_alert_id"), F.col("s_nationkey").alias("user_id"),
            F.lit(20000.0).alias("floor"), F.lit(80000.0).alias("ceiling"),
        ),
        "ifsdmvprcpf": source.lineitem.select(
            F.col("l_suppkey").alias("vrtfnd"), F.col("l_extendedprice").alias("ubidpr"),
            F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("effdate"),
        ),
    }
    return alert_by_fund(tables, AFTER_ORDERS).out["alerts"]


@query("""
WITH p AS (SELECT o_custkey, o_totalprice, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS n FROM orders)
SELECT c_custkey AS acct_id, c_nationkey AS user_id, c_acctbal * 10 AS floor, 400000.0 AS ceiling, o_totalprice AS ubidpr
FROM customer JOIN p ON o_custkey = c_custkey WHERE n = 1 AND (o_totalprice <= c_acctbal * 10 OR o_totalprice >= 400000)
""", name="alert_by_account")
def _alert_by_account(source: Source):
    tables = {
        "acct_alert": source.customer.select(
            F.col("c_custkey").alias("acct_id"), F.col("c_nationkey").alias("user_id"),
            (F.col("c_acctbal") * 10).alias("floor"), F.lit(400000.0).alias("ceiling"),
        ),
        "account_value": source.orders.select(
            F.col("o_custkey").alias("acct_id"), F.col("o_totalprice").alias("ubidpr"), F.col("o_orderdate").alias("effdate"),
        ),
    }
    return alert_by_account(tables, AFTER_ORDERS).out["alerts"]


@query("""
WITH poor AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
SELECT o_orderkey, o_custkey, o_custkey IN (SELECT c_custkey FROM poor) AS archived FROM orders
""", name="move_rows")
def _move_rows(source: Source):
    orders = source.orders.select("o_orderkey", "o_custkey")
    poor = source.customer.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    kept, archive = move_rows(orders, orders.limit(0), poor, "o_custkey")
    return kept.withColumn("archived", F.lit(False)).unionByName(archive.withColumn("archived", F.lit(True)))


@query("""
WITH t AS (SELECT p_brand, p_type, min(p_size) AS size, 'kept' AS origin FROM part WHERE p_size <= 15 GROUP BY 1, 2),
s AS (SELECT p_brand, p_type, max(p_size) AS size FROM part WHERE p_size > 40 GROUP BY 1, 2)
SELECT coalesce(t.p_brand, s.p_brand) AS p_brand, coalesce(t.p_type, s.p_type) AS p_type,
       coalesce(s.size, t.size) AS size,
       CASE WHEN t.origin IS NULL THEN 'inserted' WHEN s.size IS NULL THEN 'kept' ELSE 'updated' END AS origin
FROM t FULL JOIN s ON t.p_brand = s.p_brand AND t.p_type = s.p_type
""")
def merge_upsert(source: Source):
    part, on = source.part, ["p_brand", "p_type"]
    target = part.where(F.col("p_size") <= 15).groupBy(*on).agg(
        F.min("p_size").alias("size")).withColumn("origin", F.lit("kept"))
    rows = part.where(F.col("p_size") > 40).groupBy(*on).agg(F.max("p_size").alias("size"))
    changes = {"size": F.col("size"), "origin": F.lit("updated")}
    return upsert(target, rows, on, changes, {**{c: F.col(c) for c in [*on, "size"]}, "origin": F.lit("inserted")})


@query("""
WITH k AS (SELECT DISTINCT p_brand, p_type, p_size FROM part),
d AS (SELECT * FROM part WHERE p_name LIKE 'red %'),
a AS (SELECT p_brand, p_type, p_size, arg_min(p_name, p_partkey) AS v FROM d GROUP BY ALL),
b AS (SELECT p_brand, p_type, arg_min(p_name, p_partkey) AS v FROM d GROUP BY ALL),
c AS (SELECT p_brand, p_size, arg_min(p_name, p_partkey) AS v FROM d GROUP BY ALL)
SELECT k.*, coalesce(a.v, b.v, c.v) AS found,
       CASE WHEN a.v IS NOT NULL THEN 1 WHEN b.v IS NOT NULL THEN 2 WHEN c.v IS NOT NULL THEN 3 END AS step
FROM k LEFT JOIN a USING (p_brand, p_type, p_size) LEFT JOIN b USING (p_brand, p_type) LEFT JOIN c USING (p_brand, p_size)
""")
def cascade_lookup(source: Source):
    keys = source.part.select("p_brand", "p_type", "p_size").distinct()
    named = source.part.where(F.col("p_name").startswith("red "))
    steps = [
        Step(named, on, F.col("p_name"), ("p_partkey",))
        for on in (("p_brand", "p_type", "p_size"), ("p_brand", "p_type"), ("p_brand", "p_size"))
    ]
    return cascade(keys, steps, "found", "step")


@query("""
SELECT doc_id, i::INTEGER AS segment, substring(text, (i - 1) * 78 + 1, 8) AS code
FROM documents, LATERAL (SELECT unnest(range(1, greatest(1, ceil(length(text) / 78.0))::BIGINT + 1)) AS i)
WHERE contains(substring(text, (i - 1) * 78 + 1, 78), 'the')
""")
def chunk_scan(source: Source):
    texts = source.documents.select("doc_id", "text")
    return scan_segments(texts, "text", "the").select("doc_id", "segment", "code")


@query("""
SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9900
UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 9500
""")
def owners_union(source: Source):
    return union_distinct(
        source.customer.where(F.col("c_acctbal") > 9900).select(F.col("c_nationkey").alias("nation")),
        source.supplier.where(F.col("s_acctbal") > 9500).select(F.col("s_nationkey").alias("nation")),
    )
