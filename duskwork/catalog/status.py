"""Role sets, status rules, parameters, scalar rules and log rows on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from duskwork.catalog.registry import AFTER_EVENTS, AFTER_ORDERS, Source, query
from duskwork.functions.dates import date_key, stamp_text
from duskwork.functions.text import (
    code, decode, full_name, has_text, joined, padded, piped, trimmed, yes_no,
)
from duskwork.operators.audit import run_log
from duskwork.operators.filters import is_aged
from duskwork.operators.mutate import update_where
from duskwork.operators.roles import activity_actions, minus, role_set, roles_held
from duskwork.plans.refresh import follow_contracts, with_facts
from duskwork.sources.params import param, set_param


@query("""
SELECT user_id, CAST(ts AS DATE) AS day FROM events GROUP BY 1, 2
HAVING count(DISTINCT event_type) = 2 AND bool_or(event_type = 'click') AND bool_or(event_type = 'view')
""")
def role_set_exact(source: Source):
    daily = source.events.withColumn("day", F.to_date("ts"))
    return role_set(daily, ["user_id", "day"], "event_type", ["click", "view"])


@query("""
SELECT user_id, CAST(ts AS DATE) AS day FROM events GROUP BY 1, 2 HAVING count(DISTINCT event_type) = 2
""")
def two_roles(source: Source):
    daily = source.events.withColumn("day", F.to_date("ts"))
    return roles_held(daily, ["user_id", "day"], "event_type", 2)


@query("""
SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000
""")
def minus_chain(source: Source):
    customers = lambda condition: source.orders.where(condition).select("o_custkey")
    return minus(
        customers(F.col("o_orderstatus") == "P"), customers(F.col("o_orderpriority") == "1-URGENT"),
        customers(F.col("o_totalprice") > 400000),
    )


@query("""
WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderdate > TIMESTAMP '2001-01-01'),
u AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'I' ELSE 'A' END AS was, o_custkey IS NOT NULL AS busy
      FROM customer LEFT JOIN a ON o_custkey = c_custkey)
SELECT c_custkey, CASE WHEN NOT busy THEN 'I' ELSE was END AS status,
       CASE WHEN busy AND was = 'I' THEN 'Y' ELSE 'N' END AS pwd_regen_flag
FROM u
""")
def user_status(source: Source):
    busy = source.orders.where(
        F.col("o_orderstatus").isin("O", "P") & (F.col("o_orderdate") > F.lit("2001-01-01").cast("timestamp_ntz"))
    ).select(F.col("o_custkey").alias("c_custkey"))
    users = source.customer.select(
        "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", "I").otherwise("A").alias("status"),
        F.lit("N").alias("pwd_regen_flag"),
    )
    state = with_facts(users, {"busy": busy}, "c_custkey")
    reset, stop = activity_actions(F.col("status"), F.lit(True), F.col("busy"))
    state = update_where(state, reset, {"pwd_regen_flag": F.lit("Y")})
    return update_where(state, stop, {"status": F.lit("I")}).drop("busy")


@query("""
WITH f AS (SELECT l_orderkey,
             bool_or(l_linestatus <> 'F' AND l_shipdate > TIMESTAMP '2001-06-01') AS closed,
             bool_or(l_returnflag = 'N' AND l_shipdate > TIMESTAMP '2001-09-01') AS active
           FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN active AND (closed OR o_orderstatus = 'I') THEN 'A' WHEN closed THEN 'I' ELSE o_orderstatus END AS status,
       CASE WHEN active AND (closed OR o_orderstatus = 'I') THEN 'B' WHEN closed THEN 'A' END AS updated_by
FROM orders LEFT JOIN f ON l_orderkey = o_orderkey
""")
def plan_refresh(source: Source):
    accounts = source.orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.lit(None).cast("string").alias("updated_by"),
        F.lit(None).cast("timestamp_ntz").alias("dt_updated"),
    )
    contracts = source.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    after = lambda day: F.col("l_shipdate") > F.lit(day).cast("timestamp_ntz")
    state = follow_contracts(
        accounts, contracts, (F.col("l_linestatus") != "F") & after("2001-06-01"),
        (F.col("l_returnflag") == "N") & after("2001-09-01"), AFTER_ORDERS,
        on=("o_orderkey",), stop_by="A", restart_by="B",
    )
    return state.drop("dt_updated")


@query("""
SELECT n_nationkey, n_name, count(*) AS customers FROM nation JOIN customer ON c_nationkey = n_nationkey
WHERE n_regionkey = (SELECT r_regionkey FROM region WHERE r_name = 'ASIA') GROUP BY 1, 2
""")
def param_lookup(source: Source):
    region = int(param(source.region, "ASIA", code_col="r_name", value_col="r_regionkey"))
    nations = source.nation.where(F.col("n_regionkey") == region)
    counted = source.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    return nations.join(counted, "n_nationkey").select("n_nationkey", "n_name", "customers")


@query("""
SELECT c_name AS param_code, CASE WHEN c_name = 'Customer#000000007' THEN '20010208' ELSE c_mktsegment END AS value
FROM customer
""")
def param_update(source: Source):
    params = source.customer.select(F.col("c_name").alias("param_code"), F.col("c_mktsegment").alias("value"))
    return set_param(params, "Customer#000000007", AFTER_ORDERS.strftime("%Y%d%m"))


@query("""
SELECT c_custkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' END AS kind,
       coalesce(CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' END, '-') AS kind_or_dash,
       CASE WHEN c_nationkey = 3 THEN c_name || ' ' || c_mktsegment ELSE c_mktsegment || ' ' || c_name END AS full_name,
       rpad(c_mktsegment, 8, ' ') AS code_8, rtrim(rpad(c_mktsegment, 8, ' ')) AS code,
       CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS has_email,
       coalesce(CASE WHEN c_acctbal > 0 THEN c_name END, '') || '/' || c_mktsegment AS label,
       c_custkey || '|' || coalesce(CASE WHEN c_acctbal > 0 THEN c_name END, '') || '|' || c_mktsegment AS piped,
       nullif(trim(CASE WHEN c_acctbal > 0 THEN '  ' || c_name || ' ' ELSE '    ' END), '') AS trimmed,
       instr(c_name, '#') > 0 AS has_number
FROM customer
""")
def scalar_strings(source: Source):
    segment, name = F.col("c_mktsegment"), F.col("c_name")
    email = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("  "), name, F.lit(" "))).otherwise("    ")
    kind = decode(segment, [("BUILDING", "B"), ("MACHINERY", "M")])
    rich_name = F.when(F.col("c_acctbal") > 0, name)
    race = F.when(F.col("c_nationkey") == 3, "CHI").otherwise("OTH")
    frame = source.customer.withColumn("__race", race)
    return frame.select(
        "c_custkey", kind.alias("kind"), F.coalesce(kind, F.lit("-")).alias("kind_or_dash"),
        full_name("__race", "c_name", "c_mktsegment").alias("full_name"),
        padded(segment).alias("code_8"), code(padded(segment)).alias("code"),
        yes_no(has_text(email)).alias("has_email"), joined(rich_name, "/", segment).alias("label"),
        piped(F.col("c_custkey"), rich_name, segment).alias("piped"), trimmed(email).alias("trimmed"),
        F.contains(name, F.lit("#")).alias("has_number"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::INTEGER AS date_key,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(o_orderdate, '%Y%d%m') AS day_before_month,
       strftime(o_orderdate, '%Y%m%d')::INTEGER > 20000229 AS open_after,
       o_orderdate <= TIMESTAMP '2001-08-02' - INTERVAL 36 HOUR AS aged,
       o_orderdate - INTERVAL 5 DAY AS mark, greatest(o_orderdate, TIMESTAMP '1990-01-01') AS since
FROM orders
""")
def scalar_dates(source: Source):
    day = F.col("o_orderdate")
    return source.orders.select(
        "o_orderkey", date_key(day).alias("date_key"), stamp_text(day).alias("stamp"),
        F.date_format(day, "yyyyddMM").alias("day_before_month"),
        (date_key(day) > 20000229).alias("open_after"), is_aged(day, 1.5, AFTER_ORDERS).alias("aged"),
        (day - F.make_dt_interval(F.lit(5))).alias("mark"),
        F.greatest(day, F.lit("1990-01-01").cast("timestamp_ntz")).alias("since"),
    )


@query("""
SELECT event_type || ' ' || strftime(ts, '%Y%m%d') AS eod_proc_name, TIMESTAMP '2024-01-31' AS eod_date,
       CASE WHEN max(value) > 200 THEN 'F' ELSE 'S' END AS status, TIMESTAMP '2024-01-31' AS dt_created,
       'EOD_PROCESS' AS created_by, CASE WHEN max(value) > 200 THEN count(*) || ' rows' END AS remarks
FROM events GROUP BY event_type, strftime(ts, '%Y%m%d')
""")
def run_log_rows(source: Source):
    runs = source.events.groupBy("event_type", date_key(F.col("ts")).alias("day")).agg(
        (F.max("value") > 200).alias("failed"), F.count(F.lit(1)).alias("n")
    )
    outcomes = runs.select(
        joined(F.col("event_type"), " ", F.col("day")).alias("job"),
        F.when(F.col("failed"), "F").otherwise("S").alias("status"),
        F.when(F.col("failed"), joined(F.col("n"), " rows")).alias("error"),
    )
    return run_log(outcomes, "job", "status", AFTER_EVENTS, "error")
