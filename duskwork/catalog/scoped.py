"""Partition-scoped changes, maintained states and resumable nights on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.catalog import stand_ins
from duskwork.catalog.intake import _INTAKE
from duskwork.catalog.registry import AFTER_ORDERS, Source, query
from duskwork.operators.durable import reuse, scratch_folder
from duskwork.operators.latest import maintain_latest
from duskwork.operators.roles import role_sets
from duskwork.operators.sequences import SEQUENCES, sequence_table
from duskwork.plans.alerts import alert_by_fund
from duskwork.plans.intake import USER_KEYS, new_investors
from duskwork.sources import bucketed, files
from duskwork.sources.bucketed import BUCKET, Layout
from duskwork.sources.clustered import PERIOD, changed_since, read_clustered, write_clustered


def _laid_out(source: Source, df: DataFrame, key: str, digits: int = 1) -> Layout:
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    layout = Layout(scratch_folder(source.spark, key), (key,), schema, digits)
    bucketed.lay_out(df, layout)
    return layout


_OLD_PENDING = "o_orderstatus = 'P' AND o_orderdate <= TIMESTAMP '1996-02-01'"
_RETURNED = "EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')"


def _old_pending(source: Source) -> DataFrame:
    return source.orders.where(
        (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") <= F.lit("1996-02-01").cast("timestamp_ntz"))
    ).select("o_orderkey")


@query(f"""
SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN {_OLD_PENDING} THEN 'X' ELSE o_orderstatus END AS o_orderstatus
FROM orders WHERE NOT ({_OLD_PENDING} AND {_RETURNED})
""")
def scoped_update(source: Source):
    """Old pending orders with a returned line are deleted, the others marked, in their buckets only."""
    orders = source.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    layout, old = _laid_out(source, orders, "o_orderkey"), _old_pending(source)
    returned = source.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    doomed = old.join(returned.distinct(), "o_orderkey", "left_semi")
    bucketed.delete_keys_in(source.spark, layout, doomed, "delete")
    return bucketed.update_keys_in(source.spark, layout, old, {"o_orderstatus": F.lit("X")}, "mark").table.drop(BUCKET)


_SPENT = """
  SELECT o_custkey + 7 AS k, sum(o_totalprice) AS spent, max(o_orderpriority) AS p FROM orders
  WHERE o_orderdate >= TIMESTAMP '2001-07-25' GROUP BY 1
"""


@query(f"""
SELECT c_custkey, coalesce(spent, c_acctbal) AS c_acctbal, CASE WHEN k IS NULL THEN c_mktsegment ELSE p END AS c_mktsegment
FROM customer LEFT JOIN ({_SPENT}) ON k = c_custkey
UNION ALL SELECT k, NULL, p FROM ({_SPENT}) WHERE k NOT IN (SELECT c_custkey FROM customer)
""")
def scoped_merge(source: Source):
    """Customers merged with what was lately spent, bucket by bucket."""
    layout = _laid_out(source, source.customer.select("c_custkey", "c_acctbal", "c_mktsegment"), "c_custkey")
    late = source.orders.where(F.col("o_orderdate") >= F.lit("2001-07-25").cast("timestamp_ntz"))
    spent = late.groupBy((F.col("o_custkey") + 7).alias("c_custkey")).agg(
        F.sum("o_totalprice").alias("spent"), F.max("o_orderpriority").alias("p")
    )
    update = {"c_acctbal": F.col("spent"), "c_mktsegment": F.col("p")}
    insert = {"c_custkey": F.col("c_custkey"), "c_mktsegment": F.col("p")}
    return bucketed.merge_in(source.spark, layout, spent, update, insert, "merge").table.drop(BUCKET)


@query(f"""
SELECT 'b' || substr(md5(o_orderkey::VARCHAR), 1, 2) AS key_bucket, count(*) AS orders, bool_or({_OLD_PENDING}) AS rewritten
FROM orders GROUP BY 1
""")
def scoped_files(source: Source):
    """Which buckets got new files by an update: those of its keys and no other."""
    layout = _laid_out(source, source.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", 2)
    before = set(files.data_files(source.spark, layout.folder))
    table = bucketed.update_keys_in(source.spark, layout, _old_pending(source), {"o_orderstatus": F.lit("X")}, "mark").table
    name = lambda path: "/".join(path.split("/")[-2:])
    known = source.spark.createDataFrame([(name(f), True) for f in sorted(before)], "file string, old boolean")
    file = F.concat(F.lit(f"{BUCKET}="), F.col(BUCKET), F.lit("/"), F.col("_metadata.file_name"))
    now = table.groupBy(BUCKET, file.alias("file")).agg(F.count("*").alias("orders"))
    return now.join(known, "file", "left").groupBy(BUCKET).agg(
        F.sum("orders").alias("orders"), F.bool_or(F.col("old").isNull()).alias("rewritten"))


@query("""
SELECT user_id, event_id, ts, value FROM events QUALIFY rank() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
""")
def latest_state(source: Source):
    """The latest events of each user, kept up over three nights in which events arrive in no order of time."""
    events = source.events.select("user_id", "event_id", "ts", "value")
    layout = _laid_out(source, events.limit(0), "user_id")
    for night in range(3):
        arrived = events.where(F.pmod(F.col("event_id"), F.lit(3)) == night)
        state = maintain_latest(source.spark, layout, arrived, "ts", f"night-{night}").table
    return state.drop(BUCKET)


@query("""
WITH p AS (SELECT l_suppkey, l_extendedprice, rank() OVER (PARTITION BY l_suppkey ORDER BY CAST(l_shipdate AS DATE) DESC) AS n FROM lineitem)
SELECT s_suppkey AS fund_alert_id, l_extendedprice AS ubidpr
FROM supplier JOIN p ON l_suppkey = s_suppkey WHERE n = 1 AND (l_extendedprice <= 20000 OR l_extendedprice >= 80000)
""")
def alert_by_latest_price(source: Source):
    """Fund alerts from maintained prices: history up to 1998, then two years' prices as further nights."""
    prices = source.lineitem.select(
        F.col("l_suppkey").cast("string").alias("vrtfnd"), F.col("l_extendedprice").alias("ubidpr"),
        F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("effdate"),
    )
    layout = _laid_out(source, prices.limit(0), "vrtfnd")
    for night, (low, high) in enumerate(((0, 19971231), (19971231, 19991231), (19991231, 99999999))):
        rows = prices.where((F.col("effdate") > low) & (F.col("effdate") <= high))
        state = maintain_latest(source.spark, layout, rows, "effdate", f"night-{night}").table
    alerts = source.supplier.select(
        F.col("s_suppkey").alias("fund_alert_id"), F.col("s_nationkey").alias("user_id"),
        F.lit(20000.0).alias("floor"), F.lit(80000.0).alias("ceiling"),
    )
    return alert_by_fund({"fund_alert": alerts, "latest_price": state}, AFTER_ORDERS).out["alerts"].select("fund_alert_id", "ubidpr")


@query("""
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d')::INTEGER AS modidate FROM orders
WHERE strftime(o_orderdate, '%Y%m%d')::INTEGER > 20010615
""")
def changed_orders(source: Source):
    """Orders changed since a mark, from a table laid out by the month of the change."""
    orders = source.orders.select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("modidate"))
    folder = scratch_folder(source.spark, "changes")
    write_clustered(orders, folder, "modidate")
    table = read_clustered(source.spark, folder, "o_orderkey bigint, o_custkey bigint, modidate int")
    return table.where(changed_since(table, "modidate", 20010615)).drop(PERIOD)


_KINDS = "click view purchase signup error".split()
_PAIRS = {f"{a}+{b}": [a, b] for i, a in enumerate(_KINDS) for b in _KINDS[i + 1 :]}


@query(f"""
WITH held AS (
  SELECT user_id, CAST(ts AS DATE) AS day, list_sort(list(DISTINCT event_type)) AS held FROM events GROUP BY 1, 2),
sets AS (SELECT * FROM (VALUES {', '.join(f"('{n}', list_sort(['{a}', '{b}']))" for n, (a, b) in _PAIRS.items())}) v(role_set, wanted))
SELECT user_id, day, role_set, 'exact' AS kind FROM held JOIN sets ON held = wanted
UNION ALL SELECT user_id, day, role_set, 'at least' FROM held JOIN sets ON list_has_all(held, wanted)
""")
def role_sets_held(source: Source):
    """Ten sets of two event kinds, each held exactly or among others on a day, by one aggregate each."""
    daily = source.events.withColumn("day", F.to_date("ts"))
    exact = role_sets(daily, ["user_id", "day"], "event_type", _PAIRS)
    more = role_sets(daily, ["user_id", "day"], "event_type", _PAIRS, exact=False)
    return exact.withColumn("kind", F.lit("exact")).unionByName(more.withColumn("kind", F.lit("at least")))


@query(f"""{_INTAKE}
SELECT 'user' AS what, user_id AS id, client AS name FROM investor
UNION ALL SELECT 'last', (SELECT max(user_id) FROM users) + (SELECT count(*) FROM investor), t
FROM (VALUES ('r_user.user_id'), ('r_user_info.user_info_id')) v(t)
UNION ALL SELECT 'last', (SELECT count(*) FROM investor), 'r_user_role.user_role_id'
""")
def sequence_keys(source: Source):
    """New investors whose keys come from the sequence table, and that table behind them."""
    tables = stand_ins.client_tables(source)
    tables[SEQUENCES] = reuse(sequence_table(source.spark, tables, USER_KEYS))
    result = new_investors(tables, AFTER_ORDERS)
    users = result.out["NEW_USER"].select(F.lit("user").alias("what"), F.col("user_id").alias("id"), F.col("clntnum").alias("name"))
    return users.unionByName(result.tables[SEQUENCES].select(F.lit("last").alias("what"), F.col("last_id").alias("id"), "name"))
