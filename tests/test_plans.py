"""Checks on physical plans: joins, pushed filters, skew."""

import contextlib
import pathlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from duskwork.operators import durable, filters, keys, mutate, ranking
from tests.helpers import ago

FOLDER = "/root/testdata/sf0.001"
PAIRWISE = ("BroadcastNestedLoopJoin", "CartesianProduct")

needs_tables = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables not present")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@needs_tables
@pytest.mark.parametrize("name", [
    "either_owner_join", "mailbox_purge", "pattern_fallback", "crossed_keys", "joint_group", "band_alert", "plan_refresh",
    "settle_ready", "cascade_lookup", "strict_update", "merge_upsert", "minus_chain",
])
def test_no_pairwise_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    assert not any(word in plan for word in PAIRWISE)


@needs_tables
def test_age_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(entry.queries()["retention_semi"](spark, FOLDER))
    assert "LessThanOrEqual(o_or" in plan and "EqualTo(o_orderstatus,P)" in plan
    assert "l_extendedprice" not in plan


@needs_tables
def test_row_limit_comes_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["first_per_key"](spark, FOLDER))
    assert "WindowGroupLimit" in plan and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_updates_by_condition_do_not_shuffle(spark):
    df = spark.range(10).withColumn("v", F.lit("a"))
    assert "Exchange" not in plan_of(mutate.update_where(df, F.col("id") > 5, {"v": F.lit("b")}))
    assert "Exchange" not in plan_of(mutate.move_where(df, df.limit(0), F.col("id") > 5)[0])


def test_hot_key_is_split(spark):
    """A key holding most rows is spread over several tasks of the join."""
    hot = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 10 < 8, F.lit(-1)).otherwise(F.col("id")).alias("k"), 
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    wanted = spark.range(-1, 200_000, 1, 8).select(F.col("id").alias("k"))
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="8", spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100k",
    ):
        for joined in (
            filters.with_match(hot, wanted, "k", "hit"), filters.keep_matching(hot, wanted, "k"),
            mutate.update_from(hot, wanted.withColumn("w", F.lit("w")), "k", {"pad": "w"}),
        ):
            joined.write.format("noop").mode("overwrite").save()
            assert joined.collect() and "skew=true" in plan_of(joined)


def test_few_written_keys_leave_the_table_in_place(spark):
    table = spark.range(10_000).withColumn("v", F.lit("a"))
    keys_df = spark.range(100).withColumn("v", F.lit("b"))
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"
    ):
        for most, expected in ((1000, True), (10, False)):
            kept = durable.reuse_keys(keys_df, most)
            for df in (
                mutate.delete_keys(table, kept, "id"), filters.keep_matching(table, kept, "id"),
                mutate.update_keys(table, kept, "id", {"v": F.lit("z")}),
            ):
                assert ("BroadcastHashJoin" in plan_of(df)) is expected
                assert ("SortMergeJoin" in plan_of(df)) is not expected
            assert mutate.delete_keys(table, kept, "id").count() == 9900


def test_many_settled_keys_filter_the_table_below_its_shuffle(spark, tmp_path):
    """A semi join with keys too many to broadcast gets a range for the scan and a runtime Bloom filter."""
    spark.range(0, 200_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("pad")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    kept = durable.reuse_keys(spark.range(1000, 60_000, 50).union(spark.createDataFrame([(None,), (1000,)], "id bigint")), most=10)
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="1",
    ):
        joined = filters.keep_matching(table, kept, "id")
        plan = plan_of(joined)
        assert "might_contain" in plan and plan.index("SortMergeJoin") < plan.index("might_contain")
        assert plan.index("Exchange hashpartitioning") < plan.index("might_contain")
        assert "GreaterThanOrEqual(id,1000)" in plan and "LessThanOrEqual(id,59950)" in plan
        assert joined.count() == 1180 and filters.drop_matching(table, kept, "id").count() == 200_000 - 1180
    assert durable.reuse_keys(spark.range(3)).count() == 3
    assert filters.keep_matching(table, durable.reuse_keys(spark.createDataFrame([(None,)], "id bigint"), most=0), "id").count() == 0


def test_wide_keys_are_not_broadcast(spark):
    wide = spark.range(1000).withColumn("text", F.lit("x"))
    assert durable.row_bytes(wide) >= 28
    assert "BroadcastHashJoin" in plan_of(mutate.delete_keys(spark.range(10), durable.reuse_keys(wide), "id"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        assert "SortMergeJoin" in plan_of(mutate.delete_keys(spark.range(10), durable.reuse_keys(wide, most_bytes=20_000), "id"))


def test_newest_cutoffs_pass_on_few_rows(spark):
    mail = spark.range(5000).select(
        (F.col("id") % 2).alias("owner"), (F.lit(ago(0)).cast("timestamp_ntz") - F.make_dt_interval(secs=F.col("id"))).alias("t")
    )
    plan = plan_of(ranking.newest_cutoffs(mail, "owner", "t", [5]))
    assert plan.count("WindowGroupLimit") >= 3
    assert ranking.beyond_newest(mail, "owner", "t", 5).count() == 4990


def test_key_numbering_has_no_window_over_all_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "c")
    plan = plan_of(keys.assign_ordinals(df, ["c"], "n"))
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) <= 1  # the bucket sizes only
