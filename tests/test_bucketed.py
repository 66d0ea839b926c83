"""Tables laid out by key bucket: only touched buckets are written, and reruns change nothing."""

import pytest
from pyspark.sql import functions as F

from duskwork import plans
from duskwork.operators.mutate import delete_keys, merge_upsert, update_from, update_keys
from duskwork.plans.job import JobResult
from duskwork.sources import bucketed, files
from duskwork.sources.bucketed import BUCKET, Layout
from duskwork.sources.schemas import SCHEMAS
from tests.helpers import AS_OF, ago, params, rows, tables
from tests.test_plans import plan_of

SCHEMA = "k bigint, v string, n int"


def laid_out(spark, folder, many=300):
    made = spark.createDataFrame([(i, f"v{i}", i % 5) for i in range(many)] + [(None, "no key", 1)], SCHEMA)
    layout = Layout(str(folder), ("k",), SCHEMA, 1)
    return layout, bucketed.lay_out(made, layout), made


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k bigint")


def untouched(before, after, buckets):
    """Files of other buckets, which must be the same ones before and after."""
    def inside(f):
        return any(f"{BUCKET}={b}/" in f for b in buckets)

    return {f for f in before if not inside(f)} == {f for f in after if not inside(f)}


def test_layout_holds_the_table(spark, tmp_path):
    layout, table, made = laid_out(spark, tmp_path / "t")
    assert rows(table, "k", "v", "n") == rows(made)
    assert rows(table.where(F.col(BUCKET) != layout.bucket())) == []
    with pytest.raises(FileExistsError):
        bucketed.lay_out(made, layout)


@pytest.mark.parametrize("wanted", [[7], [7, 8, 250, 9999], [], [None]])
def test_changes_write_only_their_buckets(spark, tmp_path, wanted):
    layout, table, made = laid_out(spark, tmp_path / "t")
    old = files.data_files(spark, layout.folder)
    hit = keys(spark, *wanted)
    change = bucketed.update_keys_in(spark, layout, hit, {"v": F.lit("new")}, "run-1")
    expected = update_keys(made, hit, "k", {"v": F.lit("new")})
    assert rows(change.table, "k", "v", "n") == rows(expected)
    new = files.data_files(spark, layout.folder)
    assert len(change.buckets) <= len(wanted) and untouched(old, new, change.buckets)
    assert (set(old) == set(new)) is (not change.buckets)

    gone = bucketed.delete_keys_in(spark, layout, hit, "run-2")
    assert rows(gone.table, "k", "v", "n") == rows(delete_keys(expected, hit, "k"))

    source = spark.createDataFrame([(i, f"m{i}") for i in (*wanted, 5, 1000)], "k bigint, w string").dropna()
    copied = bucketed.update_from_in(spark, layout, source, {"v": "w"}, "run-2b", {"n": F.lit(9)})
    left = update_from(delete_keys(expected, hit, "k"), source, "k", {"v": "w"}, {"n": F.lit(9)})
    assert rows(copied.table, "k", "v", "n") == rows(left)
    update, insert = {"v": F.col("w")}, {"k": F.col("k"), "v": F.col("w")}
    merged = bucketed.merge_in(spark, layout, source, update, insert, "run-3")
    assert rows(merged.table, "k", "v", "n") == rows(merge_upsert(left, source, "k", update, insert))


def test_scan_of_a_change_is_pruned(spark, tmp_path):
    layout, table, _ = laid_out(spark, tmp_path / "t")
    plan = plan_of(bucketed.in_buckets(update_keys(table, keys(spark, 7), "k", {"v": F.lit("x")}), ["b0", "b1"]))
    filters = plan.split("PartitionFilters: [", 1)[1].split("], PushedFilters")[0]
    assert "key_bucket" in filters and "b0" in filters


def test_last_row_of_a_bucket_goes(spark, tmp_path):
    layout, table, made = laid_out(spark, tmp_path / "t", many=30)
    bucket = table.where("k = 3").first()[BUCKET]
    doomed = table.where(F.col(BUCKET) == bucket).select("k")
    change = bucketed.delete_keys_in(spark, layout, keys(spark, *[r.k for r in doomed.collect()]), "run")
    assert change.buckets == [bucket] and change.table.where(F.col(BUCKET) == bucket).count() == 0
    assert not files.exists(spark, f"{layout.folder}/{BUCKET}={bucket}")
    everything = made.select("k").dropna()
    assert rows(bucketed.delete_keys_in(spark, layout, everything, "all").table, "k", "v") == [(None, "no key")]


def test_rerun_after_a_lost_driver(spark, tmp_path):
    layout, table, made = laid_out(spark, tmp_path / "t")
    more = lambda old: old.withColumn("n", F.col("n") + F.when(F.col("k") == 7, 1).otherwise(0))
    bucketed.stage(spark, layout, keys(spark, 7), lambda b: more(bucketed.in_buckets(table, b).drop(BUCKET)), "add")
    # lost while the bucket was being replaced: its old rows are gone already
    files.delete(spark, f"{layout.folder}/{BUCKET}={bucketed.staged_buckets(spark, layout, 'add')[0]}")
    for _ in range(3):
        change = bucketed.rewrite(spark, layout, keys(spark, 7), more, "add")
        assert rows(change.table, "k", "v", "n") == rows(made.withColumn("n", F.when(F.col("k") == 7, 3).otherwise(F.col("n"))))
    new = spark.createDataFrame([(1000, "a", 1), (1001, "b", 2)], SCHEMA)
    for _ in range(2):
        assert bucketed.append(spark, layout, new, "grow").table.count() == made.count() + 2
    files.delete(spark, f"{layout.staged('grow')}/done")  # lost between the append and its mark
    assert bucketed.append(spark, layout, new, "grow").table.count() == made.count() + 2


def test_rows_of_other_buckets_are_refused(spark, tmp_path):
    layout, *_ = laid_out(spark, tmp_path / "t")
    for _ in range(2):
        with pytest.raises(ValueError, match="outside the touched buckets"):
            bucketed.rewrite(spark, layout, keys(spark, 7), lambda old: old.withColumn("k", F.col("k") + 1), "bad")
    with pytest.raises(ValueError, match="cannot be changed"):
        bucketed.update_keys_in(spark, layout, keys(spark, 7), {"k": F.lit(1)}, "bad key")


USER = "user_id bigint, login_id string, status string, dt_last_login timestamp_ntz, updated_by string, dt_updated timestamp_ntz"


def job_tables(spark, folder):
    made = tables(
        spark,
        r_sysparam=params(DORMANT_PERIOD_ADMIN=10, DORMANT_PERIOD_USER=20),
        r_user_info=[{"user_id": i, "user_type": "E"} for i in range(200)],
        r_user_role=[{"user_id": i, "role_id": 1} for i in range(200)],
        r_role=[{"role_id": 1, "role_type": "E"}],
    )
    users = spark.createDataFrame([(i, f"u{i}", "A", ago(days=40 if i in (3, 77) else 1), None, None) for i in range(200)], USER)
    layout = Layout(f"{folder}/users", ("user_id",), USER, 2)
    made["r_user"] = bucketed.lay_out(users, layout)
    return made, layout


def test_job_rewrites_only_touched_buckets(spark, tmp_path):
    made, layout = job_tables(spark, tmp_path)
    old = files.data_files(spark, layout.folder)
    for _ in range(2):  # the second time nothing is left to do
        state = plans.run_job(
            spark, plans.set_dormant, "DormantUserID", made, AS_OF, str(tmp_path / "runs"), {"r_user": layout}, "night-1")
        assert rows(state["r_user"].where("status = 'D'"), "user_id") == [(3,), (77,)]
        assert state["r_user"].count() == 200 and state["audit_trail"].count() == 2
        new = files.data_files(spark, layout.folder)
        changed = set(new) - set(old)
        assert 1 <= len({f.split(f"{BUCKET}=")[1].split("/")[0] for f in changed}) <= 2
        assert len(set(old) & set(new)) == len(old) - len({f.split(f"{BUCKET}=")[1].split("/")[0] for f in changed})


def test_job_lost_between_staging_and_replacing(spark, tmp_path, monkeypatch):
    made, layout = job_tables(spark, tmp_path)
    runs = str(tmp_path / "runs")

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr("duskwork.plans.job.put_in_place", lost)
        with pytest.raises(KeyboardInterrupt):
            plans.run_job(spark, plans.set_dormant, "DormantUserID", made, AS_OF, runs, {"r_user": layout}, "night-1")
    assert bucketed.read_laid_out(spark, layout).where("status = 'D'").count() == 0

    def not_again(*_):
        raise AssertionError("computed again")

    state = plans.run_job(spark, not_again, "DormantUserID", made, AS_OF, runs, {"r_user": layout}, "night-1")
    assert rows(state["r_user"].where("status = 'D'"), "user_id") == [(3,), (77,)]
    assert rows(state["eod_log"], "eod_proc_name", "status") == [("DormantUserID", "S")]


def test_buckets_staged_by_a_failed_try_are_not_used(spark, tmp_path):
    made, layout = job_tables(spark, tmp_path)

    def broken(tables, as_of):
        result = plans.set_dormant({**tables, "r_sysparam": params_of(spark, 0.5)}, as_of)
        return JobResult({**result.tables, "zzz": spark.range(1).select(F.raise_error(F.lit("disk full")).alias("x"))}, ("x",), None, touched=result.touched)

    failed = plans.run_job(spark, broken, "DormantUserID", made, AS_OF, str(tmp_path / "runs"), {"r_user": layout}, "night-1")
    assert rows(failed["eod_log"], "status") == [("F",)]
    wrong = keys_of_users(spark, 9)
    bucketed.stage(spark, layout, wrong, lambda b: bucketed.in_buckets(made["r_user"], b).drop(BUCKET).withColumn("status", F.lit("X")), "night-1")
    state = plans.run_job(spark, plans.set_dormant, "DormantUserID", made, AS_OF, str(tmp_path / "runs"), {"r_user": layout}, "night-1")
    assert rows(state["r_user"].where("status <> 'A'"), "user_id", "status") == [(3, "D"), (77, "D")]


def params_of(spark, days):
    return tables(spark, r_sysparam=params(DORMANT_PERIOD_ADMIN=days, DORMANT_PERIOD_USER=days))["r_sysparam"]


def keys_of_users(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id bigint")


def test_failed_tries_stay_in_the_log(spark, tmp_path):
    made, layout = job_tables(spark, tmp_path)

    def broken(tables, as_of):
        raise ValueError("out of order")

    state = plans.run_job(spark, broken, "DormantUserID", made, AS_OF, str(tmp_path / "runs"), {"r_user": layout}, "night-1")
    assert rows(state["eod_log"], "status", "remarks") == [("F", "out of order")]
    state = plans.run_job(spark, plans.set_dormant, "DormantUserID", made, AS_OF, str(tmp_path / "runs"), {"r_user": layout}, "night-1")
    assert rows(state["eod_log"], "status") == [("F",), ("S",)]


def test_job_that_names_no_keys_writes_all_buckets(spark, tmp_path):
    made, layout = job_tables(spark, tmp_path)

    def job(tables, as_of):
        return JobResult({"r_user": tables["r_user"].where("user_id < 5").withColumn("user_id", F.col("user_id") * 1000)}, ("x",))

    state = plans.run_job(spark, job, "x", made, AS_OF, str(tmp_path / "runs"), {"r_user": layout})
    assert rows(state["r_user"], "user_id") == [(0,), (1000,), (2000,), (3000,), (4000,)]


def test_refreshes_tell_their_keys(spark, tmp_path):
    made = tables(
        spark,
        plan_acct=[{"acctid": i, "chdrcoy": "2", "chdrnum": f"n{i}", "status": "A"} for i in range(60)],
        ifsdmchdrpf=[{"chdrcoy": "2", "chdrnum": f"n{i}", "statcode": "LA" if i in (7, 31) else "IF", "modidate": 20240614} for i in range(60)],
    )
    layout = Layout(str(tmp_path / "plan_acct"), ("acctid",), SCHEMAS["plan_acct"], 2)
    made["plan_acct"] = bucketed.lay_out(made["plan_acct"], layout)
    old = files.data_files(spark, layout.folder)
    state = plans.run_job(spark, plans.refresh_accounts, "REFRESH PLANACCT", made, AS_OF, str(tmp_path / "runs"), {"plan_acct": layout})
    assert rows(state["plan_acct"].where("status = 'I'"), "acctid") == [(7,), (31,)] and state["plan_acct"].count() == 60
    assert len(set(old) - set(files.data_files(spark, layout.folder))) == 2
