"""A night of jobs: order, restart behind the last finished job, failures."""

from datetime import timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from duskwork import plans
from duskwork.catalog import nights
from duskwork.plans import NightStopped, Step, report, run_night
from duskwork.sources import bucketed
from duskwork.sources.bucketed import BUCKET, Layout
from duskwork.sources.schemas import SCHEMAS
from tests.helpers import AS_OF, ago, params, rows, tables


def start(spark, folder):
    """Approvals, transactions and users; users are laid out by key."""
    made = tables(
        spark,
        r_sysparam=params(PENDINGAPPROVAL_DAYS=30, DORMANT_PERIOD_ADMIN=10, DORMANT_PERIOD_USER=20, PASSWORD_RESET_DATE_LAST_RUN=1),
        pending_approval=[
            {"pending_approval_id": i, "pending_status": "PND", "pending_type": "ADM", "dt_submitted": ago(40 if i < 3 else 1)} for i in range(6)],
        trx_ut=[{"trx_ut_id": i, "trx_status": "ORD", "reference_id": f"r{i}", "pending_approval_id": i} for i in range(2)],
        r_user_info=[{"user_info_id": i, "user_id": i, "user_type": "E", "clntnum": f"c{i}"} for i in range(40)],
        r_user_role=[{"user_id": i, "role_id": 1} for i in range(40)],
        r_role=[{"role_id": 1, "role_type": "E"}],
        ifsdmclntpf=[{"clntnum": f"c{i}", "zemailadd": f"m{i}"} for i in range(40)],
    )
    layout = Layout(f"{folder}/r_user", ("user_id",), SCHEMAS["r_user"], 1)
    users = spark.createDataFrame(
        [(i, f"u{i}", "A", ago(days=40 if i in (3, 17) else 1), "Y" if i in (4, 30) else "N") for i in range(40)],
        "user_id bigint, login_id string, status string, dt_last_login timestamp_ntz, pwd_regen_flag string")
    empty = spark.createDataFrame([], SCHEMAS["r_user"])
    made["r_user"] = bucketed.lay_out(empty.unionByName(users, allowMissingColumns=True), layout)
    return made, {"r_user": layout}


STEPS = (
    Step("DelExpTrnReqWOApp", plans.expire_approvals), Step("DormantUserID", plans.set_dormant),
    Step("TransactionApproval", plans.settle_transactions), Step("GenPwdForFrontEnd", plans.queue_password_resets),
)


def summary(state):
    users = state["r_user"].select("user_id", "status", "pwd_regen_flag", "dt_updated")
    return (
        rows(users), rows(state["pending_approval"], "pending_approval_id", "pending_status"), rows(state["trx_ut"], "trx_ut_id", "trx_status"),
        rows(state["r_user_process"], "user_id"), rows(state["eod_log"], "eod_proc_name", "eod_date", "status"),
        rows(state["audit_trail"], "action", "data1", "data2"),
    )


def replaced(number, job):
    return tuple(Step(s.name, job) if i == number else s for i, s in enumerate(STEPS, 1))


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("whole"))
    made, layouts = start(spark, folder)
    state = run_night(spark, STEPS, made, AS_OF, folder, "n1", layouts)
    assert [r.state for r in report(spark, STEPS, folder, "n1").collect()] == ["done"] * 4
    return summary(state)


def test_night_runs_in_order(whole):
    users, approvals, transactions, queue, log, audit = whole
    assert [u[0] for u in users if u[1] == "D"] == [3, 17] and {u[2] for u in users} == {"N"}
    assert approvals == [(2, "EXP"), (3, "PND"), (4, "PND"), (5, "PND")] and transactions == []
    assert queue == [("30",), ("4",)] and [row[2] for row in log] == ["S"] * 4 and len(audit) == 3 + 2 + 2


@pytest.mark.parametrize("lost", [2, 3, 4])
def test_restart_goes_on_behind_the_last_finished_job(spark, tmp_path, whole, lost):
    made, layouts = start(spark, tmp_path)
    folder = str(tmp_path)

    def killed(tables, as_of):
        raise KeyboardInterrupt

    def computed_again(tables, as_of):
        raise AssertionError("a finished job was computed again")

    with pytest.raises(KeyboardInterrupt):
        run_night(spark, replaced(lost, killed), made, AS_OF, folder, "n1", layouts)
    assert [r.state for r in report(spark, STEPS, folder, "n1").collect()] == ["done"] * (lost - 1) + ["open"] * (5 - lost)
    again = tuple(Step(s.name, computed_again) if i < lost else s for i, s in enumerate(STEPS, 1))
    # the next morning, with the tables the night began with; users were changed in place
    made["r_user"] = bucketed.read_laid_out(spark, layouts["r_user"])
    state = run_night(spark, again, made, AS_OF + timedelta(hours=9), folder, "n1", layouts)
    assert summary(state) == whole
    finished = tuple(Step(s.name, computed_again) for s in STEPS)
    assert summary(run_night(spark, finished, made, AS_OF, folder, "n1", layouts)) == whole


def test_failed_job_stops_the_night_and_stays_in_the_log(spark, tmp_path, whole):
    made, layouts = start(spark, tmp_path)

    def broken(tables, as_of):
        raise ValueError("no feedback table")

    for _ in range(2):
        with pytest.raises(NightStopped) as stopped:
            run_night(spark, replaced(3, broken), made, AS_OF, str(tmp_path), "n1", layouts)
        made["r_user"] = bucketed.read_laid_out(spark, layouts["r_user"])
    assert stopped.value.step.name == "TransactionApproval"
    log = rows(stopped.value.tables["eod_log"], "eod_proc_name", "status", "remarks")
    assert log.count(("TransactionApproval", "F", "no feedback table")) == 2 and len(log) == 4
    assert tuple(report(spark, STEPS, str(tmp_path), "n1").where("number = 3").first())[2:] == ("failed", 2)
    state = run_night(spark, STEPS, made, AS_OF, str(tmp_path), "n1", layouts)
    assert summary(state)[:4] == whole[:4] and summary(state)[5] == whole[5]
    assert [row[2] for row in summary(state)[4]].count("F") == 2


def test_other_steps_need_another_night(spark, tmp_path):
    made, layouts = start(spark, tmp_path)
    run_night(spark, STEPS[:1], made, AS_OF, str(tmp_path), "n1", layouts)
    with pytest.raises(ValueError, match="begun with"):
        run_night(spark, STEPS, made, AS_OF, str(tmp_path), "n1", layouts)


def test_views_follow_their_tables(spark, tmp_path):
    made, layouts = start(spark, tmp_path)
    seen = []

    def look(tables, as_of):
        seen.append(tables["dormant"].count())
        return plans.JobResult({}, ("look",))

    steps = (Step("look", look), STEPS[1], Step("look again", look))
    run_night(spark, steps, made, AS_OF, str(tmp_path), "n1", layouts, {"dormant": lambda t: t["r_user"].where(F.col("status") == "D")})
    assert seen == [0, 2] and BUCKET in made["r_user"].columns


class Begun(Exception):
    """Stops a night before its first job."""


def test_jobs_of_a_night_read_written_tables(spark, monkeypatch):
    """No job of the intake night joins or groups the given tables again."""
    day = F.lit("1997-05-01").cast("timestamp_ntz")
    given = SimpleNamespace(
        spark=spark,
        customer=spark.createDataFrame([(1, "n", 0, 5.0, "BUILDING")], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        supplier=spark.createDataFrame([(1, 0, 9000.0)], "s_suppkey bigint, s_nationkey int, s_acctbal double"),
        nation=spark.createDataFrame([(0, 0)], "n_nationkey int, n_regionkey int"),
        region=spark.createDataFrame([(0, "ASIA")], "r_regionkey int, r_name string"),
        part=spark.createDataFrame([(1, "Brand#1", "t", 1, 2.0)], "p_partkey bigint, p_brand string, p_type string, p_size int, p_retailprice double"),
        orders=spark.createDataFrame([(7, 1, "F", 1.0, "2-HIGH")], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string").withColumn("o_orderdate", day),
        lineitem=spark.createDataFrame([(7, 1, 1)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint").withColumn("l_shipdate", day),
        events=spark.createDataFrame([(1, 1, "view", 1.0)], "event_id bigint, user_id bigint, event_type string, value double").withColumn("ts", day),
    )
    seen = {}

    def begun(spark, steps, tables, *rest, **more):
        seen.update(tables)
        raise Begun

    monkeypatch.setattr(nights, "run_night", begun)
    with pytest.raises(Begun):
        nights.nightly_states(given)
    plans_of = {n: df._jdf.queryExecution().optimizedPlan().toString() for n, df in seen.items()}
    assert not [n for n, plan in plans_of.items() if "Join" in plan or "Aggregate" in plan]
    assert rows(seen["ifsdmutrnpf"]) == [("1-1  ", "2", "7", 19970501)]
    assert rows(seen["ifsdmchdrpf"], "chdrcoy", "chdrnum", "servagnt") == [("2", "7", "1")]
