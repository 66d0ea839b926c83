"""Maintained states: latest rows, key sequences, tables by change month, many role sets."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from duskwork import plans
from duskwork.operators import latest, ranking, roles, sequences
from duskwork.operators.sequences import SEQUENCE_SCHEMA, SEQUENCES
from duskwork.plans import alerts, intake
from duskwork.plans.job import next_state
from duskwork.sources import bucketed, clustered, files
from duskwork.sources.bucketed import BUCKET, Layout
from duskwork.sources.clustered import PERIOD
from tests.helpers import AS_OF, rows
from tests.test_jobs import intake_case

PRICES = "fund string, day int, price double"


def price_nights(spark, seed=1):
    rng = random.Random(seed)
    made = [[(rng.choice([*"abcdefgh", None]), rng.choice([*range(20240100, 20240110), None]), float(rng.randint(1, 3))) for _ in range(40)]
            for _ in range(3)]
    made[1] += [("z", 20240101, 1.0)]  # a fund seen once
    made[2] += [("a", 19990101, 9.0), ("late", 19990101, 9.0)]  # arrive late
    return [spark.createDataFrame(night, PRICES) for night in made]


@pytest.mark.parametrize("seed", [1, 2])
def test_maintained_latest_equals_full_ranking(spark, tmp_path, seed):
    layout = Layout(str(tmp_path / "latest"), ("fund",), PRICES, 1)
    nights = price_nights(spark, seed)
    bucketed.lay_out(nights[0].limit(0), layout)
    history = nights[0].limit(0)
    for number, night in enumerate(nights):
        history = history.unionByName(night)
        expected = rows(ranking.latest_per_key(history, "fund", "day"))
        for _ in range(2):  # a night that is run again adds nothing
            state = latest.maintain_latest(spark, layout, night, "day", f"night-{number}").table
            assert rows(state, "fund", "day", "price") == expected
        assert rows(latest.merge_latest(night.limit(0), history, "fund", "day"), "fund", "day", "price") == expected


def test_a_night_reads_and_writes_only_its_keys(spark, tmp_path):
    layout = Layout(str(tmp_path / "latest"), ("fund",), PRICES, 2)
    history = spark.range(500).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("fund"), F.lit(20240101).alias("day"), F.lit(1.0).alias("price"))
    bucketed.lay_out(history, layout)
    before = set(files.data_files(spark, layout.folder))
    night = spark.createDataFrame([("f7", 20240102, 2.0)], PRICES)
    change = latest.maintain_latest(spark, layout, night, "day", "n")
    after = set(files.data_files(spark, layout.folder))
    assert len(change.buckets) == 1 and all(f"{BUCKET}={change.buckets[0]}/" in f for f in before ^ after)
    assert rows(change.table.where("fund = 'f7'"), "day", "price") == [(20240102, 2.0)] and change.table.count() == 500


def test_alerts_on_maintained_prices(spark):
    history = spark.createDataFrame(
        [("1", 5.0, 1), ("1", 50.0, 2), ("2", 50.0, 1), ("2", 5.0, 2), ("2", 6.0, 2), ("3", 20.0, 1)], "vrtfnd string, ubidpr double, effdate int")
    bands = spark.createDataFrame([(i, i, 10.0, 40.0) for i in (1, 2, 3)], "fund_alert_id bigint, user_id bigint, floor double, ceiling double")
    full = rows(alerts.alert_by_fund({"fund_alert": bands, "ifsdmvprcpf": history}, AS_OF).out["alerts"])
    kept = ranking.latest_per_key(history, "vrtfnd", "effdate")
    # the history isn't looked at any more
    assert rows(alerts.alert_by_fund({"fund_alert": bands, alerts.LATEST_PRICE: kept}, AS_OF).out["alerts"]) == full and len(full) == 3


# --- sequences -----------------------------------------------------------------------

def with_sequence(spark, made, *keys):
    return {**made, SEQUENCES: sequences.sequence_table(spark, made, keys)}


def test_sequence_gives_the_keys_that_scanning_gives(spark):
    made = intake_case(spark)
    keyed = with_sequence(spark, made, *intake.USER_KEYS, ("r_customer", "entityid"), ("plan_acct", "acctid"), ("audit_trail", "audit_id"))
    plain = plans.take_in(made, AS_OF)
    state = plans.take_in(keyed, AS_OF)
    for name in ("r_user", "r_user_info", "r_customer", "plan_acct", "r_custuser_matrix"):
        assert rows(state.tables[name]) == rows(plain.tables[name])
    last = dict(rows(state.tables[SEQUENCES], "name", "last_id"))
    for table, key in (*intake.USER_KEYS, ("r_customer", "entityid"), ("plan_acct", "acctid")):
        top = state.tables[table].agg(F.max(key)).first()[0]
        assert last[f"{table}.{key}"] == (top or 0)
    done = next_state(spark, keyed, state, AS_OF)
    ids = [i for (i,) in rows(done["audit_trail"], "audit_id")]
    assert sorted(ids) == list(range(1, len(ids) + 1)) and ids
    assert dict(rows(done[SEQUENCES], "name", "last_id"))["audit_trail.audit_id"] == len(ids)


def test_no_target_is_scanned_for_a_key(spark):
    made = intake_case(spark)
    keyed = with_sequence(spark, made, *intake.USER_KEYS)
    keyed[SEQUENCES] = spark.createDataFrame(rows(keyed[SEQUENCES], "name", "last_id"), SEQUENCE_SCHEMA)
    broken = F.raise_error(F.lit("scanned"))
    for table in ("r_user", "r_user_role"):
        frame = made[table]
        keyed[table] = spark.range(1).select(*[broken.cast(f.dataType).alias(f.name) for f in frame.schema.fields])
    people = intake.new_investors(keyed, AS_OF).out["NEW_USER"]
    again = intake.new_investors(keyed, AS_OF).out["NEW_USER"]
    ids = [i for (i,) in rows(people, "user_id")]
    start = made["r_user"].agg(F.coalesce(F.max("user_id"), F.lit(0))).first()[0]
    assert ids == list(range(start + 1, start + 1 + len(ids))) and ids and rows(people) == rows(again)


def test_missing_sequence_is_an_error(spark):
    made = {"t": spark.range(3), SEQUENCES: spark.createDataFrame([("t.id", 9)], SEQUENCE_SCHEMA)}
    assert spark.range(1).select(sequences.last_key(made, "t", "id")).first()[0] == 9
    with pytest.raises(Exception, match="no sequence u.id"):
        spark.range(1).select(sequences.last_key({**made, "u": made["t"]}, "u", "id")).collect()
    assert sequences.reserved({"t": made["t"]}, {("t", "id"): made["t"]}) == {}


# --- tables by change month ------------------------------------------------------------

def files_read(df):
    """Files the scans of an executed plan have opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.getClass().getName() else plan
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numFiles")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_files_read_fall_with_the_mark(spark, tmp_path):
    made = spark.range(730).select("id", F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")), "yyyyMMdd").cast("int").alias("modidate"))
    made = made.union(spark.createDataFrame([(1000, None)], "id bigint, modidate int"))
    clustered.write_clustered(made, str(tmp_path / "t"), "modidate")
    table = clustered.read_clustered(spark, str(tmp_path / "t"), "id bigint, modidate int")
    seen = []
    for since in (20230101, 20240101, 20241115, 20250101):
        got = table.where(clustered.changed_since(table, "modidate", since)).drop(PERIOD)
        assert rows(got) == rows(made.where(F.col("modidate") > since))
        seen.append(files_read(got))
    assert seen[0] >= 24 > seen[1] >= 12 > seen[2] >= 1 and seen[3] == 0
    clustered.write_clustered(spark.createDataFrame([(2000, 20241231)], "id bigint, modidate int"), str(tmp_path / "t"), "modidate", "append")
    table = clustered.read_clustered(spark, str(tmp_path / "t"), "id bigint, modidate int")
    late = rows(table.where(clustered.changed_since(table, "modidate", 20241230)), "id")
    assert late == [*rows(made.where("modidate > 20241230"), "id"), (2000,)]


def test_moments_cluster_too(spark, tmp_path):
    made = spark.createDataFrame([(i, datetime(2024, 1, 1) + timedelta(hours=7 * i)) for i in range(300)] + [(-1, None)], "id bigint, t timestamp_ntz")
    clustered.write_clustered(made, str(tmp_path / "t"), "t")
    table = clustered.read_clustered(spark, str(tmp_path / "t"), "id bigint, t timestamp_ntz")
    mark = datetime(2024, 2, 29, 23)
    assert rows(table.where(clustered.changed_since(table, "t", mark)), "id") == rows(made.where(F.col("t") > F.lit(mark).cast("timestamp_ntz")), "id")
    assert str(clustered.changed_since(made, "t", mark)).count("period") == 0


def test_intake_prunes_a_clustered_contract_table(spark, tmp_path):
    made = intake_case(spark)
    plain = intake.new_accounts(made, AS_OF).out["NEW_ACCT"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made["ifsdmchdrpf"].schema.fields)
    clustered.write_clustered(made["ifsdmchdrpf"], str(tmp_path / "c"), "modidate")
    made["ifsdmchdrpf"] = clustered.read_clustered(spark, str(tmp_path / "c"), schema)
    assert rows(intake.new_accounts(made, AS_OF).out["NEW_ACCT"]) == rows(plain)


# --- role sets ---------------------------------------------------------------------------

@pytest.mark.parametrize("many", [4, 200])
def test_role_sets_against_one_set_at_a_time(spark, many):
    rng = random.Random(many)
    names = [f"r{i}" for i in range(many)]
    made = [(rng.randint(0, 40), rng.choice([*names[:3], rng.choice(names), "other", None])) for _ in range(150)]
    frame = spark.createDataFrame(made + made[:9] + [(None, "r1"), (99, None)], "u int, r string")
    sets = {f"{a}+{b}": [a, b] for a in names[:3] for b in [names[0], names[1], names[-1]]} | {"one": [names[2]], "none": []}
    for exact in (True, False):
        got = rows(roles.role_sets(frame, "u", "r", sets, exact), "u", "role_set")
        expected = []
        for name, required in sets.items():
            if required:
                expected += [(u, name) for (u,) in rows(roles.role_set(frame, "u", "r", sorted(set(required)), exact))]
        held = {}
        for u, r in frame.collect():
            held.setdefault(u, set()).add(r)
        expected += [(u, "none") for u, mine in held.items() if not exact or not {r for r in mine if r is not None}]
        assert got == sorted(expected, key=lambda row: tuple((v is None, v if isinstance(v, int) else str(v)) for v in row))


def test_role_sets_take_one_aggregate(spark):
    frame = spark.createDataFrame([(1, "a")], "u int, r string")
    plan = roles.role_sets(frame, "u", "r", {f"s{i}": ["a", f"b{i}"] for i in range(10)})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
