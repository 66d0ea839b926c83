import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from duskwork.operators import filters, incremental, joins, keys, lookup, mutate, ranking, roles
from duskwork.operators.audit import append_audit, audit_rows, enqueue_requests, run_log_row
from duskwork.operators.entities import joint_group, resolve_entities, sole_member_group
from duskwork.sources.schemas import make_table
from duskwork.sources.tables import project_columns, read_tables, write_tables
from tests.test_plans import settings
from tests.helpers import AS_OF, ago, rows


def test_aged_counts_to_the_second(spark):
    df = spark.createDataFrame(
        [(1, ago(3)), (2, ago(3, -1)), (3, ago(3, 1)), (4, None)], "id int, t timestamp_ntz"
    )
    assert [r[0] for r in rows(filters.aged(df, "t", 3, AS_OF), "id")] == [1, 3]


def test_class_limits(spark):
    df = spark.createDataFrame([(1, "I", ago(5)), (2, "E", ago(5)), (3, None, ago(5))], "id int, k string, t timestamp_ntz")
    old = filters.oldest_allowed("k", {"I": 10}, 5, AS_OF)
    assert [r[0] for r in rows(df.where(F.col("t") <= old), "id")] == [2, 3]


def test_band_bounds_are_inclusive(spark):
    df = spark.createDataFrame(
        [(1, 5, 5, 9), (2, 9, 5, 9), (3, 7, 5, 9), (4, 9, None, 9), (5, 7, None, 9)], "id int, v int, lo int, hi int"
    )
    assert [r[0] for r in rows(df.where(filters.outside_band("v", "lo", "hi")), "id")] == [1, 2, 4]


def test_matching_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(filters.keep_matching(df, right, "k"), "id") == [(1,)]
    assert rows(filters.drop_matching(df, right, "k"), "id") == [(2,), (3,)]
    assert rows(filters.with_match(df, right, "k", "hit"), "id", "hit") == [(1, True), (2, False), (3, False)]


def test_beyond_newest_against_brute_force(spark):
    rng = random.Random(3)
    data = [(i, rng.choice("abc"), AS_OF - timedelta(hours=rng.randint(0, 12)) if rng.random() > 0.1 else None) for i in range(120)]
    data += [(200 + i, "hot", AS_OF - timedelta(hours=i // 3)) for i in range(90)]
    df = spark.createDataFrame(data, "id int, k string, t timestamp_ntz")
    for n in (0, 1, 4, 40):
        expected = sorted(
            i for i, k, t in data
            if sum(1 for _, k2, t2 in data if k2 == k and t and t2 and t2 > t) >= n
        )
        assert [r[0] for r in rows(ranking.beyond_newest(df, "k", "t", n), "id")] == expected


def test_latest_keeps_ties_and_first_is_unique(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 2, 21), ("b", None, 5)], "k string, d int, v int")
    assert rows(ranking.latest_per_key(df, "k", "d"), "k", "v") == [("a", 20), ("a", 21)]
    assert rows(ranking.first_per_key(df, "k", [F.col("d").desc(), "v"]), "k", "v") == [("a", 20), ("b", 5)]


def test_owner_joins(spark):
    df = spark.createDataFrame([(1, "x", "y"), (2, "x", "x"), (3, "y", None), (4, None, None)], "id int, m string, j string")
    people = spark.createDataFrame([("x",), ("y",)], "p string")
    got = rows(joins.either_owner_join(df, people, ["m", "j"], "p"), "id", "p")
    assert got == [(1, "x"), (1, "y"), (2, "x"), (3, "y")]


def test_all_combinations(spark):
    a = spark.range(7).withColumnRenamed("id", "a")
    b = spark.createDataFrame([("p",), ("q",), ("p",)], "b string")
    assert joins.all_combinations(a, b).count() == 21
    assert joins.all_combinations(a, b.limit(0)).count() == 0


def test_all_combinations_in_many_cells(spark):
    a = spark.range(50).withColumnRenamed("id", "a")
    b = spark.range(30).withColumnRenamed("id", "b")
    assert rows(joins.all_combinations(a, b, cell=7)) == rows(a.crossJoin(b))
    assert joins.all_combinations(a.limit(0), b, cell=7).count() == 0
    twice = a.union(a)
    assert joins.all_combinations(twice, b, cell=7).count() == 3000


def test_product_is_dealt_over_as_many_tasks_as_it_needs(spark):
    def tasks(many, cell):
        side = spark.range(many)
        product = joins.all_combinations(side.withColumnRenamed("id", "a"), side.withColumnRenamed("id", "b"), cell)
        return product.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()

    with settings(
        spark, spark__sql__shuffle__partitions="64", spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        assert tasks(10, 16)[0] == 1
        few, most = tasks(160, 16)
        assert few > 40 and most < 160 * 160 / 8


def test_rarest_gram_is_the_key(spark):
    t = spark.createDataFrame([(f"common{i}",) for i in range(50)] + [("common rare",)], "t string")
    p = spark.createDataFrame([("%common%rar%",), ("%common%",), ("%absent%common%",), ("%7",)], "p string")
    grams = t.withColumn("__gram", F.explode(joins._grams(F.col("t"), 3)))
    chosen = dict(rows(joins.rarest_grams(p, "p", grams, 3)))
    assert chosen["%common%rar%"] == "rar" and chosen["%7"] == "7" and len(chosen["%common%"]) == 3
    assert "%absent%common%" not in chosen
    assert rows(joins.pattern_matches(p, "p", t, "t"), "p", "t") == rows(p.crossJoin(t).where("t like p"), "p", "t")


def test_no_pattern_is_looked_up_by_an_empty_piece(spark):
    p = spark.createDataFrame([(x,) for x in ("", "%", "_%_", "%a", "\\%", "\ue001x", "%%")], "p string")
    runs = {r.p: r.runs for r in p.select("p", joins._runs(F.col("p")).alias("runs")).collect()}
    assert all("" not in found for found in runs.values())
    assert {k for k, found in runs.items() if not found} == {"", "%", "_%_", "%%", "\ue001x"}
    t = spark.createDataFrame([(x,) for x in ("", "a", "ba", "%", "\ue001x")], "t string")
    for prefix in (False, True):
        assert rows(joins.pattern_matches(p, "p", t, "t", prefix=prefix), "p", "t") == rows(p.crossJoin(t).where("t like p"), "p", "t")


def test_pattern_matches_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda chars, low, high: "".join(rng.choice(chars) for _ in range(rng.randint(low, high)))
    texts = sorted({word("ab*\\_", 0, 14) for _ in range(120)})
    t = spark.createDataFrame([(x,) for x in texts], "t string")
    for prefix in (False, True):
        patterns = sorted({("" if prefix else "%") + word("ab*_%", 0, 11) + "%" for _ in range(60)} | {"%", "%\\\\%" if not prefix else "a%"})
        p = spark.createDataFrame([(x,) for x in patterns], "p string")
        got = rows(joins.pattern_matches(p, "p", t, "t", prefix=prefix), "p", "t")
        brute = rows(p.crossJoin(t).where("t like p"), "p", "t")
        assert got == brute and brute


def test_pattern_matches_with_escaped_wildcards(spark):
    texts = ["a%b", "axb", "100_xy", "1000xy", "c\\d", "c\\%d", "", "\ue002", "50%"]
    patterns = ["a\\%b", "100\\_x%", "c\\\\d", "c\\\\\\%d", "c\\\\%d", "%\\%", "\ue002", "%\\\\%"]
    t, p = spark.createDataFrame([(x,) for x in texts], "t string"), spark.createDataFrame([(x,) for x in patterns], "p string")
    brute = rows(p.crossJoin(t).where("t like p"), "p", "t")
    assert rows(joins.pattern_matches(p, "p", t, "t"), "p", "t") == brute and len(brute) > 8


def test_double_keys_are_found_whatever_is_read(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    target = spark.createDataFrame([(1, "x")], "k int, v string")
    for df in (
        joins.unique_rows(twice.select("k"), "k", "test"), mutate.update_from(target, twice, "k", {}, {"v": F.lit("y")}),
        mutate.merge_upsert(target, twice, "k", {"v": F.col("v")}, {"k": F.col("k"), "v": F.col("v")}),
    ):
        with pytest.raises(Exception, match="several"):
            df.count()


def test_null_safe_merge_is_repeatable(spark):
    source = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    state = spark.createDataFrame([(2, "x")], "k int, v string")
    for _ in range(3):
        state = mutate.merge_upsert(state, source, "k", {"v": F.col("v")}, {"k": F.col("k"), "v": F.col("v")}, null_safe=True)
        assert rows(state) == [(1, "b"), (2, "x"), (None, "a")]


def test_newest_cutoffs_with_one_hot_time(spark):
    df = spark.range(5000).selectExpr("1 AS k", "timestamp_ntz'2024-01-01 00:00:00' AS ts")
    assert rows(ranking.newest_cutoffs(df, "k", "ts", [3, 5001]), "newest_3", "newest_5001") == [(datetime(2024, 1, 1), None)]


def test_unique_rows_raises_on_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert rows(joins.unique_rows(df, "k", "x")) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="several rows for key"):
        joins.unique_rows(df.union(df), "k", "x").collect()


def test_assigned_keys(spark):
    df = spark.range(500).select(F.concat(F.lit("c"), "id").alias("c")).repartition(7)
    old = spark.createDataFrame([(41,), (7,)], "id bigint")
    got = rows(keys.assign_keys(df, ["c"], "id", old), "id", "c")
    assert [g[0] for g in got] == list(range(42, 542))
    assert got == rows(keys.assign_keys(df.repartition(3), ["c"], "id", old), "id", "c")
    assert rows(keys.assign_keys(df.limit(1), ["c"], "id", old.limit(0)), "id") == [(1,)]
    ids = [r[0] for r in rows(keys.with_row_ids(df, "id", old), "id")]
    assert len(set(ids)) == 500 and min(ids) > 41


def test_delete_update_move(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, v string")
    k = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert rows(mutate.delete_keys(df, k, "id"), "v") == [("b",), ("c",)]
    assert rows(mutate.update_keys(df, k, "id", {"v": F.lit("z")}), "v") == [("b",), ("c",), ("z",)]
    assert rows(mutate.update_where(df, F.col("id") > 1, {"v": F.lit("z")}), "v") == [("a",), ("c",), ("z",)]
    assert rows(mutate.delete_where(df, F.col("id") > 1), "v") == [("a",), ("c",)]
    kept, archive = mutate.move_rows(df, df.limit(0), k, "id")
    assert rows(kept.union(archive)) == rows(df) and archive.count() == 1
    kept, archive = mutate.move_where(df, df.limit(0), F.col("id") > 1)
    assert rows(kept.union(archive)) == rows(df) and archive.count() == 1


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    write_tables({"t": df}, str(tmp_path))
    back = read_tables(spark, str(tmp_path), ["t"])["t"]
    assert rows(project_columns(back)) == [(1, "a")] and project_columns(back, "v").columns == ["v"]


def test_append_checks(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(ValueError):
        mutate.append_same_shape(df, df.withColumnRenamed("v", "w"))
    with pytest.raises(ValueError):
        mutate.append_rows(df, df.withColumnRenamed("v", "w"))
    assert rows(mutate.append_rows(df, df.select("v"))) == [(1, "a"), (None, "a")]
    assert rows(mutate.append_select(df, df, {"id": F.lit(9), "v": "v"})) == [(1, "a"), (9, "a")]


def test_update_from(spark):
    target = spark.createDataFrame([(1, "a", "-"), (2, "b", "-")], "id int, v string, by string")
    source = spark.createDataFrame([(1, None), (3, "z")], "id int, w string")
    assert rows(mutate.update_from(target, source, "id", {"v": "w"}, {"by": F.lit("me")})) == [(1, None, "me"), (2, "b", "-")]
    with pytest.raises(Exception, match="several rows"):
        mutate.update_from(target, source.union(source), "id", {"v": "w"}).collect()


def test_merge(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    source = spark.createDataFrame([(1, "x"), (3, "y"), (3, "z"), (None, "m")], "id int, w string")
    args = ("id", {"v": F.upper("w")}, {"id": F.col("id"), "v": F.col("w")})
    merged = mutate.merge_upsert(target, source, *args)
    assert rows(merged) == [(1, "X"), (2, "b"), (3, "y"), (3, "z"), (None, "m"), (None, "n")]
    with pytest.raises(Exception, match="several source rows"):
        mutate.merge_upsert(merged, source.where("id = 3"), *args).collect()
    once = mutate.merge_upsert(target, source.where("id = 1"), *args)
    assert rows(mutate.merge_upsert(once, source.where("id = 1"), *args)) == rows(once)


def test_merge_raises_when_a_target_row_is_matched_twice(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "id int, w string")
    with pytest.raises(Exception, match="several source rows"):
        mutate.merge_upsert(target, source, "id", {"v": F.col("w")}, {"id": F.col("id")}).collect()


def test_cascade_delete(spark):
    t = {
        "a": spark.createDataFrame([(1, 10), (2, 20)], "id int, b int"),
        "c": spark.createDataFrame([(100, 1), (200, 2)], "cid int, aid int"),
        "d": spark.createDataFrame([(100, "x"), (200, "y"), (None, "z")], "c int, v string"),
    }
    out = mutate.cascade_delete(
        t, "a", t["a"].where("id = 1").select("id"), "id", [("c", "a", "aid", "id"), ("d", "c", "c", "cid")]
    )
    assert rows(out["a"], "id") == [(2,)] and rows(out["c"], "cid") == [(200,)]
    assert rows(out["d"], "v") == [("y",), ("z",)]


def test_audit_and_log(spark):
    df = spark.createDataFrame([(1, None, "x")], "id int, a string, b string")
    row = audit_rows(df, "ACT", "T", [F.col("id"), F.col("a"), F.col("b")], None, AS_OF)
    trail = append_audit(make_table(spark, "audit_trail", [{"audit_id": 5}]), row)
    assert rows(trail.where("action = 'ACT'"), "table_nm", "created_by", "audit_type", "data1", "data2", "dt_created") == [
        ("T", "EOD_PROCESS", "E", "1||x", None, AS_OF)
    ]
    assert trail.where("action = 'ACT'").first()["audit_id"] > 5
    assert rows(run_log_row(spark, "J", AS_OF), "status", "remarks") == [("S", None)]
    assert rows(run_log_row(spark, "J", AS_OF, "bad"), "status", "remarks") == [("F", "bad")]


def test_enqueue(spark):
    queue = spark.createDataFrame([("1", "x")], "id string, v string")
    new, added = enqueue_requests(queue, spark.createDataFrame([("1", "y"), ("2", "z")], "id string, v string"), "id")
    assert rows(new) == [("1", "x"), ("2", "z")] and rows(added) == [("2", "z")]


def test_marks(spark):
    log = make_table(spark, "eod_log", [
        {"eod_proc_name": "A", "eod_date": ago(9), "status": "S"}, {"eod_proc_name": "A", "eod_date": ago(2), "status": "S"},
        {"eod_proc_name": "A", "eod_date": ago(1), "status": "F"}, {"eod_proc_name": "B", "eod_date": ago(1), "status": "F"},
    ])
    assert incremental.high_water_mark(log, "A") == ago(7)
    assert incremental.high_water_mark(log, "B") == incremental.high_water_mark(log, "C") == datetime(1990, 1, 1)
    jobs = spark.createDataFrame([("A",), ("B",), ("C",)], "eod_proc_name string")
    assert [r[1] for r in rows(incremental.last_success(log, jobs))] == [ago(7), datetime(1990, 1, 1), datetime(1990, 1, 1)]


def test_cascade_lookup_stops_at_a_found_null(spark):
    k = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "z")], "p string, q string")
    first = spark.createDataFrame([("a", None, 1), ("a", "late", 2)], "p string, v string, o int")
    second = spark.createDataFrame([("x", "second", 1)], "q string, v string, o int")
    steps = [lookup.Step(first, ("p",), F.col("v"), ("o",)), lookup.Step(second, ("q",), F.col("v"), ("o",))]
    assert rows(lookup.cascade_lookup(k, steps, "v", "n"), "p", "v", "n") == [
        ("a", None, 1), ("b", "second", 2), ("c", None, None)
    ]


def test_chunk_scan(spark):
    text = "HEAD0001" + "." * 70 + "HEAD0002 needle%" + "." * 62 + "x" * 400 + "needle% far"
    df = spark.createDataFrame([(1, text), (2, None)], "id int, t string")
    assert rows(lookup.chunk_scan(df, "t", "needle%", count=6), "segment", "code") == [(2, "HEAD0002")]
    assert [r[0] for r in rows(lookup.chunk_scan(df, "t", "needle%"), "segment")] == [2, 8]


def test_fallback_pattern(spark):
    k = spark.createDataFrame([("m", "EXM%", "EX**%"), ("q", "EXQ%", "EX**%")], "k string, s string, g string")
    items = spark.createDataFrame([("EXM1", 1), ("EXM2", 2), ("EX**9", 3)], "item string, v int")
    got = rows(lookup.fallback_pattern(k, "s", "g", items, "item", prefix=True), "k", "v")
    assert got == [("m", 1), ("m", 2), ("q", 3)]


def test_role_sets(spark):
    held = spark.createDataFrame(
        [(1, "V"), (1, "I"), (2, "V"), (2, "V"), (3, "V"), (3, "I"), (3, "S"), (4, None)], "u int, r string"
    )
    assert rows(roles.role_set(held, "u", "r", ["V", "I"])) == [(1,)]
    assert rows(roles.role_set(held, "u", "r", ["V", "I"], exact=False)) == [(1,), (3,)]
    assert rows(roles.role_set(held, "u", "r", ["V"])) == [(2,)]
    assert rows(roles.roles_held(held, "u", "r", 2)) == [(1,)]


def test_minus_is_null_safe_and_distinct(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(2,), (None,)], "x int")
    assert rows(roles.minus(a, b)) == [(1,)]
    assert rows(roles.minus(a, b, a)) == []
    assert rows(roles.minus(a, b.where("x = 2"))) == [(1,), (None,)]


def test_activity_rule(spark):
    data = [(s, m, a) for s in ("I", "A", None) for m in (True, False) for a in (True, False)]
    df = spark.createDataFrame(data, "s string, m boolean, a boolean")
    reset, stop = roles.activity_actions(F.col("s"), F.col("m"), F.col("a"))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in df.select("s", "m", "a", reset, stop).collect()}
    assert got == {(s, m, a): (m and a and s == "I", m and not a and s == "A") for s, m, a in data}


def test_entities_against_brute_force(spark):
    rng = random.Random(11)
    members = [(rng.randint(1, 30), rng.choice("abcdef"), rng.choice(["JO1", "JO2"])) for _ in range(70)]
    members += [(99, c, r) for c in "abcdef" for r in ("JO1", "JO2")] + [(31, None, "JO1"), (32, "a", "JO1"), (32, None, "JO2")]
    df = spark.createDataFrame(members, "g int, m string, r string")
    groups = {g for g, _, _ in members}
    sole = {}
    for g in groups:
        who = {m for g2, m, _ in members if g2 == g and m}
        if len(who) == 1:
            sole[next(iter(who))] = max(g, sole.get(next(iter(who)), 0))
    assert dict(rows(sole_member_group(df, "g", "m"), "m", "g")) == sole
    wanted = [(x, y) for x in "abcdef" for y in "abcxyz"]
    w = spark.createDataFrame(wanted, "x string, y string")
    expected = {}
    for x, y in wanted:
        fits = [g for g in groups if (g, x, "JO1") in members and (g, y, "JO2") in members]
        if fits:
            expected[(x, y)] = max(fits)
    for heavy in (1, 1000):
        got = joint_group(df, w, "g", "m", "r", "x", "y", heavy=heavy)
        assert {(r["x"], r["y"]): r["g"] for r in got.collect()} == expected


def test_resolve_entities(spark):
    matrix = make_table(spark, "r_custuser_matrix", [
        {"entity_id": 1, "relationship": "JO1", "user_info_id": 1}, {"entity_id": 2, "relationship": "JO1", "user_info_id": 1},
        {"entity_id": 3, "relationship": "JO1", "user_info_id": 1}, {"entity_id": 3, "relationship": "JO2", "user_info_id": 2},
    ])
    users = make_table(spark, "r_user_info", [{"user_info_id": 1, "clntnum": "A"}, {"user_info_id": 2, "clntnum": "B"}])
    pairs = spark.createDataFrame([("A", None), ("A", "B"), ("B", "A"), ("B", None)], "main string, joint string")
    assert rows(resolve_entities(pairs, matrix, users)) == [("A", "B", 3), ("A", None, 2), ("B", "A", -999), ("B", None, -999)]
