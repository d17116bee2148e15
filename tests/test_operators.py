"""Operators against step-by-step results on small inputs."""

import datetime as dt
import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pipekit import functions as pf
from pipekit.operators import aggregates as ag
from pipekit.operators import audit, changes, dims, history, joins, keys, merge, quality
from pipekit.session import shuffle_partitions

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)


def test_bands_and_cut_offs(spark):
    df = spark.createDataFrame([(120000,), (100000,), (70000,), (10,), (None,)], "salary int")
    got = df.select(pf.band("salary", [(100000, "HIGH"), (70000, "MEDIUM")], "LOW").alias("b"))
    assert [r[0] for r in got.collect()] == ["HIGH", "HIGH", "MEDIUM", "LOW", "LOW"]
    with pytest.raises(ValueError):
        pf.band("salary", [(1, "a"), (2, "b")], "c")
    marks = spark.createDataFrame([("a", 7), ("b", 8)], "name string, marks int")
    assert rows(marks.select("name", pf.classify("marks", 7, inclusive=False))) == [("a", "FAIL"), ("b", "PASS")]
    assert rows(marks.select("name", pf.classify("marks", 7, inclusive=True))) == [("a", "PASS"), ("b", "PASS")]


def test_text_functions(spark):
    df = spark.createDataFrame([("a/b/c.tar.GZ",), ("plain",), (".hidden",)], "p string")
    got = df.select(pf.base_name("p"), pf.stem("p"), pf.extension("p"), pf.first_segment("p"), pf.last_segment("p")).collect()
    assert [tuple(r) for r in got] == [("c.tar.GZ", "c.tar", ".gz", "a", "c.tar.GZ"), ("plain", "plain", "", "plain", "plain"),
                                       (".hidden", ".hidden", "", ".hidden", ".hidden")]
    labels = spark.range(8, 12).select(pf.coded_label("C", F.col("id") * 10)).collect()
    assert [r[0] for r in labels] == ["C80", "C90", "C100", "C110"]


def test_row_digest_tells_neighbours_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("ab", None), ("ab", ""), (None, "ab"), ("a|1:b", "c")], "x string, y string")
    assert df.select(pf.row_digest(["x", "y"]).alias("d")).distinct().count() == 6


def test_time_functions(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 12, 31, 23, 59, 59, 900000), dt.datetime(2024, 1, 1, 0, 0, 0, 100000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert tuple(df.select(pf.year_diff("a", "b"), pf.second_diff("a", "b")).first()) == (1, 1)
    assert df.select(pf.local_clock("a", "Asia/Kolkata", " IST")).first()[0] == "05:29:59 AM IST"
    assert df.select(pf.stamp("b")).first()[0] == "20240101_000000"


def test_validation(spark):
    df = spark.createDataFrame([("a", 5), (None, 5), ("b", 11), ("c", -1), ("d", None)], "student string, marks int")
    rules = [quality.required("student"), quality.required("marks"), quality.in_range("marks", 0, 10)]
    valid, rejects = quality.split_valid(df, rules)
    assert rows(valid) == [("a", 5)]
    assert sorted(r["error_reason"] for r in rejects.collect()) == [
        "marks is required", "marks out of range", "marks out of range", "student is required"]


def test_duplicate_report_golden(spark):
    people = [(f"S{i:02d}", f"n{i}", "IT", str(80 + i % 7)) for i in range(20)]
    data = [(i, *r) for i, r in enumerate(people + people[:10])]
    df = spark.createDataFrame(data, "row_no int, id string, name string, dept string, marks string")
    report = quality.duplicate_report(df, ["id", "name", "dept", "marks"], ["row_no"], "marks")
    assert report.clean.count() == 20 and report.duplicates.count() == 10
    assert tuple(report.summary.first()) == (20, 10, float(sum(int(r[3]) for r in people)))
    assert rows(report.duplicates.select("row_no", "occurrences")) == [(20 + i, 2) for i in range(10)]


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", None])), min_size=1, max_size=60))
def test_duplicate_report_against_loop(spark, data):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "n int, x string, y string")
    report = quality.DuplicateReport(df, ["x", "y"], ["n"], small_rows=len(data) % 2 * 1000)
    seen, clean, dups = set(), [], []
    for i, r in enumerate(data):
        (dups if r in seen else clean).append(i)
        seen.add(r)
    assert [r[0] for r in rows(report.clean.select("n"))] == clean
    assert [r[0] for r in rows(report.duplicates.select("n"))] == dups


def fold(counts, threshold=3):
    out, previous = [], None
    for c in counts:
        found, quiet, action = audit.next_check(previous, c, threshold)
        out.append((found, quiet, action))
        previous = (c, quiet)
    return out


def test_quiet_period_golden(spark):
    assert [a for _, _, a in fold([5, 5, 5])] == ["WAIT", "WAIT", "CALL SP"]
    assert [a for _, _, a in fold([0, 5, 5, 5, 5])] == ["IDLE", "WAIT", "WAIT", "WAIT", "CALL SP"]


def test_quiet_period_against_fold(spark):
    random.seed(7)
    data, want = [], {}
    for series in range(40):
        counts = [random.choice([0, 1, 1, 1, 2]) for _ in range(random.randint(1, 40))]
        at = T1
        for c, step in zip(counts, fold(counts)):
            at += dt.timedelta(hours=random.choice([1, 5, 30]))
            data.append((series, at, c))
            want[(series, at)] = step
    df = spark.createDataFrame(data, "series int, at timestamp_ntz, c bigint")
    got = {(r["series"], r["at"]): (r["new_record_found"], r["quiet_checks"], r["action"])
           for r in audit.quiet_period(df, "at", "c", ["series"]).collect()}
    assert got == want


def test_quiet_period_sees_swap_with_extra_column(spark):
    data = [(T1 + dt.timedelta(minutes=i), 5, load) for i, load in enumerate([1, 1, 2, 2])]
    df = spark.createDataFrame(data, "at timestamp_ntz, c bigint, load int")
    plain = [r["action"] for r in audit.quiet_period(df, "at", "c").orderBy("at").collect()]
    strict = [r["action"] for r in audit.quiet_period(df, "at", "c", also=["load"]).orderBy("at").collect()]
    assert plain == ["WAIT", "WAIT", "CALL SP", "CALL SP"] and strict == ["WAIT"] * 4


@FEW
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=80, unique=True), st.integers(1, 5))
def test_dense_keys(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(parts)
    got = rows(keys.dense_keys(df, ["v"], "k", 10).select("k", "v"))
    assert got == [(10 + i, v) for i, v in enumerate(sorted(values))]


def test_dense_keys_with_hot_prefix(spark):
    df = spark.range(3000).select((F.col("id") % 3 > 0).cast("int").alias("hot"), "id")
    got = keys.dense_keys(df, ["hot", "id"], "k").orderBy("k").collect()
    assert [r["k"] for r in got] == list(range(1, 3001))
    assert [(r["hot"], r["id"]) for r in got] == sorted((r["hot"], r["id"]) for r in got)


def test_coded_keys_beyond_the_width(spark):
    df = spark.range(120).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("city"))
    codes = [r["code"] for r in keys.coded_keys(df, "city", "C").collect()]
    assert len(set(codes)) == 120 and "C01" in codes and "C120" in codes


@FEW
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3, None, 9]), st.integers(0, 5)), max_size=60), st.sampled_from(["inner", "left"]))
def test_skewed_join_equals_plain(spark, data, how):
    left = spark.createDataFrame(data, "k int, v int")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, w string")
    plain = sorted(map(repr, joins.lookup_join(left, right, "k", how).collect()))
    split = sorted(map(repr, joins.lookup_join(left, right, "k", how, skewed=True, share=4, small_rows=0).collect()))
    assert plain == split


def test_heavy_keys_are_few(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"))
    assert rows(joins.heavy_keys(df, ["k"], 10)) == [(0,)]


def test_shuffle_partitions():
    assert shuffle_partitions(10, 8) == 8
    assert 300_000 < shuffle_partitions(100 * 10**12, 4000) < 500_000


def test_size_checks(spark):
    assert joins.is_small(spark.range(10), 10) and not joins.is_small(spark.range(11), 10)
    wide = spark.range(5).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert not joins.is_small(wide, 10, 2000)


def merge_tables(spark):
    target = spark.createDataFrame([(6001, "A", 10, "2023-01-01"), (6002, "B", 20, "2023-01-01"), (6003, "C", 30, "2023-01-01")],
                                   "employee_id int, city string, salary int, updated_date string")
    source = spark.createDataFrame([(6002, "B2", 21), (6003, "C", 33), (6004, "D", 40), (6005, "E", 50)], "employee_id int, city string, salary int")
    return target, source


@pytest.mark.parametrize("small_rows", [0, 1000])
def test_upsert_golden(spark, small_rows):
    target, source = merge_tables(spark)
    out = merge.upsert(target, source, ["employee_id"], {"updated_date": F.lit("2024-01-01")}, small_rows=small_rows)
    assert rows(out) == [
        (6001, "A", 10, "2023-01-01"), (6002, "B2", 21, "2024-01-01"), (6003, "C", 33, "2024-01-01"),
        (6004, "D", 40, "2024-01-01"), (6005, "E", 50, "2024-01-01")]
    again = merge.upsert(out, source, ["employee_id"], {"updated_date": F.lit("2024-01-01")}, small_rows=small_rows)
    assert rows(again) == rows(out)


def test_upsert_refuses_repeated_source_keys(spark):
    target, source = merge_tables(spark)
    with pytest.raises(merge.DuplicateKeyError):
        merge.upsert(target, source.unionByName(source), ["employee_id"])


def test_update_and_delete_keep_null_conditions(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    assert rows(merge.delete_rows(df, F.col("v") > 3).select("id")) == [(1,)]
    assert [r["v"] for r in merge.update_rows(df, F.col("v") > 3, {"v": F.lit(9)}).orderBy("id").collect()] == [None, 9]


def test_scd2_golden(spark):
    source = spark.createDataFrame([(1001, "a", "Pune", 10), (1002, "b", "Delhi", 20), (1003, "c", None, 30)], "id int, name string, city string, pay int")
    first = history.scd2_initial(source, T1)
    changed = source.withColumn("city", F.when(F.col("id") == 1001, "Goa").otherwise(F.col("city")))
    second = history.scd2_apply(first, changed, ["id"], T2)
    versions = rows(second.where("id = 1001").select("city", "valid_from", "valid_to", "is_current"))
    assert versions == [("Goa", T2, dt.datetime(9999, 12, 31, 23, 59, 59), True), ("Pune", T1, T2, False)]
    assert second.count() == 4
    third = history.scd2_apply(second, changed, ["id"], T3)
    assert third.count() == 4 and third.where("is_current").count() == 3


def test_scd2_one_current_version_and_no_overlap(spark):
    random.seed(3)
    state = history.scd2_initial(spark.createDataFrame([(i, i % 3) for i in range(10)], "id int, v int"), T1)
    for month in range(2, 6):
        source = spark.createDataFrame([(i, random.randint(0, 2)) for i in random.sample(range(14), 9)], "id int, v int")
        state = spark.createDataFrame(history.scd2_apply(state, source, ["id"], dt.datetime(2024, month, 1)).collect(), state.schema)
    spans = {}
    for r in state.collect():
        spans.setdefault(r["id"], []).append((r["valid_from"], r["valid_to"], r["is_current"]))
    for versions in spans.values():
        versions.sort()
        assert sum(v[2] for v in versions) == 1
        assert all(a[1] == b[0] for a, b in zip(versions, versions[1:]))


def test_change_feed_round_trip(spark):
    before = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "id int, name string, pay int")
    after = spark.createDataFrame([(1, "a", 10), (2, "b", 25), (4, "d", 40)], "id int, name string, pay int")
    diff = changes.diff_snapshots(before, after, ["id"])
    assert rows(diff.select("id", "change_action", "is_update")) == [
        (2, "DELETE", True), (2, "INSERT", True), (3, "DELETE", False), (4, "INSERT", False)]
    assert rows(changes.apply_changes(before, diff, ["id"])) == rows(after)
    assert changes.diff_snapshots(after, after, ["id"]).isEmpty()


def test_dimension_load_is_idempotent(spark):
    staged = spark.createDataFrame([("A", "Pune"), ("B", None), ("A", "Pune")], "name string, city string")
    first = dims.load_dimension(staged, ["name", "city"], "key")
    assert rows(first.select("key", "name")) == [(1, "A"), (2, "B")]
    assert dims.load_dimension(staged, ["name", "city"], "key", first).isEmpty()
    plain = dims.load_dimension(staged, ["name", "city"], "key", first, null_safe=False)
    assert rows(plain.select("key", "name")) == [(3, "B")]
    assert dims.load_dimension(staged, ["name", "city"], "key", first, only_new=False).count() == 2


def test_fact_lookup_refuses_two_spellings(spark):
    staged = spark.createDataFrame([(1, 7)], "order_id int, customer_id int")
    dim = spark.createDataFrame([(1, 7), (2, 7)], "key int, customer_id int")
    with pytest.raises(merge.DuplicateKeyError):
        dims.load_fact(staged, [(dim, ["customer_id"])], {"order_id": F.col("order_id"), "key": F.col("key")})


def test_aggregates(spark):
    df = spark.createDataFrame([("x", "1"), ("x", "bad"), ("y", "2.5")], "k string, v string")
    assert ag.tolerant_sum(df, "v").first()[0] == 3.5
    assert rows(ag.latest_row(df, ["v"], ["k"])) == [("x", "bad"), ("y", "2.5")]
    assert keys.next_id(spark.createDataFrame([], "id int"), "id").first()[0] == 1
    assert rows(joins.cross_values(df.select("k").distinct(), "t", ["p", "q"])) == [("x", "p"), ("x", "q"), ("y", "p"), ("y", "q")]


def test_run_history_and_final_status(spark):
    runs = spark.createDataFrame([
        ("t", "SUCCEEDED", T1, T1, T1 + dt.timedelta(seconds=61), None), ("t", "OTHER", T2, None, None, "e")],
        "task_name string, state string, scheduled_time timestamp_ntz, start_time timestamp_ntz, completed_time timestamp_ntz, error_message string")
    out = audit.run_history(runs, "Asia/Kolkata", " IST", upcoming=5)
    got = [(r["execution_status"], r["scheduled_clock"], r["execution_seconds"]) for r in out.orderBy("scheduled_time").collect()]
    assert got[0] == ("SUCCESS", "05:30:00 AM IST", 61) and got[1] == ("OTHER", "05:30:00 AM IST", None)
    assert [g[0] for g in got[2:]] == ["UPCOMING"] * 5 and got[2][1] == "05:31:00 AM IST"
    states = spark.createDataFrame([("1", "SUCCEEDED"), ("2", "SUCCEEDED"), ("3", "EXECUTING"), ("4", "FAILED")], "run_id string, state string")
    log = spark.createDataFrame([("1", "SUCCESS"), ("4", "SUCCESS")], "run_id string, status string")
    assert rows(audit.final_status(states, log).select("run_id", "final_status")) == [
        ("1", "SUCCESS"), ("2", "FAILURE"), ("3", "RUNNING"), ("4", "FAILURE")]
    assert rows(audit.upcoming_points(F.lit(T1).cast("timestamp_ntz"), 2, 5, spark)) == [
        (1, T1 + dt.timedelta(minutes=5)), (2, T1 + dt.timedelta(minutes=10))]


def test_reconcile_states(spark):
    assert audit.reconcile(spark.range(5), spark.range(5)).first()["match_status"] == "MATCH"
    assert audit.reconcile(spark.range(5), spark.range(4)).first()["match_status"] == "MISMATCH"
    assert tuple(audit.missing_rows(spark.range(5), spark.range(3), ["id"]).first()) == (2, "FAILURE")
