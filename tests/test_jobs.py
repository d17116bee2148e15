"""Jobs and streams on small files: golden counts, repeat runs, one batch against several."""

import dataclasses
import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.operators import dims, joins
from pipekit.operators.audit import AuditLog
from pipekit.operators.merge import DuplicateKeyError
from pipekit.plans import jobs
from pipekit.sinks import writers as wr
from pipekit.sources.formats import Stage
from pipekit.streaming.feed import ChangeLog, apply_to_folder
from pipekit.streaming.loads import FileLoad, ingest_status

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
SALES = T.StructType().add("order_id", T.LongType()).add("city", T.StringType()).add("amount", T.LongType())


def deliver(path, name, first, n=3):
    path.mkdir(parents=True, exist_ok=True)
    lines = ["order_id,city,amount"] + [f"{first + i},c{i},{10 * i}" for i in range(n)]
    (path / name).write_text("\n".join(lines) + "\n")


def load_of(spark, tmp_path, **options):
    return FileLoad(spark, Stage(str(tmp_path / "stage")), SALES, str(tmp_path / "rows"), str(tmp_path / "hist"), **options)


def test_incremental_counts(spark, tmp_path):
    load, seen = load_of(spark, tmp_path), []
    for i in range(3):
        deliver(tmp_path / "stage", f"sales_{i}.csv", 100 * i)
        load.run(f"l{i}", T1)
        seen.append(load.loaded().count())
        assert load.run(f"again{i}", T1).count() == 0
    assert seen == [3, 6, 9]
    assert rows(load.load_history().select("file_name", "status", "rows_loaded")) == [(f"sales_{i}.csv", "LOADED", 3) for i in range(3)]


def test_same_name_in_two_folders(spark, tmp_path):
    load = load_of(spark, tmp_path)
    for day, first in (("d1", 1), ("d2", 50)):
        deliver(tmp_path / "stage" / day, "sales.csv", first)
        load.run(day, T1)
    assert load.loaded().count() == 6
    assert rows(load.load_history().select("file_name")) == [("d1/sales.csv",), ("d2/sales.csv",)]


def test_history_is_kept_as_long_as_asked(spark, tmp_path):
    load = load_of(spark, tmp_path)
    deliver(tmp_path / "stage", "a.csv", 1)
    load.run("l1", T1)
    assert load.pending(T1 + dt.timedelta(days=63)).isEmpty()
    assert load.pending(T1 + dt.timedelta(days=4000)).isEmpty()
    load = dataclasses.replace(load, remember_days=64)
    assert load.pending(T1 + dt.timedelta(days=65)).count() == 1


def test_unfinished_load_does_not_count(spark, tmp_path):
    load = load_of(spark, tmp_path)
    deliver(tmp_path / "stage", "a.csv", 1)
    load.run("l1", T1)
    spark.createDataFrame([(1, "x", 1, None, "f", "ok")], "order_id bigint, city string, amount bigint, _corrupt_record string, source_file string, row_state string"
                          ).write.partitionBy("row_state").parquet(str(tmp_path / "rows" / "load_id=broken"))
    assert load.loaded().count() == 3


def test_bad_rows_are_kept_aside(spark, tmp_path):
    load = load_of(spark, tmp_path, on_error="continue")
    deliver(tmp_path / "stage", "a.csv", 1)
    (tmp_path / "stage" / "b.csv").write_text("order_id,city,amount\n7,x,many\n8,y,5\n")
    load.run("l1", T1)
    assert load.loaded().count() == 4 and rows(load.rejects().select("_corrupt_record")) == [("7,x,many",)]
    assert rows(load.load_history().select("file_name", "status", "errors_seen", "first_error").na.fill("")) == [
        ("a.csv", "LOADED", 0, ""), ("b.csv", "PARTIALLY_LOADED", 1, "7,x,many")]


def test_abort_saves_no_history(spark, tmp_path):
    load = load_of(spark, tmp_path)
    (tmp_path / "stage").mkdir()
    (tmp_path / "stage" / "b.csv").write_text("order_id,city,amount\n7,x,many\n")
    with pytest.raises(Exception):
        load.run("l1", T1)
    assert load.load_history().isEmpty()


def test_stream_in_one_or_several_batches(spark, tmp_path):
    results = []
    for max_files in (None, 1):
        root = tmp_path / f"m{max_files}"
        load, calls = load_of(spark, root), []
        for i in range(3):
            deliver(root / "stage", f"s{i}.csv", 100 * i, n=2 + i)
        query = load.stream(f"s_{max_files}", str(root / "cp"), max_files=max_files, after=lambda df, load_id: calls.append(load_id))
        assert query.awaitTermination(120)
        assert len(calls) == (3 if max_files else 1)
        deliver(root / "stage", "late.csv", 900)
        assert load.stream(f"s_{max_files}", str(root / "cp")).awaitTermination(120)
        results.append(rows(load.loaded().select(SALES.names)))
        assert {r["file_name"]: r["rows_loaded"] for r in load.load_history().collect()} == {
            "s0.csv": 2, "s1.csv": 3, "s2.csv": 4, "late.csv": 3}
    assert results[0] == results[1] and len(results[0]) == 12


def test_status_keeps_every_batch(spark, tmp_path):
    for i in range(5):
        deliver(tmp_path / "in", f"f{i}.csv", 10 * i)
    load = FileLoad(spark, Stage(str(tmp_path / "in")), SALES, str(tmp_path / "t"), str(tmp_path / "h"))
    assert ingest_status(spark, load).isEmpty()
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        query = load.stream("status", str(tmp_path / "cp"), max_files=1)
        assert query.awaitTermination(120) and len(query.recentProgress) <= 2
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert rows(ingest_status(spark, load), "batch_id", "input_rows") == [(i, 3) for i in range(5)]
    deliver(tmp_path / "in", "late.csv", 90)
    assert load.stream("status", str(tmp_path / "cp")).awaitTermination(120)
    assert rows(ingest_status(spark, load), "batch_id", "input_rows") == [(i, 3) for i in range(6)]


def test_fixed_rate_stream(spark, tmp_path):
    load = load_of(spark, tmp_path)
    deliver(tmp_path / "stage", "a.csv", 1)
    query = load.stream("timed", str(tmp_path / "cp"), {"processingTime": "1 second"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert load.loaded().count() == 3


def test_star_golden(spark, tmp_path):
    stage = Stage(str(tmp_path / "in"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "s.csv").write_text(
        "customer_id,customer_name,product,quantity,unit_price\n1,A,p,2,10\n2,B,q,1,5\n3,C,r,3,7\n4,D,s,1,1\n1,A,t,4,2\n")
    schema = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("customer_name", T.StringType()),
                           T.StructField("product", T.StringType()), T.StructField("quantity", T.LongType()),
                           T.StructField("unit_price", T.LongType())])
    star = jobs.Star(str(tmp_path / "star"), {"dim_customer": ("customer_key", ["customer_id", "customer_name"])}, "fact",
                     ["product"], {"total": "quantity * unit_price"})
    log = AuditLog(spark, str(tmp_path / "audit"))
    result = jobs.stage_then_star(spark, stage, schema, str(tmp_path / "staging"), star, log, "r1")
    assert (result.status, result.source_count, result.target_count, result.match_status) == ("SUCCESS", 5, 5, "MATCH")
    assert spark.read.parquet(star.path("dim_customer")).count() == 4
    assert rows(spark.read.parquet(star.path("fact")).select("total")) == [(1,), (5,), (8,), (20,), (21,)]
    assert log.read().count() == 2 and log.latest("star_load").first()["status"] == "SUCCESS"


def orders_star(tmp_path):
    return jobs.Star(str(tmp_path / "star"), {"customers": ("customer_key", ["name", "city"])}, "orders", ["order_id"], {"price": "price"})


def test_idempotent_star_and_failures(spark, tmp_path):
    staging, star, log = str(tmp_path / "staging"), orders_star(tmp_path), AuditLog(spark, str(tmp_path / "audit"))
    wr.reload(spark.createDataFrame([(i, f"n{i % 3}", f"c{i % 3}", 5) for i in range(8)], "order_id int, name string, city string, price int"), staging)
    assert jobs.run_star_new(spark, staging, star, log, "r1").ok
    assert jobs.run_star_new(spark, staging, star, log, "r2").target_count == 8
    assert spark.read.parquet(star.path("customers")).count() == 3
    wr.reload(spark.read.parquet(staging).where("order_id < 0"), str(tmp_path / "empty"))
    failed = jobs.run_star_new(spark, str(tmp_path / "empty"), star, log, "r3")
    assert (failed.status, failed.message) == ("FAILURE", "staging is empty")
    wr.reload(spark.createDataFrame([(99, None, "c0", 5)], "order_id int, name string, city string, price int"), str(tmp_path / "nulls"))
    lost = jobs.run_star_new(spark, str(tmp_path / "nulls"), star, log, "r4")
    assert lost.status == "FAILURE" and "1 staged rows are missing" in lost.message
    assert rows(log.read().select("run_id", "status")) == [("r1", "SUCCESS"), ("r2", "SUCCESS"), ("r3", "FAILURE"), ("r4", "FAILURE")]


def test_null_members_keep_their_facts(spark, tmp_path):
    staged = spark.createDataFrame([(1, "a", "x", 5), (2, None, "y", 6), (3, None, None, 7), (4, "a", None, 8), (5, None, "y", 9)],
                                   "order_id int, name string, city string, price int")
    dim = {"customers": ("customer_key", ["name", "city"])}
    for skewed in (False, True):
        star = jobs.load_star(staged, dim, ["order_id"], {"price": "price"}, skewed=skewed)
        assert rows(star["fact"].join(star["customers"], "customer_key").select("order_id", "name", "city").na.fill("-")) == [
            (1, "a", "x"), (2, "-", "y"), (3, "-", "-"), (4, "a", "-"), (5, "-", "y")]
        assert rows(jobs.load_star(staged, dim, ["order_id"], {"price": "price"}, star, skewed=skewed)["fact"]) == rows(star["fact"])
    plain = jobs.load_star(staged, dim, ["order_id"], {"price": "price"}, null_safe=False)
    assert rows(plain["fact"].select("order_id")) == [(1,)]
    wide = joins.lookup_join(staged, star["customers"], ["name", "city"], skewed=True, small_rows=0, share=3, null_safe=True)
    assert rows(wide.select("order_id")) == [(1,), (2,), (3,), (4,), (5,)]
    safe, log = dataclasses.replace(orders_star(tmp_path), null_safe=True), AuditLog(spark, str(tmp_path / "audit"))
    once = jobs.run_star_once(spark, staged, safe, log, "r1", strict=True)
    assert (once.status, once.target_count, once.match_status) == ("SUCCESS", 5, "MATCH")
    more = staged.unionByName(spark.createDataFrame([(6, "b", None, 1)], staged.schema))
    wr.reload(more, str(tmp_path / "staging"))
    assert [jobs.run_star_new(spark, str(tmp_path / "staging"), safe, log, r).target_count for r in ("r2", "r3")] == [6, 6]
    twice = star["customers"].union(star["customers"].where("name is null and city is null"))
    with pytest.raises(DuplicateKeyError):
        dims.load_fact(staged, [(twice, ["name", "city"])], {"order_id": F.col("order_id")}, null_safe=True)


def test_missing_file_is_an_audited_failure(spark, tmp_path):
    log = AuditLog(spark, str(tmp_path / "audit"))
    result = jobs.stage_file(spark, Stage(str(tmp_path)), "none.csv", SALES, str(tmp_path / "staging"), log, "r1")
    assert not result.ok and log.read().first()["status"] == "FAILURE"


def test_strict_mismatch_fails(spark, tmp_path):
    staged = spark.createDataFrame([(1, "a", "x", 5), (2, None, "y", 6)], "order_id int, name string, city string, price int")
    log = AuditLog(spark, str(tmp_path / "audit"))
    loose = jobs.run_star_once(spark, staged, orders_star(tmp_path), log, "r1")
    assert (loose.status, loose.match_status) == ("SUCCESS", "MISMATCH")
    assert jobs.run_star_once(spark, staged, orders_star(tmp_path), log, "r2", strict=True).status == "FAILURE"


def test_debounced_loads(spark, tmp_path):
    staging, root = str(tmp_path / "staging"), str(tmp_path / "t")
    targets = {"customer": ["customer_id"], "claim": ["claim_id", "customer_id"]}

    def arrive(load):
        new = spark.createDataFrame([(load, 10 * load + i, 100 * load + i) for i in range(5)],
                                    "load_id int, customer_id int, claim_id int")
        jobs.add_to_staging(new, staging)

    def check(minute):
        return jobs.check_and_load(spark, staging, f"{root}/checks", targets, root, f"{root}/audit", T1 + dt.timedelta(minutes=minute))

    arrive(1)
    assert [check(i) for i in range(4)] == ["WAIT", "WAIT", "CALL SP", "IDLE"]
    arrive(2)
    assert [check(i) for i in range(4, 9)] == ["WAIT", "WAIT", "WAIT", "CALL SP", "IDLE"]
    assert spark.read.parquet(f"{root}/claim").count() == 10
    counts = rows(spark.read.parquet(f"{root}/audit").select("load_id", "target_table", "source_count", "target_count"))
    assert counts == [(1, "claim", 5, 5), (1, "customer", 5, 5), (2, "claim", 5, 5), (2, "customer", 5, 5)]


def staged_queue(spark, tmp_path):
    staging, root = str(tmp_path / "staging"), str(tmp_path / "t")
    jobs.add_to_staging(spark.createDataFrame([(1, i) for i in range(5)], "load_id int, claim_id int"), staging)
    return staging, root, {"claim": ["claim_id"]}


def test_flagged_load_cut_before_its_audit_row(spark, tmp_path, monkeypatch):
    staging, root, targets = staged_queue(spark, tmp_path)

    def lost(*_):
        raise RuntimeError("executor lost")
    monkeypatch.setattr(jobs, "load_target_audit", lost)
    with pytest.raises(RuntimeError):
        jobs.load_flagged(spark, staging, targets, root, f"{root}/audit", 1)
    monkeypatch.undo()
    jobs.load_flagged(spark, staging, targets, root, f"{root}/audit", 2)
    assert rows(spark.read.parquet(f"{root}/claim").select("claim_id", "run_id")) == [(i, 2) for i in range(5)]


def test_flagged_load_cut_while_turning_flags(spark, tmp_path, monkeypatch):
    staging, root, targets = staged_queue(spark, tmp_path)
    real, calls = jobs._settle, []

    def lost(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        real(*args)
    monkeypatch.setattr(jobs, "_settle", lost)
    with pytest.raises(RuntimeError):
        jobs.load_flagged(spark, staging, targets, root, f"{root}/audit", 1)
    monkeypatch.undo()
    jobs.add_to_staging(spark.createDataFrame([(2, 77)], "load_id int, claim_id int"), staging)
    jobs.load_flagged(spark, staging, targets, root, f"{root}/audit", 2)
    assert rows(spark.read.parquet(f"{root}/claim").select("claim_id", "run_id")) == [(i, 1) for i in range(5)] + [(77, 2)]
    assert jobs.waiting_rows(spark, staging) is None


def test_change_log_consumers(spark, tmp_path):
    schema = "id int, v string"
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], schema)
    two = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], schema)
    three = spark.createDataFrame([(2, "x"), (4, "e")], schema)
    log, target = ChangeLog(spark, str(tmp_path / "log")), str(tmp_path / "target")
    assert not log.has_data("c")
    wr.reload(one, target)
    log.capture(one, two, ["id"])
    log.capture(two, three, ["id"])
    assert log.pending("c").count() == log.pending("c").count() == 7
    assert log.consume("c", apply_to_folder(spark, target, ["id"])) is True
    assert log.consume("c", apply_to_folder(spark, target, ["id"])) is False
    assert rows(spark.read.parquet(target)) == rows(three)
    assert log.pending("other").count() == 7


def test_failed_action_keeps_the_offset(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"))
    log.capture(spark.range(0), spark.range(3), ["id"])

    def fail(_):
        raise RuntimeError("no")
    with pytest.raises(RuntimeError):
        log.consume("c", fail)
    assert log.has_data("c")


def test_scd2_in_folders(spark, tmp_path):
    root = str(tmp_path / "h")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    jobs.run_scd2(spark, root, first, ["id"], T1)
    out = jobs.run_scd2(spark, root, first.withColumn("v", F.when(F.col("id") == 1, "z").otherwise(F.col("v"))), ["id"], T2)
    assert rows(out.select("id", "v", "is_current")) == [(1, "a", False), (1, "z", True), (2, "b", True)]


def test_copy_table_repeats_or_adds(spark, tmp_path):
    path = str(tmp_path / "copy")
    assert [jobs.copy_table(spark, spark.range(3), path) for _ in range(2)] == [3, 6]
    assert jobs.copy_table(spark, spark.range(5), path, ["id"]) == 8


def test_normalise_refuses_a_second_load(spark, tmp_path):
    from pipekit.operators.dims import DimensionSpec
    flat = spark.createDataFrame([(1, "India"), (2, "India"), (3, None)], "customer_id int, country string")
    spec = [DimensionSpec("country", "country", "country_code", "CY")]
    out = jobs.normalise_flat(spark, flat, spec, ["customer_id"], str(tmp_path / "n"))
    assert rows(out["country"]) == [("CY01", "India")]
    assert sorted((r["customer_id"], r["country_code"]) for r in out["fact"].collect() if r["country_code"]) == [(1, "CY01"), (2, "CY01")]
    assert out["fact"].count() == 3
    with pytest.raises(FileExistsError):
        jobs.normalise_flat(spark, flat, spec, ["customer_id"], str(tmp_path / "n"))
