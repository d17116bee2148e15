"""State that outlasts a run: zones, content keys, consumed files, purges, ticks; and runs that are cut short."""

import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.operators import audit, quality
from pipekit.operators.zones import ZoneMap
from pipekit.plans.consumed import ConsumedLoad
from pipekit.sinks.files import remove_files
from pipekit.sources import scans
from pipekit.sources.formats import Stage
from pipekit.sources.provenance import ContentIndex, content_keys
from pipekit.streaming import loads
from pipekit.streaming.feed import ChangeLog
from pipekit.streaming.loads import FileLoad
from pipekit.streaming.quiet import start_checks
from pipekit.streaming.scheduled import at_rate, run_ticks, run_until

AS_OF = dt.datetime(2024, 1, 1)


def zoned(spark, tmp_path):
    held = ZoneMap(spark, f"{tmp_path}/fact", f"{tmp_path}/zones", "id")
    spark.range(0, 1000).withColumn("v", F.col("id") % 3).repartitionByRange(10, "id").write.parquet(held.folder)
    return held


def test_zones_name_the_files_that_can_hold_a_key(spark, tmp_path):
    held = zoned(spark, tmp_path)
    assert held.refresh() == 10 and held.refresh() == 0
    files = {f for f in held.files_for(spark.createDataFrame([(5,), (7,), (990,), (None,), (5000,)], "id long"))}
    assert 0 < len(files) <= 3
    read = spark.read.parquet(*files)
    assert read.where("id in (5, 7, 990)").count() == 3
    assert held.files_for(spark.createDataFrame([(2000,)], "id long")) == [] == held.files_for(spark.createDataFrame([], "id long"))
    assert len(held.files_for(spark.range(0, 1000, 7), ranges=2)) == 10
    staged = spark.createDataFrame([(5,), (None,), (1000,), (1000,)], "id long")
    assert sorted((r.id for r in held.missing(staged, ["id"]).collect()), key=repr) == [1000, 1000, None]


def test_a_file_without_zone_is_read_and_a_lost_one_is_not(spark, tmp_path):
    held = zoned(spark, tmp_path)
    held.refresh()
    spark.range(5000, 5010).withColumn("v", F.lit(1).cast("long")).coalesce(1).write.mode("append").parquet(held.folder)
    assert held.missing(spark.range(5005, 5015), ["id"]).count() == 5
    assert len(held.files_for(spark.range(1))) == 2  # the one that holds 0, and the unknown one
    assert held.refresh() == 1 and len(held.files_for(spark.range(1))) == 1
    gone = held.files_for(spark.range(1))[0]
    os.remove(gone.removeprefix("file:"))
    assert held.files_for(spark.range(1)) == [] and held.missing(spark.range(1), ["id"]).count() == 1
    nothing = ZoneMap(spark, f"{tmp_path}/no-such", f"{tmp_path}/z2", "id")
    assert nothing.refresh() == 0 and nothing.missing(spark.range(3), ["id"]).count() == 3


def test_content_keys_are_taken_once_for_each_file(spark, tmp_path):
    stage = tmp_path / "stage"
    stage.mkdir()
    for name in "abc":
        (stage / f"{name}.csv").write_text(f"{name}\n1\n")
    index = ContentIndex(spark, str(stage), f"{tmp_path}/keys")
    assert index.refresh() == 3 and index.refresh() == 0
    assert rows(index.keys()) == rows(content_keys(spark, str(stage)))
    (stage / "b.csv").write_text("other\n")
    (stage / "c.csv").unlink()
    assert index.refresh() == 1
    assert rows(index.keys()) == rows(content_keys(spark, str(stage))) and index.keys().count() == 2
    # A run cut short after its keys were saved saves the same ones again; there is still one key for a file.
    spark.read.parquet(index.path).limit(1).write.mode("append").parquet(index.path)
    assert index.keys().count() == 2


def arrivals(tmp_path, name, n):
    stage = tmp_path / "stage"
    stage.mkdir(exist_ok=True)
    (stage / name).write_text("id\n" + "".join(f"{i}\n" for i in range(n)))
    return stage


def file_load(spark, tmp_path, **options):
    return FileLoad(spark, Stage(f"{tmp_path}/stage"), T.StructType().add("id", T.IntegerType()), f"{tmp_path}/rows",
                    f"{tmp_path}/history", **options)


def test_purge_deletes_after_the_history_is_saved(spark, tmp_path, monkeypatch):
    stage, load = arrivals(tmp_path, "a.csv", 3), file_load(spark, tmp_path, purge="delete")
    # Cut short between the history row and the removals: the file stays and counts once.
    with monkeypatch.context() as m:
        m.setattr(loads, "remove_files", lambda paths: (_ for _ in ()).throw(OSError("cut short")))
        with pytest.raises(OSError):
            load.run("one", AS_OF)
    assert (stage / "a.csv").exists() and load.loaded().count() == 3
    arrivals(tmp_path, "b.csv", 4)
    load.run("two", AS_OF)
    assert list(stage.glob("*.csv")) == [] and load.loaded().count() == 7
    # Cut short before the history row: nothing is deleted, the next run loads the file.
    arrivals(tmp_path, "c.csv", 5)
    with monkeypatch.context() as m:
        m.setattr(FileLoad, "_save", lambda *a: (_ for _ in ()).throw(OSError("cut short")))
        with pytest.raises(OSError):
            load.run("three", AS_OF)
    assert load.purge_loaded() == 0 and (stage / "c.csv").exists()
    load.run("three", AS_OF)
    assert list(stage.glob("*.csv")) == [] and load.loaded().count() == 12
    # The name comes again with other content: by name it is not loaded, and so not deleted.
    arrivals(tmp_path, "a.csv", 2)
    load.run("four", AS_OF)
    assert (stage / "a.csv").exists() and load.loaded().count() == 12


def test_removing_files_again_is_no_error(spark, tmp_path):
    for name in ("x y.csv", "z%1.csv"):
        (tmp_path / name).write_text("1")
    paths = spark.createDataFrame([(str(tmp_path / n),) for n in ("x y.csv", "z%1.csv", "none.csv", "x y.csv")], "path string")
    assert remove_files(paths) == 2 and remove_files(paths) == 0
    assert remove_files(paths.limit(0)) == 0


TARGETS = {"a": ["k"], "b": ["k", "v"]}


def test_files_are_consumed_once(spark, tmp_path, monkeypatch):
    staging = f"{tmp_path}/staging"
    load = ConsumedLoad(spark, staging, TARGETS, f"{tmp_path}/t", f"{tmp_path}/log", "day")
    assert load.run(1) is None
    first = spark.createDataFrame([("d1", 1, "x"), ("d2", 2, "y")], "day string, k int, v string")
    first.write.parquet(staging)
    assert load.run(1) == 2 and load.run(2) is None
    with pytest.raises(ValueError):
        load.run(1)
    spark.createDataFrame([("d3", 3, None)], first.schema).write.mode("append").parquet(staging)
    # Cut short after the targets: the rows do not count, and the files still wait.
    with monkeypatch.context() as m:
        m.setattr("pipekit.plans.consumed.load_target_audit", lambda *a: (_ for _ in ()).throw(OSError("cut short")))
        with pytest.raises(OSError):
            load.run(3)
    assert rows(load.loaded("b").select("k")) == [(1,), (2,)] and load.waiting().count() > 0
    assert load.run(4) == 1
    assert rows(load.loaded("b").select("k", "run_id")) == [(1, 1), (2, 1), (3, 4)] == rows(load.loaded("a").select("k", "run_id"))
    assert rows(load.audit().select("day", "target_table", "source_count", "target_count", "run_id")) == [
        (d, t, 1, 1, r) for d, r in (("d1", 1), ("d2", 1), ("d3", 4)) for t in ("a", "b")]
    # Run 3 begun again finds nothing, its rows still do not count.
    assert load.run(3) is None and load.loaded("a").count() == 3


def ticking(spark, tmp_path, body):
    stream = spark.readStream.schema("id int").option("header", True).csv(f"{tmp_path}/stage")
    return at_rate(stream, body, f"{tmp_path}/checkpoint", "200 milliseconds")


def test_ticks_run_only_with_rows(spark, tmp_path):
    ran = []
    arrivals(tmp_path, "a.csv", 3)
    events = run_ticks(ticking(spark, tmp_path, lambda df, n: ran.append((n, df.count()))), 1, idle=1)
    assert ran == [(0, 3)] and [e["numInputRows"] for e in events] == [3]
    arrivals(tmp_path, "b.csv", 2)
    run_ticks(ticking(spark, tmp_path, lambda df, n: ran.append((n, df.count()))), 1)
    assert ran == [(0, 3), (1, 2)]
    with pytest.raises(TimeoutError):
        run_ticks(ticking(spark, tmp_path, lambda df, n: ran.append(n)), 1, timeout=1.5)
    arrivals(tmp_path, "c.csv", 2)

    def broken(df, n):
        raise ValueError("broken body")
    with pytest.raises(Exception, match="broken body"):
        run_ticks(ticking(spark, tmp_path, broken), 1)
    # What the broken tick left undone is done by the next start, under the same number.
    run_ticks(ticking(spark, tmp_path, lambda df, n: ran.append((n, df.count()))), 1)
    assert ran[-1] == (2, 2)


def test_a_long_log_is_not_walked(spark, tmp_path, monkeypatch):
    log = ChangeLog(spark, f"{tmp_path}/log")
    a, b = (spark.createDataFrame([(1, v)], "k int, v string") for v in "ab")
    for i in range(6):
        log.capture(*((a, b) if i % 2 == 0 else (b, a)), ["k"])
    asked = []
    import pipekit.streaming.feed as feed
    real = feed.path_exists
    monkeypatch.setattr(feed, "path_exists", lambda s, p: asked.append(p) or real(s, p))
    assert log.last_version() == 6 and len(asked) <= 3
    assert log.consume("x", lambda df: None) and not log.consume("x", lambda df: None) and not log.has_data("x")
    assert log.capture(a, b, ["k"]) == 7 and log.has_data("x")


def test_file_gate(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    assert scans.gate_files(spark, f"{tmp_path}/in").status == "SUCCESS: NOTHING TO DO"
    for name, text in (("a.TXT", "1\n2\n"), ("sub/b.txt", "3\n"), ("c.csv", "no\n"), ("d.txt.gz.part", "no\n"), ("txt", "no\n")):
        (tmp_path / "in" / name).write_text(text)
    got = scans.gate_files(spark, f"{tmp_path}/in")
    assert got.status == "SUCCESS" and rows(got.lines) == [("1", "a.TXT"), ("2", "a.TXT"), ("3", "b.txt")]
    assert sorted(r.file_name for r in got.skipped.collect()) == ["c.csv", "d.txt.gz.part", "txt"]


def test_duplicates_meet_by_digest(spark):
    data = [("a", 0.0, 1, "x"), ("a", -0.0, 2, "y"), ("a", None, 3, "z"), (None, 0.0, 4, "w"), (None, 0.0, 5, "v"), ("", 0.0, 6, "u"),
            ("a", float("nan"), 7, "t"), ("a", float("nan"), 8, "s")]
    df = spark.createDataFrame(data, "k string, d double, n int, v string")
    got = quality.drop_duplicates(df, ["k", "d"], ["n"])
    assert got.columns == df.columns and sorted(r.n for r in got.collect()) == [1, 3, 4, 6, 7]
    assert quality.drop_duplicates(df, ["k", "d"]).count() == df.dropDuplicates(["k", "d"]).count() == 5
    assert quality.drop_duplicates(df, ["n"]).count() == 8
    plan = quality.drop_duplicates(df, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" not in plan and "SortAggregate(key=[k#" not in plan


def test_live_checks_decide_as_next_check(spark, tmp_path):
    """Arrivals between checks begin the quiet anew; after a call the series sleeps until more arrive."""
    stage, got = tmp_path / "in", []
    stage.mkdir()
    (stage / "0.csv").write_text("k\n" + "a\n" * 5 + "b\n")

    def on_check(rows, number):
        got.extend(tuple(r) for r in rows.collect())
        names = [r[0] for r in got]
        if names.count("a") >= 2 and not (stage / "1.csv").exists():
            (stage / "1.csv").write_text("k\na\na\n")
        if any(r[0] == "b" and r[-1] == "CALL SP" for r in got) and not (stage / "2.csv").exists():
            (stage / "2.csv").write_text("k\nb\nb\nb\n")

    stream = spark.readStream.schema("k string").option("header", True).csv(str(stage))
    query = start_checks(spark, stream, "k", f"{tmp_path}/cp", 800, on_check)
    run_until(query, lambda: [r[-1] for r in got].count("CALL SP") >= 3, 200)
    for name in "ab":
        previous = None
        for _, number, count, found, quiet, action in sorted(r for r in got if r[0] == name):
            assert (found, quiet, action) == audit.next_check(previous, count)
            previous = None if action == "CALL SP" else (count, quiet)
    a, b = (sorted(r for r in got if r[0] == name) for name in "ab")
    assert a[-1][2] == 7 and [r[1] for r in a] == list(range(1, len(a) + 1)) and len(a) >= 5
    assert [r[2] for r in b if r[-1] == "CALL SP"] == [1, 3]
