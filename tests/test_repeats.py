"""Runs that are repeated, cut short or share a process lose nothing."""

import datetime as dt
from threading import Barrier, Thread

import pytest
from conftest import rows

from pipekit.plans import jobs
from pipekit.session import durable, working_tables
from pipekit.sinks import writers as wr
from pipekit.sinks.files import path_exists, write_text
from pipekit.sources.formats import FileFormat, Stage
from pipekit.streaming.feed import ChangeLog
from pipekit.streaming.loads import FileLoad

DAY = dt.datetime(2024, 1, 2)


def people(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id int, city string")


def test_scd2_repeat_keeps_closed_versions(spark, tmp_path):
    root = str(tmp_path / "dim")
    jobs.run_scd2(spark, root, people(spark, (1, "A"), (2, "B")), ["id"], dt.datetime(2024, 1, 1))
    first = rows(jobs.run_scd2(spark, root, people(spark, (1, "C"), (2, "B")), ["id"], DAY))
    again = rows(jobs.run_scd2(spark, root, people(spark, (1, "C"), (2, "B")), ["id"], DAY))
    assert len(first) == 3 and again == first
    # Another source at the very same moment.
    assert len(rows(jobs.run_scd2(spark, root, people(spark, (1, "C"), (2, "D")), ["id"], DAY))) == 4


def test_completed_load_id_is_refused(spark, tmp_path):
    stage = tmp_path / "stage"
    stage.mkdir()
    (stage / "a[1].csv").write_text("id\n1\n")
    (stage / "empty.csv").write_text("id\n")
    schema = spark.createDataFrame([], "id int").schema
    load = FileLoad(spark, Stage(str(stage), FileFormat(header=True)), schema, str(tmp_path / "rows"), str(tmp_path / "history"))
    assert load.run("day1", DAY).count() == 2  # the file without rows is remembered too
    assert load.pending(DAY).isEmpty()
    (stage / "b.csv").write_text("id\n2\n")
    with pytest.raises(ValueError, match="day1"):
        load.run("day1", DAY)
    load.run("day2", DAY)
    assert rows(load.loaded(), "id") == [(1,), (2,)]
    assert load.pending(DAY + dt.timedelta(days=400)).isEmpty()


def test_unfinished_version_is_not_consumed(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "feed"))
    log.capture(people(spark, (1, "A")), people(spark, (1, "B")), ["id"])
    log.capture(people(spark, (1, "B")), people(spark, (1, "C")), ["id"])
    (tmp_path / "feed" / "version=000000002" / "_SUCCESS").unlink()
    seen = []
    assert log.consume("c", lambda df: seen.extend(r["version"] for r in df.select("version").distinct().collect()))
    assert seen == [1] and log.offset("c") == 1 and not log.has_data("c")
    (tmp_path / "feed" / "version=000000002" / "_SUCCESS").write_text("")
    assert log.consume("c", lambda df: seen.extend(r["version"] for r in df.select("version").distinct().collect()))
    assert seen == [1, 2] and log.offset("c") == 2


def test_pointer_file_is_replaced_in_one_step(spark, tmp_path):
    for text in ("one", "two"):
        write_text(spark, str(tmp_path / "p" / "pointer"), text)
    assert (tmp_path / "p" / "pointer").read_text() == "two"


def test_boolean_partition_is_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, True), (2, False)], "id int, flag boolean").write.partitionBy("flag").parquet(path)
    wr.rewrite_partitions(spark, path, ["flag"], spark.createDataFrame([(True,)], "flag boolean"), lambda df: df.where("false"))
    assert rows(spark.read.parquet(path), "id") == [(2,)]


def test_moved_key_leaves_no_old_row(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x", "A"), (2, "y", "A"), (3, "z", "B")], "id int, v string, grp string").write.partitionBy(
        "grp").parquet(path)
    source = spark.createDataFrame([(1, "new", "B"), (4, "w", "C")], "id int, v string, grp string")
    jobs.upsert_partitions(spark, path, source, ["id"], ["grp"])
    assert rows(spark.read.parquet(path), "id", "v", "grp") == [(1, "new", "B"), (2, "y", "A"), (3, "z", "B"), (4, "w", "C")]


def test_working_tables_of_another_thread_stay(spark):
    made, meet = {}, Barrier(2)

    def job(name):
        with working_tables(spark):
            made[name] = durable(people(spark, (1, name)), name).inputFiles()[0]
            meet.wait(60)
            if name == "late":
                meet.wait(60)
                made["there"] = path_exists(spark, made[name])
        if name == "early":
            meet.wait(60)

    threads = [Thread(target=job, args=(n,)) for n in ("early", "late")]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert made["there"] and not path_exists(spark, made["early"]) and not path_exists(spark, made["late"])
