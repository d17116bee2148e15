"""Write modes, exports, swaps, layers."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pipekit.plans.catalog import QUERIES as CATALOGUE
from pipekit.sinks import layers
from pipekit.sinks import writers as wr
from pipekit.sinks.files import list_files, path_exists, rename
from pipekit.sources import scans
from pipekit.sources.formats import FileFormat

SCHEMA = "employee_id int, name string, salary int"


@pytest.mark.parametrize("name", ["star_new_with_audit", "resent_file"])
def test_no_whole_table_goes_through_one_file(spark, monkeypatch, name):
    calls, export = [], wr.export_named

    def noted(df, folder, file, *args, **options):
        calls.append((file, options.get("layout", "file")))
        return export(df, folder, file, *args, **options)

    monkeypatch.setattr(wr, "export_named", noted)
    CATALOGUE[name](spark, "/root/testdata/sf0.001")
    assert calls and all(layout == "parts" for _, layout in calls) or len({file for file, _ in calls}) == 4


def test_arrivals_are_appended(spark, monkeypatch):
    calls, append = [], wr.append_rows
    monkeypatch.setattr(wr, "append_rows", lambda df, path: calls.append(path) or append(df, path))
    CATALOGUE["arrival_audit"](spark, "/root/testdata/sf0.001")
    assert len(calls) == 2 and len(set(calls)) == 1


def batch(spark, start):
    return spark.createDataFrame([(start + i, f"n{start + i}", 100 * i) for i in range(5)], SCHEMA)


def count(spark, path):
    return scans.read_csv(spark, path, schema=SCHEMA).count()


def test_modes(spark, tmp_path):
    path = str(tmp_path / "out")
    wr.write(batch(spark, 0), path, "error", "csv")
    for i in range(1, 5):
        wr.write(batch(spark, 10 * i), path, "append", "csv")
    assert count(spark, path) == 25
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        wr.write(batch(spark, 0), path, "error", "csv")
    wr.write(batch(spark, 0), path, "ignore", "csv")
    assert count(spark, path) == 25
    wr.write(batch(spark, 90), path, "overwrite", "csv")
    assert count(spark, path) == 5
    with pytest.raises(ValueError):
        wr.write(batch(spark, 0), path, "merge")


def test_accumulate_keeps_one_file(spark, tmp_path):
    path = str(tmp_path / "acc")
    for i in range(5):
        wr.accumulate(batch(spark, 10 * i).select("salary", "employee_id", "name") if i % 2 else batch(spark, 10 * i), path)
    assert count(spark, path) == 25
    assert len(list_files(spark, path)) == 1
    assert rows(scans.read_csv(spark, path, schema=SCHEMA, check_header=True).where("employee_id = 32")) == [(32, "n32", 200)]


def test_replace_reads_its_own_folder_and_recovers(spark, tmp_path):
    path = str(tmp_path / "t")
    wr.reload(batch(spark, 0), path)
    wr.replace(spark.read.parquet(path).withColumn("salary", F.col("salary") + 1), path)
    assert rows(spark.read.parquet(path).select("salary"))[0] == (1,)
    with pytest.raises(ValueError):
        wr.replace(spark.read.parquet(path), path, check=lambda df: False)
    assert spark.read.parquet(path).count() == 5
    rename(spark, path, f"{path}__old")
    wr.recover(spark, path)
    assert spark.read.parquet(path).count() == 5 and not path_exists(spark, f"{path}__old")


def test_rewrite_touches_listed_partitions_only(spark, tmp_path):
    path = str(tmp_path / "p")
    base = spark.createDataFrame([(i, f"g{i % 4}") for i in range(40)], "id int, grp string")
    base.write.partitionBy("grp").parquet(path)
    before = {g: sorted(list_files(spark, f"{path}/grp={g}")) for g in ("g0", "g1", "g2", "g3")}
    touched = spark.createDataFrame([("g1",), ("g2",)], "grp string")
    wr.rewrite_partitions(spark, path, ["grp"], touched, lambda df: df.where("grp = 'g1' and id < 20"))
    assert sorted(list_files(spark, f"{path}/grp=g0")) == before["g0"]
    assert not path_exists(spark, f"{path}/grp=g2")
    assert spark.read.parquet(path).where("grp = 'g1'").count() == 5
    with pytest.raises(ValueError):
        wr.rewrite_partitions(spark, path, ["grp"], spark.createDataFrame([(None,)], "grp string"), lambda df: df)


def test_named_export_and_large_result(spark, tmp_path):
    folder = str(tmp_path / "exp")
    path = wr.export_named(batch(spark, 0), folder, "staff.csv")
    wr.export_named(batch(spark, 50), folder, "staff.csv")
    assert [f.rsplit("/", 1)[-1] for f in list_files(spark, folder)] == ["staff.csv"]
    assert rows(scans.read_csv(spark, path, schema=SCHEMA).select(F.min("employee_id"))) == [(50,)]
    big = wr.export_named(batch(spark, 0).repartition(3), folder, "big.csv", layout="parts")
    assert count(spark, big) == 5 and len(list_files(spark, big)) > 1
    assert wr.stamped_name("emp", dt.datetime(2024, 1, 31, 23, 59, 58)) == "emp_20240131_235958.csv"


def test_export_check_flags_empty_files(spark, tmp_path):
    path = str(tmp_path / "c")
    wr.export(batch(spark, 0).coalesce(1), path, FileFormat())
    (tmp_path / "c" / "empty.csv").write_text("employee_id,name,salary\n")
    got = {r["status"]: r["row_count"] for r in wr.export_check(spark, path).collect()}
    assert got == {"OK": 5, "EMPTY": 0}


@pytest.mark.parametrize("header", [True, False])
def test_export_leaves_no_empty_file_beside_others(spark, tmp_path, header):
    fmt, path = FileFormat(header=header), str(tmp_path / "c")
    late = spark.range(0, 8, 1, 4)
    wr.export(late.where("id > 4"), path, fmt)
    assert rows(wr.export_check(spark, path, fmt).select("status", "row_count")) == [("OK", 1), ("OK", 2)]


def test_export_of_nothing_is_still_flagged(spark, tmp_path):
    path = str(tmp_path / "c")
    wr.export(spark.range(0, 8, 1, 4).where("id > 9"), path, FileFormat())
    assert rows(wr.export_check(spark, path).select("status", "row_count")) == [("EMPTY", 0)]


def test_append_refuses_schema_drift(spark, tmp_path):
    path = str(tmp_path / "a")
    wr.append_rows(batch(spark, 0), path)
    wr.append_rows(batch(spark, 10).select("salary", "name", "employee_id"), path)
    assert spark.read.parquet(path).count() == 10
    with pytest.raises(ValueError, match="drift"):
        wr.append_rows(batch(spark, 0).withColumn("extra", F.lit(1)), path)
    with pytest.raises(ValueError, match="drift"):
        wr.append_rows(batch(spark, 0).withColumn("salary", F.col("salary").cast("string")), path)


def test_layers(spark, tmp_path):
    when = dt.datetime(2024, 1, 31, 20, 0, 0)
    assert layers.run_folder("r", when, "Asia/Kolkata") == "r/run_2024-02-01_01-30-00"
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 31)), (2, dt.datetime(2024, 2, 1))], "id int, ts timestamp_ntz")
    root = str(tmp_path / "dated")
    layers.to_dated(df, root, "ts")
    layers.to_dated(df.where("id = 2").withColumn("id", F.lit(9)), root, "ts")
    back = spark.read.schema("id int, ts timestamp_ntz, year string, month string, day string").parquet(root)
    assert rows(back.select("id", "year", "month", "day")) == [(1, "2024", "01", "31"), (9, "2024", "02", "01")]
    assert not layers.is_complete(spark, root, "x")
    layers.mark_complete(spark, root, "x")
    assert layers.is_complete(spark, root, "x") and back.count() == 2


def test_routes(spark):
    df = spark.createDataFrame([("hr/a.txt",), ("fin/b.txt",), ("zz/c.txt",)], "path string")
    routed, rejects = layers.split_routes(df, "path", {"hr": "people", "fin": "money"})
    assert {k: v.count() for k, v in routed.items()} == {"people": 1, "money": 1}
    assert rows(rejects.select("path")) == [("zz/c.txt",)]
