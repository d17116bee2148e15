"""Readers on small files with known content."""

import gzip

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.functions import flatten
from pipekit.sources import events, numbered, provenance, scans
from pipekit.sources import rows as literal
from pipekit.sources.formats import FileFormat, Stage
from pipekit.sources.workbook import read_workbooks

STAFF = [(1, "Ann", "Sales", 500), (2, "Bob", "IT", 700), (3, "Cy", "IT", 650), (4, "Di", "HR", 480)]
SCHEMA = "badge_no int, name string, unit string, points int"


def text_file(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def staff_lines(sep, header=True):
    head = [sep.join(["badge_no", "name", "unit", "points"])] if header else []
    return head + [sep.join(map(str, r)) for r in STAFF]


@pytest.mark.parametrize("sep", [",", "|", "\t", ";"])
def test_csv_separators_and_inference(spark, tmp_path, sep):
    df = scans.read_csv(spark, text_file(tmp_path / "a.csv", staff_lines(sep)), FileFormat(sep=sep), infer=True)
    assert [f.dataType for f in df.schema] == [T.IntegerType(), T.StringType(), T.StringType(), T.IntegerType()]
    assert rows(df) == STAFF


def test_csv_quotes(spark, tmp_path):
    path = text_file(tmp_path / "q.csv", ["id,address", '1,"12, High ""Old"" Street"', "2,Plain"])
    assert rows(scans.read_csv(spark, path, schema="id int, address string")) == [(1, '12, High "Old" Street'), (2, "Plain")]


def test_csv_without_header_and_all_text(spark, tmp_path):
    bare = text_file(tmp_path / "b.csv", staff_lines(",", header=False))
    df = scans.read_csv(spark, bare, FileFormat(header=False), infer=True, names=["badge_no", "name", "unit", "points"])
    assert rows(df) == STAFF
    text = scans.read_csv(spark, text_file(tmp_path / "t.csv", staff_lines(",")))
    assert {f.dataType for f in text.schema} == {T.StringType()}


def test_typed_load_and_gzip(spark, tmp_path):
    lines = ["id,joined,pay", "1,2024-02-03,10.50", "2,2023-12-31,7.25"]
    with gzip.open(tmp_path / "z.csv.gz", "wt") as out:
        out.write("\n".join(lines) + "\n")
    df = scans.read_csv(spark, str(tmp_path / "z.csv.gz"), schema="id decimal(10,0), joined date, pay decimal(12,2)")
    assert [str(v) for v in df.orderBy("id").first()] == ["1", "2024-02-03", "10.50"]


def test_json_forms(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"badge_no":1,"name":"Ann"}\n{"badge_no":2,"name":"Bob"}\n')
    (tmp_path / "a.json").write_text('[{"badge_no":1,"name":"Ann"},{"badge_no":2,"name":"Bob"}]')
    (tmp_path / "n.json").write_text('[\n {"badge_no": 1,\n  "skills": ["sql", "py"],\n  "address": {"city": "Pune", "country": "IN"}}\n]')
    assert rows(scans.read_json(spark, str(tmp_path / "l.json"))) == [(1, "Ann"), (2, "Bob")]
    assert rows(scans.read_json(spark, str(tmp_path / "a.json"))) == [(1, "Ann"), (2, "Bob")]
    nested = scans.read_json(spark, str(tmp_path / "n.json"), multi_line=True)
    flat = flatten(nested)
    assert flat.select("city", "country", "badge_no").first() == ("Pune", "IN", 1)


def test_lines_split_and_fixed_width(spark, tmp_path):
    parsed = scans.read_delimited(
        scans.read_lines(spark, text_file(tmp_path / "p.txt", staff_lines(" | ", header=False))), r"\|",
        [("badge_no", "int"), ("name", "string"), ("unit", "string"), ("points", "int")])
    assert rows(parsed) == STAFF
    lines = [f"{a:03d} {b:<7} {c:<8} {d:>5}" for a, b, c, d in STAFF]
    layout = [("badge_no", 1, 3, "int"), ("name", 5, 7, "string"), ("unit", 13, 8, "string"), ("points", 22, 5, "int")]
    fixed = scans.read_fixed_width(scans.read_lines(spark, text_file(tmp_path / "f.txt", lines)), layout)
    assert rows(fixed) == STAFF


def test_bad_values_abort_or_become_null(spark, tmp_path):
    path = text_file(tmp_path / "bad.txt", ["1|Ann|Sales|500", "x|Bob|IT"])
    fields = [("badge_no", "int"), ("name", "string"), ("unit", "string"), ("points", "int")]
    lines = scans.read_lines(spark, path)
    assert (None, "Bob", "IT", None) in {tuple(r) for r in scans.read_delimited(lines, r"\|", fields, tolerant=True).collect()}
    with pytest.raises(Exception):
        scans.read_delimited(lines, r"\|", fields).collect()
    fixed = [("badge_no", 1, 1, "int")]
    assert sorted(r[0] or 0 for r in scans.read_fixed_width(lines, fixed, tolerant=True).collect()) == [0, 1]


def test_validation_only_and_policies(spark, tmp_path):
    path = text_file(tmp_path / "v.csv", ["id,size", "1,10", "2,big", "3"])
    schema = T.StructType().add("id", T.IntegerType()).add("size", T.IntegerType())
    assert rows(scans.bad_rows(spark, path, schema).select("bad_record")) == [("2,big",), ("3",)]
    assert rows(scans.read_csv(spark, path, schema=schema, on_error="continue")) == [(1, 10)]
    with pytest.raises(Exception):
        scans.read_csv(spark, path, schema=schema).collect()


def test_header_mismatch_fails(spark, tmp_path):
    path = text_file(tmp_path / "h.csv", ["id,size", "1,10"])
    with pytest.raises(Exception, match="(?i)header"):
        scans.read_csv(spark, path, schema="id int, weight int", check_header=True).collect()


def test_row_positions_over_many_splits(spark, tmp_path):
    lines = ["id,name"] + [f"{i},name-{i:06d}" for i in range(5000)]
    text_file(tmp_path / "big.csv", lines)
    text_file(tmp_path / "small.csv", ["id,name", "9001,x", "9002,y"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = numbered.read_numbered_csv(spark, str(tmp_path), "id int, name string")
        assert df.rdd.getNumPartitions() > 5
        got = {(r["source_file"], r["id"]): r["row_in_file"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert all(got[("big.csv", i)] == i + 2 for i in range(5000))
    assert got[("small.csv", 9001)] == 2 and got[("small.csv", 9002)] == 3


@pytest.mark.parametrize("policy", ["continue", "report"])
def test_row_positions_stay_right_beside_bad_rows(spark, tmp_path, policy):
    lines = ["id,size"] + [f"{i},{'x' if i % 10 == 9 else i}" for i in range(2, 2000)]
    lines[50] = ""
    text_file(tmp_path / "a.csv", ["", " ", *lines])
    text_file(tmp_path / "b.csv", ["id,size", "1,1", "2", "", "4,4,4", "5,5"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        got = {(r["source_file"], r["row_in_file"]): (r["id"], r["size"]) for r in numbered.read_numbered_csv(
            spark, str(tmp_path), "id int, size int", on_error=policy).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {("a.csv", i + 2): (i, None if i % 10 == 9 else i) for i in range(2, 2000) if i != 51}
    want |= {("b.csv", 2): (1, 1), ("b.csv", 3): (2, None), ("b.csv", 5): (4, 4), ("b.csv", 6): (5, 5)}
    if policy == "continue":
        want = {k: v for k, v in want.items() if v[1] is not None and k != ("b.csv", 5)}
    assert got == want
    with pytest.raises(Exception, match="MALFORMED"):
        numbered.read_numbered_csv(spark, str(tmp_path), "id int, size int").collect()
    # A query of one column drops or finds the lines that are bad in another.
    one = numbered.read_numbered_csv(spark, str(tmp_path), "id int, size int", on_error=policy).select("id")
    assert one.count() == len(want) and sorted(r[0] for r in one.collect()) == sorted(v[0] for v in want.values())
    with pytest.raises(Exception, match="MALFORMED"):
        numbered.read_numbered_csv(spark, str(tmp_path), "id int, size int").select("id").collect()


def test_inventory_and_content_keys(spark, tmp_path):
    text_file(tmp_path / "a.csv", ["1"])
    text_file(tmp_path / "b.csv", ["1"])
    text_file(tmp_path / "c.csv", ["2"])
    files = provenance.inventory(spark, str(tmp_path)).join(provenance.content_keys(spark, str(tmp_path)), "path")
    keys = {r["file_name"]: r["content_key"] for r in files.collect()}
    assert keys["a.csv"] == keys["b.csv"] != keys["c.csv"]


def test_content_key_sees_line_order_and_repeats(spark, tmp_path):
    text_file(tmp_path / "a.csv", ["11", "22"])
    text_file(tmp_path / "b.csv", ["22", "11"])
    text_file(tmp_path / "c.csv", ["11", "11"])
    text_file(tmp_path / "d.csv", ["22", "22"])
    keys = [r["content_key"] for r in provenance.content_keys(spark, str(tmp_path)).collect()]
    assert len(keys) == len(set(keys)) == 4


def test_file_names_with_special_characters(spark, tmp_path):
    text_file(tmp_path / "a b+c%1.csv", ["id", "1"])
    read = scans.read_csv(spark, str(tmp_path), schema="id int")
    assert rows(provenance.rows_per_file(read)) == [("a b+c%1.csv", 1)]
    files = provenance.inventory(spark, str(tmp_path)).join(provenance.content_keys(spark, str(tmp_path)), "path")
    assert [r["file_name"] for r in files.collect()] == ["a b+c%1.csv"]


def test_marker_states(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        text_file(tmp_path / "go.ctl", [""])
        scans.read_when_marked(spark, str(tmp_path), "go.ctl")
    text_file(tmp_path / "in.txt", staff_lines("|"))
    assert scans.read_when_marked(spark, str(tmp_path), "other.ctl") is None
    assert rows(scans.read_when_marked(spark, str(tmp_path), "go.ctl", schema=SCHEMA)) == STAFF


def test_text_merge(spark, tmp_path):
    (tmp_path / "0_empty.txt").write_text("")
    for i in range(5):
        text_file(tmp_path / f"staff_{i}.txt", ["id|name"] + [f"{i}{j}|n{j}" for j in range(5)])
    merged = scans.merge_text_files(spark, str(tmp_path))
    assert merged.count() == 25
    per_file = rows(merged.groupBy("source_file").count())
    assert per_file == [(f"staff_{i}.txt", 5) for i in range(5)]
    text_file(tmp_path / "staff_9.txt", ["id|label", "1|x"])
    with pytest.raises(Exception, match="(?i)header"):
        scans.merge_text_files(spark, str(tmp_path), check_header=True).collect()


def test_batch_complete(spark):
    names = ["batch_2024-01-01_a.csv", "batch_2024-01-01_b.csv", "batch_2024-01-01.ctl", "batch_2024-01-02_a.csv", "notes.csv"]
    files = literal.from_tuples(spark, [(n,) for n in names], ["file_name"])
    assert rows(scans.complete_batches(files).select("file_name")) == [(n,) for n in names[:2]]


def test_unsafe_names_are_refused(spark, tmp_path):
    for name in ("a b.csv", "x;y.csv", "../up.csv"):
        with pytest.raises(ValueError):
            scans.read_stage_file(spark, Stage(str(tmp_path)), name, SCHEMA)


def test_mixed_directory_skips_unknown(spark, tmp_path):
    text_file(tmp_path / "A.CSV", staff_lines(","))
    text_file(tmp_path / "b.txt", staff_lines(","))
    text_file(tmp_path / "c.log", ["noise"])
    found = scans.read_directory(spark, str(tmp_path))
    assert sorted(found) == ["csv", "txt"]
    assert rows(found["csv"]) == STAFF


def test_workbooks(spark, tmp_path):
    from pipekit.plans.catalog.scans import _workbook
    import pandas as pd
    frame = pd.DataFrame(STAFF, columns=["badge_no", "name", "unit", "points"])
    for i in range(3):
        (tmp_path / f"book_{i}.xlsx").write_bytes(_workbook(frame))
    typed = read_workbooks(spark, str(tmp_path), SCHEMA)
    assert typed.count() == 12 and rows(typed.select("badge_no", "name", "unit", "points").distinct()) == STAFF
    text = read_workbooks(spark, str(tmp_path))
    assert text.columns == ["source_path", "badge_no", "name", "unit", "points"]
    with pytest.raises(Exception, match="no column"):
        read_workbooks(spark, str(tmp_path), "badge_no int, missing string").collect()


def test_literal_rows(spark):
    assert rows(literal.from_tuples(spark, [(1, "a")], ["id", "name"])) == [(1, "a")]
    plain = literal.from_dicts(spark, [{"id": 1, "address": {"city": "Pune"}}])
    typed = literal.from_dicts(spark, [{"id": 1, "address": {"city": "Pune"}}], "id int, address struct<city: string>")
    assert plain.select("address.city").first() == typed.select("address.city").first() == ("Pune",)
    assert rows(literal.generate(spark, 3)) == [(0,), (1,), (2,)]


def test_event_layouts(spark):
    record = ('{"Records":[{"eventName":"Put","eventTime":"t","s3":{"bucket":{"name":"b"},'
              '"object":{"key":"in/a+b%2Bc.csv","size":7}}},{"eventName":"Put","eventTime":"t","s3":{"bucket":{"name":"b"},"object":{"key":"k","size":8}}}]}')
    df = spark.createDataFrame([(record,)], "value string")
    assert rows(events.record_events(df).select("object_key", "size")) == [("in/a b+c.csv", 7), ("k", 8)]
    envelope = '{"detail-type":"Object Created","source":"store","time":"t","detail":{"bucket":{"name":"b"},"object":{"key":"k","size":1}}}'
    got = events.envelope_events(spark.createDataFrame([(envelope,), ("broken",)], "value string"))
    assert events.filter_events(got, {"detail_type": ["Object Created"], "bucket": ["b"]}).count() == 1
    assert got.where(F.col("source").isNull()).count() == 1


def test_text_files_merge_whatever_their_headers_say(spark, tmp_path):
    text_file(tmp_path / "0.txt", [])
    text_file(tmp_path / "1.txt", ["", "  "])
    text_file(tmp_path / "2.txt", ["", "id|name", "1|a", "", "2|b|more"])
    text_file(tmp_path / "3.txt", [" ", "other|words|here", "3"])
    text_file(tmp_path / "4.txt", ["id|name"])
    assert rows(scans.merge_text_files(spark, str(tmp_path)).fillna("-")) == [
        ("1", "a", "2.txt"), ("2", "b", "2.txt"), ("3", "-", "3.txt")]
