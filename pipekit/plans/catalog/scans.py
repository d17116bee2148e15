"""File scans: the given tables are written out by Spark, then read back with each reader."""

from __future__ import annotations

import io
import sys
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.functions import json_fields
from pipekit.operators.aggregates import table_counts, union_blocks
from pipekit.plans.catalog.registry import dbl, money, query, table
from pipekit.session import scratch
from pipekit.sinks.files import list_files, make_dirs, rename, write_text
from pipekit.sinks.writers import export_named, write
from pipekit.sources import numbered as nb
from pipekit.sources import provenance as pv
from pipekit.sources import scans as sc
from pipekit.sources.formats import FileFormat, Stage
from pipekit.sources.workbook import parse_workbooks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STAFF = "SELECT c_custkey AS badge_no, c_name AS name, c_mktsegment AS unit, c_nationkey AS points FROM customer"
_NAMES = ["badge_no", "name", "unit", "points"]
_SCHEMA = "badge_no bigint, name string, unit string, points int"


def _staff(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("badge_no"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("unit"), F.col("c_nationkey").alias("points"))


def _land(df, name, kind="csv", fmt=FileFormat()):
    path = scratch(df.sparkSession, name)
    write(df, path, kind=kind, fmt=fmt)
    return path


def _land_lines(df, name, sep):
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns])
    return _land(df.select(line.alias("value")), name, "text")


def _typed(df):
    return df.withColumn("badge_no", F.col("badge_no").cast("bigint"))


@query("csv_inferred", "SC1 SK7", _STAFF)
def csv_inferred(spark, sf):
    return _typed(sc.read_csv(spark, _land(_staff(spark, sf), "csv"), infer=True))


@query("csv_pipe", "SC2", _STAFF)
def csv_pipe(spark, sf):
    fmt = FileFormat(sep="|")
    return _typed(sc.read_csv(spark, _land(_staff(spark, sf), "pipe", fmt=fmt), fmt, infer=True))


@query("csv_tab", "SC3", _STAFF)
def csv_tab(spark, sf):
    fmt = FileFormat(sep="\t")
    return _typed(sc.read_csv(spark, _land(_staff(spark, sf), "tab", fmt=fmt), fmt, infer=True))


@query("csv_semicolon", "SC4", _STAFF)
def csv_semicolon(spark, sf):
    fmt = FileFormat(sep=";")
    return _typed(sc.read_csv(spark, _land(_staff(spark, sf), "semicolon", fmt=fmt), fmt, infer=True))


@query("csv_quoted", "SC5", """
    SELECT c_custkey AS id, c_name || ', "' || c_mktsegment || '"' AS address, c_nationkey AS nation FROM customer""")
def csv_quoted(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("address"),
        F.col("c_nationkey").alias("nation"))
    return sc.read_csv(spark, _land(rows, "quoted"), schema="id bigint, address string, nation int")


@query("csv_no_header", "SC6 P3", _STAFF)
def csv_no_header(spark, sf):
    fmt = FileFormat(header=False)
    return _typed(sc.read_csv(spark, _land(_staff(spark, sf), "bare", fmt=fmt), fmt, infer=True, names=_NAMES))


@query("csv_all_text", "SC7", """
    SELECT CAST(c_custkey AS VARCHAR) AS badge_no, c_name AS name, c_mktsegment AS unit,
           CAST(c_nationkey AS VARCHAR) AS points FROM customer""")
def csv_all_text(spark, sf):
    return sc.read_csv(spark, _land(_staff(spark, sf), "text"))


@query("csv_typed", "SC8 F20", """
    SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_totalprice AS amount FROM orders""")
def csv_typed(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date"),
        money("o_totalprice").alias("amount"))
    back = sc.read_csv(spark, _land(rows, "typed"), schema="order_id bigint, order_date date, amount decimal(14,2)")
    return back.select("order_id", F.date_format("order_date", "yyyy-MM-dd").alias("order_date"), dbl("amount").alias("amount"))


@query("csv_gzip", "SC9 SK13", _STAFF)
def csv_gzip(spark, sf):
    return sc.read_csv(spark, _land(_staff(spark, sf), "gzip", fmt=FileFormat(compression="gzip")), schema=_SCHEMA)


@query("json_lines", "SC10", _STAFF)
def json_lines(spark, sf):
    return sc.read_json(spark, _land(_staff(spark, sf), "json", "json")).select(
        "badge_no", "name", "unit", F.col("points").cast("int").alias("points"))


def _chunks(df, key, size, options=None):
    """JSON arrays of at most ``size`` consecutive keys each."""
    row = F.struct(*df.columns)
    arrays = df.groupBy(F.floor(F.col(key) / size).alias("chunk")).agg(F.collect_list(row).alias("rows"))
    return arrays.select(F.to_json("rows", options or {}).alias("value"))


@query("json_array", "SC11", _STAFF)
def json_array(spark, sf):
    path = _land(_chunks(_staff(spark, sf), "badge_no", 500), "array", "text")
    return sc.read_json(spark, path, schema=_SCHEMA)


@query("json_nested", "SC12 P4 F26", """
    SELECT c_custkey AS badge_no, n_name AS city, r_name AS country, c_mktsegment AS first_skill
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def json_nested(spark, sf):
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("badge_no"), F.array("c_mktsegment", "c_name").alias("skills"),
        F.struct(F.col("n_name").alias("city"), F.col("r_name").alias("country")).alias("address"))
    path = scratch(spark, "nested")
    _chunks(rows, "badge_no", 500, {"pretty": "true"}).write.option("maxRecordsPerFile", 1).text(path)
    return sc.read_json(spark, path, multi_line=True).select(
        "badge_no", "address.city", "address.country", F.col("skills")[0].alias("first_skill"))


@query("text_lines", "SC13", """
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || upper(event_type) || ' event ' || event_id AS value FROM events""")
def text_lines(spark, sf):
    line = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.upper("event_type"), F.lit("event"),
                       F.col("event_id").cast("string"))
    return sc.read_lines(spark, _land(table(spark, sf, "events").select(line.alias("value")), "lines", "text"))


@query("split_parse", "SC14 F6 F7 F9", _STAFF)
def split_parse(spark, sf):
    lines = sc.read_lines(spark, _land_lines(_staff(spark, sf), "parse", " | "))
    return sc.read_delimited(lines, r"\|", [
        ("badge_no", "bigint"), ("name", "string"), ("unit", "string"), ("points", "int")])


@query("txt_with_csv_reader", "SC15", f"""
    SELECT 'comma' AS kind, count(*) AS row_count, CAST(sum(badge_no) AS BIGINT) AS ids FROM ({_STAFF})
    UNION ALL SELECT 'pipe', count(*), CAST(sum(badge_no) AS BIGINT) FROM ({_STAFF})
    UNION ALL SELECT 'tab', count(*), CAST(sum(badge_no) AS BIGINT) FROM ({_STAFF})""")
def txt_with_csv_reader(spark, sf):
    parts = []
    for kind, sep in (("comma", ","), ("pipe", "|"), ("tab", "\t")):
        path = _land_lines(_staff(spark, sf), f"txt-{kind}", sep)
        rows = sc.read_csv(spark, path, FileFormat(sep=sep, header=False), schema=_SCHEMA, glob="*.txt")
        parts.append(rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum("badge_no").alias("ids"))
                     .withColumn("kind", F.lit(kind)))
    return union_blocks(*parts)


@query("fixed_width_parse", "SC16 F8", _STAFF)
def fixed_width_parse(spark, sf):
    line = F.concat(F.lpad(F.col("badge_no").cast("string"), 18, " "), F.rpad("name", 30, " "),
                    F.rpad("unit", 14, " "), F.lpad(F.col("points").cast("string"), 6, " "))
    path = _land(_staff(spark, sf).select(line.alias("value")), "fixed", "text")
    return sc.read_fixed_width(sc.read_lines(spark, path), [
        ("badge_no", 1, 18, "bigint"), ("name", 19, 30, "string"), ("unit", 49, 14, "string"),
        ("points", 63, 6, "int")])


@query("parquet_scan", "SC17 P1 P12", """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' AND l_quantity > 40""")
def parquet_scan(spark, sf):
    return sc.read_parquet(spark, f"{sf}/lineitem.parquet").where(
        "l_shipdate >= timestamp_ntz'1999-01-01' and l_quantity > 40").select("l_orderkey", "l_linenumber", "l_extendedprice")


def _workbook(rows: pd.DataFrame) -> bytes:
    """A minimal workbook with inline text cells."""
    def line(cells):
        return "<row>" + "".join(f'<c t="inlineStr"><is><t>{escape(str(c))}</t></is></c>' for c in cells) + "</row>"
    sheet = ('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
             + line(rows.columns) + "".join(line(r) for r in rows.itertuples(index=False)) + "</sheetData></worksheet>")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/worksheets/sheet1.xml", sheet)
    return out.getvalue()


def _pack(chunk: pd.DataFrame) -> pd.DataFrame:
    number = int(chunk["chunk"].iloc[0])
    return pd.DataFrame({"path": [f"book-{number}.xlsx"], "content": [_workbook(chunk.drop(columns="chunk"))]})


@query("xlsx_scan", "SC18", _STAFF)
def xlsx_scan(spark, sf):
    """Workbooks of at most 500 consecutive ids each, as a binary-file scan would give them."""
    books = (_staff(spark, sf).withColumn("chunk", F.floor(F.col("badge_no") / 500))
             .groupBy("chunk").applyInPandas(_pack, "path string, content binary"))
    return parse_workbooks(books, _SCHEMA).select(*_NAMES)


@query("mixed_scan", "SC19 SC15", f"""
    SELECT kind, count(*) AS row_count, CAST(sum(badge_no) AS BIGINT) AS ids FROM ({_STAFF}),
           (VALUES ('csv'), ('json'), ('parquet'), ('txt')) k(kind) GROUP BY 1""")
def mixed_scan(spark, sf):
    """One folder with several formats, an upper-case extension and an unknown one."""
    staff, folder = _staff(spark, sf), scratch(spark, "mixed")
    make_dirs(spark, folder)
    sources = [("CSV", _land(staff, "m-csv")), ("json", _land(staff, "m-json", "json")),
               ("parquet", _land(staff, "m-parquet", "parquet")), ("TXT", _land(staff, "m-txt")),
               ("log", _land_lines(staff, "m-log", " "))]
    for ext, path in sources:
        for i, file in enumerate(list_files(spark, path)):
            rename(spark, file, f"{folder}/staff-{ext}-{i}.{ext}")
    found = sc.read_directory(spark, folder, {"csv": _SCHEMA, "txt": _SCHEMA, "json": _SCHEMA})
    return union_blocks(*[
        df.agg(F.count(F.lit(1)).alias("row_count"), F.sum("badge_no").alias("ids")).withColumn("kind", F.lit(kind))
        for kind, df in found.items()])


@query("multi_file_load", "SC20", _STAFF)
def multi_file_load(spark, sf):
    return sc.read_csv(spark, _land(_staff(spark, sf).repartition(5, "badge_no"), "many"), schema=_SCHEMA)


@query("tables_load", "SC21 AU13", """
    SELECT 'staff' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'vendors', count(*) FROM supplier
    UNION ALL SELECT 'parts', count(*) FROM part""")
def tables_load(spark, sf):
    paths = {"staff": _land(_staff(spark, sf), "staff"), "vendors": _land(table(spark, sf, "supplier"), "vendors"),
             "parts": _land(table(spark, sf, "part"), "parts")}
    return table_counts(sc.read_tables(spark, paths, schemas={"staff": _SCHEMA}))


@query("provenance", "SC22 F22", """
    SELECT count(*) AS row_count, 0 AS repeated_positions, 0 AS gaps, CAST(2 AS BIGINT) AS first_position FROM orders""")
def provenance(spark, sf):
    """Every row has its own place in its file; places run without gaps from the line after the header."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    read = nb.read_numbered_csv(spark, _land(rows, "places"), "o_orderkey bigint, o_custkey bigint, o_orderstatus string")
    files = read.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("row_in_file").alias("d"),
        F.min("row_in_file").alias("first"), F.max("row_in_file").alias("last"))
    return files.agg(F.sum("n").alias("row_count"), F.sum(F.col("n") - F.col("d")).cast("int").alias("repeated_positions"),
                     F.sum(F.col("last") - F.col("first") + 1 - F.col("n")).cast("int").alias("gaps"),
                     F.max("first").alias("first_position"))


def _placed(spark, sf, name):
    """Orders written in key order with their own place in the file as text; every sixth place is no number."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").repartitionByRange(5, "o_orderkey").sortWithinPartitions(
        "o_orderkey")
    rows, place = rows.withColumn("place", F.monotonically_increasing_id() % (1 << 33) + 2), F.col("place")
    line = F.concat_ws(",", F.when(place % 6 == 0, F.concat(F.lit("n/a-"), "o_orderkey")).otherwise(
        F.col("o_orderkey").cast("string")), "o_orderstatus", place.cast("string"))
    path = scratch(spark, name)
    # Each part begins with a header of its own; the lines keep their order in the file.
    head = F.lit("order_id,status,place")
    lines = rows.select(F.when(place == 2, F.concat(head, F.lit("\n"), line)).otherwise(line).alias("value"))
    lines.write.text(path)
    return path


_PLACED = "order_id bigint, status string, place bigint"


@query("provenance_abort", "SC22 P21", "SELECT count(*) AS row_count, true AS line_is_position, true AS aborted FROM orders")
def provenance_abort(spark, sf):
    """Without bad rows all lines have their place; with them the job ends."""
    path = _placed(spark, sf, "places-abort")
    aborted = False
    try:
        nb.read_numbered_csv(spark, path, _PLACED).agg(F.sum("order_id")).collect()
    except Exception as error:  # noqa: BLE001 - Spark wraps the error of a task
        aborted = "MALFORMED" in str(error)
    text = nb.read_numbered_csv(spark, path, _PLACED.replace("order_id bigint", "order_id string"))
    return text.agg(F.count(F.lit(1)).alias("row_count"), F.bool_and(F.col("place") == F.col("row_in_file")).alias(
        "line_is_position")).withColumn("aborted", F.lit(aborted))


@query("provenance_with_bad_rows", "SC22 P21", """
    SELECT 'continue' AS policy, CAST(count(*) AS BIGINT) AS missing_or_bad, true AS some_bad, true AS line_is_position
    FROM orders WHERE false UNION ALL SELECT 'report', 0, true, true""")
def provenance_with_bad_rows(spark, sf):
    """Places stay right when bad lines are left out or reported; every order is there or told as bad, once."""
    path = _placed(spark, sf, "places-bad")
    keys = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"))
    out = []
    for policy in ("continue", "report"):
        read = nb.read_numbered_csv(spark, path, _PLACED, on_error=policy)
        told = F.regexp_extract(F.col("_corrupt_record"), "n/a-([0-9]+)", 1).cast("bigint") if policy == "report" else F.lit(None).cast("bigint")
        marked = read.select(F.coalesce(F.col("order_id"), told).alias("key"), F.col("order_id").isNull().alias("bad"),
                             (F.col("place") == F.col("row_in_file")).alias("right"))
        if policy == "continue":
            # What is left out are exactly the lines whose place is a multiple of six.
            lost = marked.agg(F.count(F.lit(1)).alias("n"), F.bool_and("right").alias("right"))
            every = nb.read_numbered_csv(spark, path, _PLACED.replace("order_id bigint", "order_id string"))
            fits = every.agg(F.count_if(F.col("row_in_file") % 6 != 0).alias("fits"), (F.count_if(
                F.col("row_in_file") % 6 == 0) > 0).alias("some_bad"))
            both = union_blocks(lost, fits).agg(*[F.max(c).alias(c) for c in ("n", "right", "fits", "some_bad")])
            out.append(both.select(F.lit(policy).alias("policy"), (F.col("fits") - F.col("n")).alias("missing_or_bad"),
                                   "some_bad", F.col("right").alias("line_is_position")))
        else:
            both = keys.join(marked, "key", "full_outer").agg(
                F.count_if(F.col("right").isNull() | F.col("key").isNull()).alias("missing_or_bad"),
                F.bool_or("bad").alias("some_bad"), F.bool_and("right").alias("line_is_position"))
            out.append(both.select(F.lit(policy).alias("policy"), "missing_or_bad", "some_bad", "line_is_position"))
    return out[0].unionByName(out[1])


@query("provenance_stored", "SC22 G12", """
    SELECT o_orderstatus, count(*) AS row_count FROM orders GROUP BY 1""")
def provenance_stored(spark, sf):
    """File names taken at load time, kept in the table and counted per file."""
    path = scratch(spark, "by-status")
    table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").write.partitionBy("o_orderstatus").option(
        "header", True).csv(path)
    read = sc.read_csv(spark, path, schema="o_orderkey bigint, o_custkey bigint, o_orderstatus string")
    stored = scratch(spark, "stored")
    pv.with_source_file(read).write.parquet(stored)
    per_file = spark.read.parquet(stored).groupBy("source_file", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("o_orderstatus").agg(F.sum("n").alias("row_count"))


@query("rows_per_file", "G12 SC34", "SELECT count(*) AS row_count, true AS every_file_has_rows FROM customer")
def rows_per_file(spark, sf):
    counts = pv.rows_per_file(sc.read_csv(spark, _land(_staff(spark, sf).repartition(4, "badge_no"), "counted"), schema=_SCHEMA))
    return counts.agg(F.sum("row_count").alias("row_count"), (F.min("row_count") > 0).alias("every_file_has_rows"))


@query("stage_query", "SC23 P11", f"SELECT badge_no, name FROM ({_STAFF}) WHERE unit = 'BUILDING'")
def stage_query(spark, sf):
    stage = Stage(_land(_staff(spark, sf), "stage"))
    return sc.read_csv(spark, stage.path, stage.format, schema=_SCHEMA).where("unit = 'BUILDING'").select("badge_no", "name")


@query("stage_inventory", "SC24", """
    SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS folder, true AS has_bytes, true AS keys_differ FROM orders""")
def stage_inventory(spark, sf):
    path = scratch(spark, "inventory")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").write.partitionBy("o_orderstatus").csv(path)
    files = pv.inventory(spark, path).join(pv.content_keys(spark, path), "path")
    return files.groupBy(F.regexp_extract("path", "o_orderstatus=[^/]+", 0).alias("folder")).agg(
        (F.min("length") > 0).alias("has_bytes"), (F.count_distinct("content_key") == F.count(F.lit(1))).alias("keys_differ"))


@query("marker_gated", "SC33 SC40 PL12", _STAFF)
def marker_gated(spark, sf):
    """Nothing is read until the marker lies beside the inputs."""
    fmt = FileFormat(sep="|")
    path = _land(_staff(spark, sf), "marked", fmt=fmt)
    assert sc.read_when_marked(spark, path, "batch.ctl", "*.csv", fmt, _SCHEMA) is None
    write_text(spark, f"{path}/batch.ctl", "")
    return sc.read_when_marked(spark, path, "batch.ctl", "*.csv", fmt, _SCHEMA)


@query("merge_text", "SC34 G12", """
    SELECT CAST(c_custkey AS VARCHAR) AS badge_no, c_name AS name, c_mktsegment AS unit,
           CAST(c_nationkey AS VARCHAR) AS points, true AS has_file FROM customer""")
def merge_text(spark, sf):
    path = _land(_staff(spark, sf).repartition(5, "badge_no"), "merge", fmt=FileFormat(sep="|"))
    write_text(spark, f"{path}/a-empty.csv", "")
    return sc.merge_text_files(spark, path, "|", "*.csv").withColumn(
        "has_file", F.col("source_file").endswith(".csv")).drop("source_file")


@query("file_gate", "P20 SC13", """
    SELECT 'SUCCESS' AS status, count(*) AS row_count, true AS only_text, true AS others_listed, 'SUCCESS: NOTHING TO DO' AS empty_status
    FROM customer""")
def file_gate(spark, sf):
    """Text files of any case are read; others are listed and never opened; a folder without text files is a success too."""
    path = scratch(spark, "gate")
    _staff(spark, sf).select(F.concat_ws("|", "badge_no", "name").alias("value")).repartition(3).write.text(f"{path}/a")
    some = list_files(spark, f"{path}/a")
    rename(spark, some[0], f"{path}/a/UPPER.TXT")
    write_text(spark, f"{path}/b/notes.log", "not a row")
    write_text(spark, f"{path}/b/data.txt.bak", "not a row")
    got, empty = sc.gate_files(spark, path), sc.gate_files(spark, f"{path}/b")
    skipped = got.skipped.agg((F.count_if(F.col("file_name").isin("notes.log", "data.txt.bak")) == 2).alias("others_listed"))
    rows = got.lines.agg(F.count(F.lit(1)).alias("row_count"), F.bool_and(F.lower("source_file").endswith(".txt")).alias("only_text"))
    both = union_blocks(rows, skipped).agg(*[F.max(c).alias(c) for c in ("row_count", "only_text", "others_listed")])
    return both.withColumn("status", F.lit(got.status)).withColumn("empty_status", F.lit(empty.status))


@query("merge_text_any_header", "SC34 G12", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS label, c_mktsegment AS part FROM customer""")
def merge_text_any_header(spark, sf):
    """Headers that differ from the first file's, blank first lines and blank files do not stop the merge."""
    path = scratch(spark, "merge-any")
    rows = _staff(spark, sf).repartition(5, "badge_no").select(
        F.concat_ws("|", "badge_no", "name", "unit").alias("value"), (F.monotonically_increasing_id() % (1 << 33)).alias("n"),
        F.spark_partition_id().alias("p"))
    head = F.when(F.col("p") == 0, F.lit("id|label|part\n")).otherwise(F.concat(F.lit(" \n\nnumber "), F.col("p"), F.lit("|what|where\n")))
    rows.select(F.when(F.col("n") == 0, F.concat(head, "value")).otherwise(F.col("value")).alias("value")).write.text(path)
    write_text(spark, f"{path}/a-blank.txt", "\n \n")
    write_text(spark, f"{path}/b-empty.txt", "")
    return sc.merge_text_files(spark, path).drop("source_file")


@query("stage_file_by_name", "SC35 SC36 SK16", _STAFF)
def stage_file_by_name(spark, sf):
    stage = Stage(scratch(spark, "named"))
    export_named(_staff(spark, sf), stage.path, "staff.csv")
    return sc.read_stage_file(spark, stage, "staff.csv", _SCHEMA)


_TYPE = T.StructType().add("part_id", T.LongType()).add("size", T.IntegerType())


def _with_bad(spark, sf):
    size = F.when(F.col("p_type") == "PROMO", F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("part_id"), size.alias("size"))


@query("validate_only", "SC37 P21", """
    SELECT p_partkey || ',n/a' AS bad_record, p_partkey AS part_id FROM part WHERE p_type = 'PROMO'""")
def validate_only(spark, sf):
    bad = sc.bad_rows(spark, _land(_with_bad(spark, sf), "bad"), _TYPE)
    return bad.select("bad_record", json_fields("parsed", "part_id bigint")["part_id"].alias("part_id"))


@query("skip_bad_rows", "P21", "SELECT p_partkey AS part_id, p_size AS size FROM part WHERE p_type <> 'PROMO'")
def skip_bad_rows(spark, sf):
    return sc.read_csv(spark, _land(_with_bad(spark, sf), "skip"), schema=_TYPE, on_error="continue")


@query("abort_on_bad_row", "P21", "SELECT count(*) AS row_count, true AS aborted FROM part")
def abort_on_bad_row(spark, sf):
    path = _land(_with_bad(spark, sf), "abort")
    aborted = False
    try:
        sc.read_csv(spark, path, schema=_TYPE).agg(F.sum("size")).collect()
    except Exception as error:  # noqa: BLE001 - Spark wraps the parse error of a task
        aborted = "MALFORMED" in str(error).upper()
    return sc.read_csv(spark, path).agg(F.count(F.lit(1)).alias("row_count")).withColumn("aborted", F.lit(aborted))


@query("header_check", "SC39", "SELECT count(*) AS row_count, true AS mismatch_found FROM customer")
def header_check(spark, sf):
    path = _land(_staff(spark, sf), "header")
    mismatch = False
    try:
        sc.read_csv(spark, path, schema="id bigint, name string, unit string, points int", check_header=True).agg(
            F.max("id")).collect()
    except Exception as error:  # noqa: BLE001 - Spark wraps the header error of a task
        mismatch = "header" in str(error).lower()
    good = sc.read_csv(spark, path, schema=_SCHEMA, check_header=True).agg(F.max("badge_no"), F.count("name").alias("row_count"))
    return good.select("row_count").withColumn("mismatch_found", F.lit(mismatch))


@query("batch_complete", "SC40", """
    WITH f AS (SELECT strftime(ts, '%Y-%m-%d') AS batch, event_id, event_type FROM events)
    SELECT batch, 'batch_' || batch || '_' || event_id || '.csv' AS file_name FROM f WHERE event_type <> 'signup'
      AND batch IN (SELECT strftime(ts, '%Y-%m-%d') FROM events WHERE event_type = 'signup' AND value > 60)""")
def batch_complete(spark, sf):
    """A file list where large signups stand for the marker of their day."""
    date, event = F.date_format("ts", "yyyy-MM-dd"), F.col("event_id").cast("string")
    name = F.when(F.col("event_type") == "signup", F.concat(F.lit("batch_"), date, F.lit(".ctl"))).otherwise(
        F.concat(F.lit("batch_"), date, F.lit("_"), event, F.lit(".csv")))
    files = table(spark, sf, "events").where("event_type <> 'signup' or value > 60").select(name.alias("file_name"))
    return sc.complete_batches(files).select("batch", "file_name")
