"""Write modes, exports, layers and routing, checked by reading back."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pipekit.operators.aggregates import table_counts, union_blocks
from pipekit.plans import jobs
from pipekit.plans.catalog.registry import query, table
from pipekit.session import scratch
from pipekit.sinks import layers
from pipekit.sinks import writers as wr
from pipekit.sinks.files import path_exists
from pipekit.sources import scans as sc
from pipekit.sources.formats import FileFormat

AS_OF = dt.datetime(2024, 5, 6, 20, 30, 15)
_SCHEMA = "customer_id bigint, customer_name string, segment string, balance double"
_ALL = "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment, c_acctbal AS balance FROM customer"


def _customers(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))


def _mode_case(spark, sf, mode):
    """Customers written first, then suppliers' rows in the given mode."""
    path = scratch(spark, f"mode-{mode}")
    second = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("customer_id"), F.col("s_name").alias("customer_name"), F.lit("S").alias("segment"),
        F.col("s_acctbal").alias("balance"))
    fmt = FileFormat()
    wr.write(_customers(spark, sf), path, "overwrite", "csv", fmt)
    failed = False
    try:
        wr.write(second, path, mode, "csv", fmt)
    except AnalysisException as error:
        failed = "PATH_ALREADY_EXISTS" in str(error)
    rows = sc.read_csv(spark, path, fmt, schema=_SCHEMA)
    return rows.select("customer_id", "customer_name").withColumn("failed", F.lit(failed))


@query("write_overwrite", "SK1 SK21", "SELECT s_suppkey AS customer_id, s_name AS customer_name, false AS failed FROM supplier")
def write_overwrite(spark, sf):
    return _mode_case(spark, sf, "overwrite")


@query("write_append", "SK2", """
    SELECT c_custkey AS customer_id, c_name AS customer_name, false AS failed FROM customer
    UNION ALL SELECT s_suppkey, s_name, false FROM supplier""")
def write_append(spark, sf):
    return _mode_case(spark, sf, "append")


@query("write_error", "SK3 SK12", "SELECT c_custkey AS customer_id, c_name AS customer_name, true AS failed FROM customer")
def write_error(spark, sf):
    return _mode_case(spark, sf, "error")


@query("write_ignore", "SK4", "SELECT c_custkey AS customer_id, c_name AS customer_name, false AS failed FROM customer")
def write_ignore(spark, sf):
    return _mode_case(spark, sf, "ignore")


@query("accumulate", "SK5 SK6 O8", f"{_ALL} UNION ALL {_ALL}")
def accumulate(spark, sf):
    path = scratch(spark, "accumulate")
    wr.accumulate(_customers(spark, sf), path)
    wr.accumulate(_customers(spark, sf).select("balance", "segment", "customer_name", "customer_id"), path)
    return sc.read_csv(spark, path, schema=_SCHEMA, check_header=True)


@query("parquet_round_trip", "SK7 SC17", _ALL)
def parquet_round_trip(spark, sf):
    csv, parquet = scratch(spark, "rt-csv"), scratch(spark, "rt-parquet")
    wr.write(_customers(spark, sf), csv, kind="csv")
    wr.write(sc.read_csv(spark, csv, schema=_SCHEMA), parquet)
    return sc.read_parquet(spark, parquet)


@query("export_plain", "SK8", _ALL)
def export_plain(spark, sf):
    path, fmt = scratch(spark, "plain"), FileFormat(header=False)
    wr.export(_customers(spark, sf), path, fmt)
    return sc.read_csv(spark, path, fmt, schema=_SCHEMA)


@query("export_header", "SK9 SK13", _ALL)
def export_header(spark, sf):
    path, fmt = scratch(spark, "header"), FileFormat(sep="|", header=True)
    wr.export(_customers(spark, sf), path, fmt)
    return sc.read_csv(spark, path, fmt, schema=_SCHEMA, check_header=True)


@query("export_projection", "SK10 P1", "SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer")
def export_projection(spark, sf):
    path, fmt = scratch(spark, "projection"), FileFormat()
    wr.export(_customers(spark, sf), path, fmt, columns=["customer_id", "segment"])
    return sc.read_csv(spark, path, fmt, schema="customer_id bigint, segment string")


@query("export_filtered", "SK11 P12", "SELECT c_custkey AS customer_id, c_acctbal AS balance FROM customer WHERE c_acctbal > 6500")
def export_filtered(spark, sf):
    path, fmt = scratch(spark, "filtered"), FileFormat()
    wr.export(_customers(spark, sf), path, fmt, ["customer_id", "balance"], F.col("balance") > 6500)
    return sc.read_csv(spark, path, fmt, schema="customer_id bigint, balance double")


@query("export_refuse_then_clear", "SK12", f"SELECT *, true AS refused FROM ({_ALL})")
def export_refuse_then_clear(spark, sf):
    path, fmt = scratch(spark, "refuse"), FileFormat()
    wr.export(_customers(spark, sf), path, fmt)
    try:
        wr.export(_customers(spark, sf), path, fmt)
        refused = False
    except AnalysisException:
        refused = True
    wr.export(_customers(spark, sf), path, fmt, clear=True)
    return sc.read_csv(spark, path, fmt, schema=_SCHEMA).withColumn("refused", F.lit(refused))


_FOUR = """SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier
    UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM orders"""


def _four(spark, sf):
    return {n: table(spark, sf, n) for n in ("customer", "supplier", "part", "orders")}


@query("export_many", "SK14", _FOUR)
def export_many(spark, sf):
    exports = {n: wr.Export(df, scratch(spark, f"many-{n}")) for n, df in _four(spark, sf).items()}
    wr.export_many(exports)
    return table_counts({n: sc.read_csv(spark, e.path) for n, e in exports.items()})


@query("export_under", "SK15", _FOUR)
def export_under(spark, sf):
    root = scratch(spark, "under")
    wr.export_under(_four(spark, sf), root)
    return table_counts({n: sc.read_csv(spark, f"{root}/{n}") for n in _four(spark, sf)})


@query("export_named", "SK16 SK6 SP9", f"SELECT *, 'customers.csv' AS file_name FROM ({_ALL}) WHERE segment = 'BUILDING'")
def export_named(spark, sf):
    """A second export replaces the named file."""
    folder = scratch(spark, "named-export")
    jobs.export_one(_customers(spark, sf), folder, "customers.csv")
    path = jobs.export_one(_customers(spark, sf).where("segment = 'BUILDING'"), folder, "customers.csv")
    return sc.read_csv(spark, path, schema=_SCHEMA).withColumn("file_name", F.lit(path.rsplit("/", 1)[-1]))


@query("export_stamped", "SK17 F19", f"SELECT *, 'customers_20240506_203015.csv' AS file_name FROM ({_ALL})")
def export_stamped(spark, sf):
    name = wr.stamped_name("customers", AS_OF)
    path = jobs.export_one(_customers(spark, sf), scratch(spark, "stamped"), name)
    return sc.read_csv(spark, path, schema=_SCHEMA).withColumn("file_name", F.lit(path.rsplit("/", 1)[-1]))


@query("export_each", "SP10 SK14 SK16", """
    SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def export_each(spark, sf):
    tables = {n: (table(spark, sf, n), scratch(spark, f"each-{n}")) for n in ("customer", "supplier")}
    paths = dict(zip(tables, jobs.export_each(tables)))
    return table_counts({n: sc.read_csv(spark, p) for n, p in paths.items()})


@query("export_partitions", "SP11 SK15 SK16", """
    SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def export_partitions(spark, sf):
    tables = {n: table(spark, sf, n) for n in ("customer", "supplier")}
    paths = dict(zip(tables, jobs.export_partitions(tables, scratch(spark, "partitions"))))
    return table_counts({n: sc.read_csv(spark, p) for n, p in paths.items()})


@query("export_check", "SK18", "SELECT count(*) AS row_count, 'OK' AS status FROM orders")
def export_check(spark, sf):
    path = scratch(spark, "checked")
    wr.export(table(spark, sf, "orders"), path, FileFormat())
    files = wr.export_check(spark, path)
    return files.groupBy("status").agg(F.sum("row_count").alias("row_count"))


@query("create_table_as", "SK19", """
    SELECT c_mktsegment AS segment, count(*) AS row_count, true AS refused FROM customer GROUP BY 1""")
def create_table_as(spark, sf):
    name = "pipekit_" + scratch(spark, "ctas").rsplit("-", 1)[-1]
    path = scratch(spark, "ctas")
    counts = _customers(spark, sf).groupBy("segment").agg(F.count(F.lit(1)).alias("row_count"))
    wr.save_table(counts, name, path=path)
    try:
        wr.save_table(counts, name, path=path)
        refused = False
    except AnalysisException:
        refused = True
    return spark.table(name).withColumn("refused", F.lit(refused))


@query("insert_select", "SK20 SP6", f"{_ALL} UNION ALL SELECT * FROM ({_ALL}) WHERE segment = 'MACHINERY'")
def insert_select(spark, sf):
    path = scratch(spark, "insert")
    wr.append_rows(_customers(spark, sf), path)
    wr.append_rows(_customers(spark, sf).where("segment = 'MACHINERY'"), path)
    return spark.read.parquet(path)


@query("copy_whole_table", "SP6 SK20", f"SELECT *, 2 AS copies FROM ({_ALL})")
def copy_whole_table(spark, sf):
    """The whole source is added on each call, so old rows repeat."""
    path = scratch(spark, "copy")
    jobs.copy_table(spark, _customers(spark, sf), path)
    jobs.copy_table(spark, _customers(spark, sf), path)
    return spark.read.parquet(path).groupBy("customer_id", "customer_name", "segment", "balance").agg(
        F.count(F.lit(1)).cast("int").alias("copies"))


@query("copy_new_rows", "SP6 J8", _ALL)
def copy_new_rows(spark, sf):
    path = scratch(spark, "copy-new")
    jobs.copy_table(spark, _customers(spark, sf).where("balance > 0"), path, ["customer_id"])
    jobs.copy_table(spark, _customers(spark, sf), path, ["customer_id"])
    return spark.read.parquet(path)


@query("truncate_reload", "SK21", f"SELECT * FROM ({_ALL}) WHERE balance < 0")
def truncate_reload(spark, sf):
    path = scratch(spark, "reload")
    wr.reload(_customers(spark, sf), path)
    wr.reload(_customers(spark, sf).where("balance < 0"), path)
    return spark.read.parquet(path)


@query("load_targets", "SK22", """
    SELECT 'names' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'balances', count(*) FROM customer""")
def load_targets(spark, sf):
    root = scratch(spark, "targets")
    wr.load_targets(_customers(spark, sf), {
        "names": (f"{root}/names", ["customer_id", "customer_name"]),
        "balances": (f"{root}/balances", ["customer_id", "balance"])})
    return table_counts({n: spark.read.parquet(f"{root}/{n}") for n in ("names", "balances")})


@query("replace_in_place", "SK5 UP2", f"SELECT customer_id, CASE WHEN segment = 'BUILDING' THEN 0.0 ELSE balance END AS balance FROM ({_ALL})")
def replace_in_place(spark, sf):
    """A folder rewritten from its own content."""
    path = scratch(spark, "swap")
    wr.reload(_customers(spark, sf), path)
    changed = spark.read.parquet(path).withColumn(
        "balance", F.when(F.col("segment") == "BUILDING", F.lit(0.0)).otherwise(F.col("balance")))
    wr.replace(changed, path, check=lambda df: not df.isEmpty())
    return spark.read.parquet(path).select("customer_id", "balance")


@query("layers", "SK23 SK24 SK25 PL11 F17", """
    SELECT c_custkey AS customer_id, '2024-05-06 20:30:15' AS ingest_ts, '2024/05/06' AS dated, 'run_2024-05-07_02-00-15' AS run_folder,
           true AS complete FROM customer""")
def layers_query(spark, sf):
    raw, refined, dated = (scratch(spark, f"layer-{n}") for n in ("raw", "refined", "dated"))
    wr.write(_customers(spark, sf), raw, kind="csv")
    jobs.layer_run(spark, sc.read_csv(spark, raw, schema=_SCHEMA), refined, dated, AS_OF, "customers", "Asia/Kolkata")
    run = layers.run_folder("x", AS_OF, "Asia/Kolkata").rsplit("/", 1)[-1]
    assert path_exists(spark, f"{refined}/{run}")
    rows = spark.read.schema(_SCHEMA + ", ingest_ts timestamp_ntz, source_file string, year string, month string, day string").parquet(dated)
    return rows.select("customer_id", F.date_format("ingest_ts", "yyyy-MM-dd HH:mm:ss").alias("ingest_ts"),
                       F.concat_ws("/", "year", "month", "day").alias("dated"), F.lit(run).alias("run_folder"),
                       F.lit(layers.is_complete(spark, dated, "customers")).alias("complete"))


@query("dated_layout", "SK24", """
    SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, count(*) AS row_count
    FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1, 2""")
def dated_layout(spark, sf):
    """Monthly counts of one year, read from its folders only."""
    path = scratch(spark, "months")
    parts = layers.add_date_parts(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop("day")
    parts.hint("rebalance", "year", "month").write.partitionBy("year", "month").parquet(path)
    rows = spark.read.schema("o_orderkey bigint, year string, month string").parquet(path)
    return rows.where("year = '1999'").groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count"))


@query("completion_marker", "SK25", "SELECT count(*) AS row_count, false AS before_run, true AS after_run FROM customer")
def completion_marker(spark, sf):
    path = scratch(spark, "marker")
    wr.reload(_customers(spark, sf), path)
    before = layers.is_complete(spark, path, "customers")
    layers.mark_complete(spark, path, "customers")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "before_run", F.lit(before)).withColumn("after_run", F.lit(layers.is_complete(spark, path, "customers")))


@query("route_by_folder", "SK26 F23", r"""
    SELECT page_id, split_part(regexp_replace(url, '^https?://[^/]+/', ''), '/', 1) AS folder,
           CASE split_part(regexp_replace(url, '^https?://[^/]+/', ''), '/', 1) WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french'
             ELSE 'REJECTED' END AS handler FROM pages""")
def route_by_folder(spark, sf):
    path = F.regexp_replace("url", "^https?://[^/]+/", "")
    routed, rejects = layers.split_routes(table(spark, sf, "pages").select("page_id", "url"), path,
                                          {"en": "english", "fr": "french"})
    parts = union_blocks(*routed.values(), rejects)
    return parts.select("page_id", "folder", F.coalesce("handler", F.lit("REJECTED")).alias("handler"))


@query("text_to_table", "SK27 SC7", """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, c_mktsegment AS segment FROM customer""")
def text_to_table(spark, sf):
    fmt, text, out = FileFormat(sep="|"), scratch(spark, "as-text"), scratch(spark, "as-table")
    wr.write(_customers(spark, sf).drop("balance"), text, kind="csv", fmt=fmt)
    layers.text_to_table(sc.read_csv(spark, text, fmt), out)
    return spark.read.parquet(out)


@query("stamped_copy_names", "SK23 F22 F17", r"""
    SELECT page_id, regexp_replace(split_part(url, '/', -1), '^(.+?)(\.[^.]*)?$', '\1_2024-05-07_02-00-15\2') AS copy_name
    FROM pages""")
def stamped_copy_names(spark, sf):
    return table(spark, sf, "pages").select("page_id", layers.renamed_copy("url", AS_OF, "Asia/Kolkata").alias("copy_name"))
