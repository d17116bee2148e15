"""End-to-end jobs: incremental loads, streams, star loads with audit, change feeds, flagged loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipekit.operators import changes as ch
from pipekit.operators.aggregates import group_summary, table_counts, union_blocks
from pipekit.operators.audit import CALL, AuditLog, RunResult, require_rows
from pipekit.operators.dims import DimensionSpec
from pipekit.operators.quality import drop_duplicates
from pipekit.plans import jobs
from pipekit.plans.consumed import ConsumedLoad
from pipekit.plans.catalog.history import (_DELTA, _HISTORY, FIRST, SECOND, _after, _base, _delta, _shown)
from pipekit.plans.catalog.modelling import _sales
from pipekit.plans.catalog.registry import dbl, money, query, table
from pipekit.session import scratch
from pipekit.sinks import writers as wr
from pipekit.sinks.files import write_text
from pipekit.sources.formats import FileFormat, Stage
from pipekit.sources.provenance import ContentIndex, inventory
from pipekit.streaming.feed import ChangeLog, apply_to_folder
from pipekit.streaming.loads import FileLoad, ingest_status
from pipekit.streaming.quiet import start_checks
from pipekit.streaming.scheduled import at_rate, run_ticks, run_until

AS_OF = dt.datetime(2024, 6, 1)
_ORDER_TYPE = T.StructType().add("order_id", T.LongType()).add("customer_id", T.LongType()).add(
    "status", T.StringType()).add("amount", T.DoubleType())
_ALL_ORDERS = "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS amount FROM orders"


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"), "o_orderdate")


def _arrive(df, stage, name):
    """A delivery of files into a stage."""
    wr.write(df.drop("o_orderdate"), f"{stage}/{name}", kind="csv")


def _load(spark, name, **options):
    root = scratch(spark, name)
    return FileLoad(spark, Stage(f"{root}/stage"), _ORDER_TYPE, f"{root}/rows", f"{root}/history", **options)


def _two_arrivals(spark, sf, name, **options):
    load = _load(spark, name, **options)
    orders = _orders(spark, sf)
    _arrive(orders.where("o_orderdate < timestamp_ntz'1998-01-01'"), load.stage.path, "first")
    load.run("load-1", AS_OF)
    _arrive(orders.where("o_orderdate >= timestamp_ntz'1998-01-01'"), load.stage.path, "second")
    load.run("load-2", AS_OF)
    return load


@query("incremental_load", "IN1 PL1 SC8 SK20", _ALL_ORDERS)
def incremental_load(spark, sf):
    """Two arrivals and a third run without news: every row once."""
    load = _two_arrivals(spark, sf, "incremental")
    load.run("load-3", AS_OF)
    return load.loaded().select(_ORDER_TYPE.names)


@query("load_history", "IN3 IN6 G12", """
    SELECT 'load-1' AS load_id, 'LOADED' AS status, count(*) AS rows_parsed, count(*) AS rows_loaded, CAST(0 AS BIGINT) AS errors_seen
    FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT 'load-2', 'LOADED', count(*), count(*), 0 FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def load_history(spark, sf):
    history = _two_arrivals(spark, sf, "history").load_history()
    return history.groupBy("load_id", "status").agg(*[
        F.sum(c).alias(c) for c in ("rows_parsed", "rows_loaded", "errors_seen")])


@query("forced_reload", "IN2", f"SELECT order_id, CAST(2 AS BIGINT) AS times FROM ({_ALL_ORDERS})")
def forced_reload(spark, sf):
    load = _two_arrivals(spark, sf, "forced")
    load.run("load-3", AS_OF, force=True)
    return load.loaded().groupBy("order_id").agg(F.count(F.lit(1)).alias("times"))


@query("resent_file", "IN4", """
    SELECT 'name' AS history_key, count(*) AS row_count FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'content', count(*) FROM orders""")
def resent_file(spark, sf):
    """Files sent again under their names with other content: skipped by name, loaded by content."""
    counts = {}
    for key in ("name", "content"):
        load = _load(spark, f"resent-{key}", key=key)
        for number, of in enumerate(("status = 'F'", "status <> 'F'"), 1):
            rows = _orders(spark, sf).where(of).drop("o_orderdate")
            for part in range(4):
                of_part = rows.where(F.pmod(F.xxhash64("order_id"), F.lit(4)) == part).repartition(1)  # read in parallel
                wr.export_named(of_part, load.stage.path, f"orders_{part}.csv")
            load.run(f"load-{number}", AS_OF)
        counts[key] = load.loaded()
    return table_counts(counts).withColumnRenamed("table_name", "history_key")


@query("load_with_bad_rows", "IN6 P21 SC37", """
    SELECT CASE WHEN bad > 0 THEN 'PARTIALLY_LOADED' ELSE 'LOADED' END AS status, n AS rows_parsed, n - bad AS rows_loaded, bad AS errors_seen
    FROM (SELECT count(*) AS n, CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS bad FROM orders)""")
def load_with_bad_rows(spark, sf):
    load = _load(spark, "bad-rows", on_error="continue")
    amount = F.when(F.col("status") == "P", F.lit("unknown")).otherwise(F.col("amount").cast("string"))
    _arrive(_orders(spark, sf).withColumn("amount", amount), load.stage.path, "first")
    done = load.run("load-1", AS_OF)
    sums = done.agg(*[F.sum(c).alias(c) for c in ("rows_parsed", "rows_loaded", "errors_seen")])
    return sums.withColumn("status", F.when(F.col("errors_seen") > 0, F.lit("PARTIALLY_LOADED")).otherwise(F.lit("LOADED")))


@query("purge_after_load", "SC38", "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS files_left FROM orders")
def purge_after_load(spark, sf):
    load = _load(spark, "purge", purge_to=scratch(spark, "purge-archive"))
    _arrive(_orders(spark, sf), load.stage.path, "first")
    load.run("load-1", AS_OF)
    left = inventory(spark, load.stage.path, "*.csv").agg(F.count(F.lit(1)).alias("files_left"))
    rows = load.loaded().agg(F.count(F.lit(1)).alias("row_count"))
    return union_blocks(rows, left).agg(F.max("row_count").alias("row_count"), F.max("files_left").alias("files_left"))


@query("purge_delete", "SC38", "SELECT count(*) AS row_count, CAST(1 AS BIGINT) AS files_left FROM orders")
def purge_delete(spark, sf):
    """Loaded files are deleted by tasks once their history is saved; a file of another kind stays."""
    load = _load(spark, "purge-delete", purge="delete")
    _arrive(_orders(spark, sf), load.stage.path, "first")
    write_text(spark, f"{load.stage.path}/notes.log", "stays")
    load.run("load-1", AS_OF)
    left = inventory(spark, load.stage.path).where(~F.col("file_name").startswith("_")).agg(F.count(F.lit(1)).alias("files_left"))
    rows = load.loaded().agg(F.count(F.lit(1)).alias("row_count"))
    return union_blocks(rows, left).agg(F.max("row_count").alias("row_count"), F.max("files_left").alias("files_left"))


@query("content_index", "IN1 IN4 SC22", """
    SELECT 'first' AS run, CAST(2 AS BIGINT) AS scanned, count(*) AS row_count FROM orders WHERE o_orderstatus = 'F' UNION ALL
    SELECT 'second', 0, count(*) FROM orders WHERE o_orderstatus = 'F' UNION ALL
    SELECT 'resent', 1, count(*) + count(*) FILTER (o_orderstatus = 'F' AND o_orderkey % 2 = 0) FROM orders WHERE o_orderstatus IN ('F', 'O')
      AND (o_orderstatus = 'F' OR o_orderkey % 2 = 0)""")
def content_index(spark, sf):
    """Content keys kept from run to run: a file is scanned for its key once, and again only when it has changed."""
    load = _load(spark, "content-index", key="content", content_index=scratch(spark, "content-keys"))
    index = ContentIndex(spark, load.stage.path, load.content_index)
    orders, out = _orders(spark, sf).drop("o_orderdate"), []

    def send(rows, part):
        wr.export_named(rows.where(f"order_id % 2 = {part}"), load.stage.path, f"orders_{part}.csv")

    for number, run in enumerate(("first", "second", "resent"), 1):
        if run == "first":
            send(orders.where("status = 'F'"), 0)
            send(orders.where("status = 'F'"), 1)
        if run == "resent":
            send(orders.where("status in ('F', 'O')"), 0)
        scanned = index.refresh()
        load.run(f"load-{number}", AS_OF)
        # Counted now: in one plan the same folder at three times would be one scan.
        out.append((run, scanned, load.loaded().count()))
    return spark.createDataFrame(out, "run string, scanned bigint, row_count bigint")


@query("fixed_rate_counts", "ST3 ST4 G4", """
    SELECT tick, status, n AS row_count, true AS empty_tick_did_nothing FROM (
      SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END AS tick, o_orderstatus AS status, count(*) AS n
      FROM orders GROUP BY 1, 2)""")
def fixed_rate_counts(spark, sf):
    """A count by status each second over what has come in since: two ticks find rows, the ticks between and after do no
    work."""
    root = scratch(spark, "fixed-rate")
    orders, ran = _orders(spark, sf), []

    def body(rows, number):
        counts = rows.groupBy("status").agg(F.count(F.lit(1)).alias("row_count"))
        counts.withColumn("tick", F.lit(number + 1)).write.mode("overwrite").parquet(f"{root}/counts/run={number}")
        ran.append(number)

    for part, cond in (("first", "<"), ("second", ">=")):
        _arrive(orders.where(f"o_orderdate {cond} timestamp_ntz'1998-01-01'"), f"{root}/stage", part)
        rows = spark.readStream.schema(_ORDER_TYPE).options(**FileFormat().reader_options()).option(
            "recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(f"{root}/stage")
        # The second call goes on from the checkpoint of the first; both stay for two more ticks without files.
        run_ticks(at_rate(rows, body, f"{root}/checkpoint", "1 second"), 1, idle=2.2)
    return spark.read.parquet(f"{root}/counts").select("tick", "status", "row_count").withColumn(
        "empty_tick_did_nothing", F.lit(ran == [0, 1]))


def _stream_twice(spark, sf, name):
    load = _load(spark, name)
    orders = _orders(spark, sf)
    for part, cond in (("first", "<"), ("second", ">=")):
        _arrive(orders.where(f"o_orderdate {cond} timestamp_ntz'1998-01-01'"), load.stage.path, part)
        load.stream(name.replace("-", "_"), f"{load.target}-checkpoint").awaitTermination(600)
    return load


@query("auto_ingest", "ST1 ST4", _ALL_ORDERS)
def auto_ingest(spark, sf):
    """A file stream over two arrivals; what the first run loaded, the second skips."""
    load = _stream_twice(spark, sf, "auto-ingest")
    return load.loaded().select(_ORDER_TYPE.names)


@query("ingest_status", "ST2 ST3", """
    SELECT 'stream' AS kind, count(*) AS row_count FROM orders UNION ALL SELECT 'history', count(*) FROM orders""")
def ingest_status_query(spark, sf):
    load = _stream_twice(spark, sf, "ingest-status")
    progress = ingest_status(spark, load).agg(F.sum("input_rows").alias("row_count"))
    history = load.load_history().agg(F.sum("rows_loaded").alias("row_count"))
    return progress.withColumn("kind", F.lit("stream")).unionByName(history.withColumn("kind", F.lit("history")))


@query("batch_csv_load", "PL1 SC8 SK20 G1 IN3", """
    SELECT status, count(*) AS row_count, CAST(sum(CAST(amount AS DECIMAL(14,2))) AS DOUBLE) AS total
    FROM (SELECT o_orderstatus AS status, o_totalprice AS amount FROM orders) GROUP BY 1""")
def batch_csv_load(spark, sf):
    load = _load(spark, "batch")
    _arrive(_orders(spark, sf), load.stage.path, "batch_1")
    jobs.batch_load(load, "batch-1", AS_OF)
    return load.loaded().groupBy("status").agg(
        F.count(F.lit(1)).alias("row_count"), dbl(F.sum(money("amount"))).alias("total"))


@query("raw_to_final", "PL2 F1 P6", """
    SELECT c_custkey AS customer_id, upper(c_mktsegment) AS segment, c_acctbal AS balance,
           CASE WHEN c_acctbal >= 9000 THEN 'HIGH' WHEN c_acctbal >= 6000 THEN 'MEDIUM' ELSE 'LOW' END AS category FROM customer""")
def raw_to_final(spark, sf):
    raw = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.lower("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    path = scratch(spark, "final")
    wr.append_rows(jobs.raw_to_final(raw, ["segment"], "balance", [(9000, "HIGH"), (6000, "MEDIUM")]), path)
    return spark.read.parquet(path)


@query("transformation_set", "PL3 P6 P11 G2 SK19", """
    SELECT 'summary' AS part, c_mktsegment AS segment, count(*) AS row_count, max(c_acctbal) AS highest FROM customer GROUP BY 2
    UNION ALL SELECT 'one_group', c_mktsegment, count(*), max(c_acctbal) FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 2
    UNION ALL SELECT 'HIGH', c_mktsegment, count(*), max(c_acctbal) FROM customer WHERE c_acctbal >= 9000 GROUP BY 2""")
def transformation_set(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"), "c_acctbal")
    parts = jobs.transformation_set(customer, "segment", "c_acctbal", 1.10, [(9000, "HIGH"), (6000, "MEDIUM")], "BUILDING")
    one = group_summary(parts["one_group"], ["segment"], "c_acctbal").withColumn("part", F.lit("one_group"))
    high = group_summary(parts["transformed"].where("band = 'HIGH'"), ["segment"], "c_acctbal").withColumn("part", F.lit("HIGH"))
    rows = union_blocks(parts["summary"].withColumn("part", F.lit("summary")), one, high)
    return rows.select("part", "segment", "row_count", "highest")


@query("upsert_folder", "PL4 UP1", f"""
    WITH s AS ({_DELTA})
    SELECT c_custkey, c_mktsegment, '2024-06-02' AS updated FROM s
    UNION ALL SELECT c_custkey, c_mktsegment, '2024-01-01' FROM customer WHERE c_nationkey <> 3 AND c_custkey NOT IN (SELECT c_custkey FROM s)""")
def upsert_folder(spark, sf):
    """The same source merged twice: the second changes the stamp only."""
    path = scratch(spark, "upsert")
    wr.reload(_base(spark, sf).withColumn("updated", F.lit("2024-01-01")), path)
    for stamp in ("2024-06-01", "2024-06-02"):
        jobs.upsert_folder(spark, path, _delta(spark, sf), ["c_custkey"], {"updated": F.lit(stamp)})
    return spark.read.parquet(path).select("c_custkey", "c_mktsegment", "updated")


@query("upsert_partitions", "UP1 SK24", f"""
    WITH s AS (SELECT * FROM ({_DELTA}) WHERE c_nationkey < 6)
    SELECT c_custkey, c_mktsegment, '2024-06-01' AS updated FROM s
    UNION ALL SELECT c_custkey, c_mktsegment, '2024-01-01' FROM customer WHERE c_nationkey <> 3 AND c_custkey NOT IN (SELECT c_custkey FROM s)""")
def upsert_partitions(spark, sf):
    """A merge that rewrites only the nations its source touches."""
    path = scratch(spark, "upsert-parts")
    _base(spark, sf).withColumn("updated", F.lit("2024-01-01")).write.partitionBy("c_nationkey").parquet(path)
    source = _delta(spark, sf).where("c_nationkey < 6")
    jobs.upsert_partitions(spark, path, source, ["c_custkey"], ["c_nationkey"], {"updated": F.lit("2024-06-01")})
    return spark.read.parquet(path).select("c_custkey", "c_mktsegment", "updated")


@query("scd2_folder", "PL6 H4 H1", _HISTORY + " SELECT * FROM h")
def scd2_folder(spark, sf):
    """History kept in folders: a run touches the current versions only."""
    root = scratch(spark, "scd2")
    jobs.run_scd2(spark, root, _base(spark, sf), ["c_custkey"], FIRST)
    return _shown(jobs.run_scd2(spark, root, _delta(spark, sf), ["c_custkey"], SECOND))


_CHANGED = f"""
    WITH b AS (SELECT * FROM customer WHERE c_nationkey <> 3), s AS ({_DELTA}),
    a AS (SELECT c_custkey, c_mktsegment FROM s WHERE c_nationkey <> 8 UNION ALL
          SELECT c_custkey, c_mktsegment FROM b WHERE c_nationkey <> 8 AND c_custkey NOT IN (SELECT c_custkey FROM s))"""


def _captured(spark, sf, name):
    log = ChangeLog(spark, scratch(spark, name))
    log.capture(_base(spark, sf), _after(spark, sf), ["c_custkey"])
    return log


@query("feed_read_only", "CD5", _CHANGED + """
    SELECT CAST(2 AS BIGINT) AS reads, (SELECT count(*) FROM a ANTI JOIN b ON a.c_custkey = b.c_custkey)
      + (SELECT count(*) FROM b ANTI JOIN a ON a.c_custkey = b.c_custkey)
      + 2 * (SELECT count(*) FROM a JOIN b ON a.c_custkey = b.c_custkey WHERE a.c_mktsegment <> b.c_mktsegment) AS row_count""")
def feed_read_only(spark, sf):
    """Reading twice gives the same changes twice."""
    log = _captured(spark, sf, "feed-read")
    counts = table_counts({"one": log.pending("reader"), "two": log.pending("reader")})
    return counts.groupBy("row_count").agg(F.count(F.lit(1)).alias("reads"))


@query("feed_consume", "CD6 CD7 PL5 ST4", _CHANGED + """
    SELECT c_custkey, c_mktsegment, true AS first_run, false AS second_run FROM a""")
def feed_consume(spark, sf):
    """The changes are applied to a target and consumed: a second run finds none."""
    log, target = _captured(spark, sf, "feed-consume"), scratch(spark, "feed-target")
    wr.reload(_base(spark, sf), target)
    apply = apply_to_folder(spark, target, ["c_custkey"])
    first, second = log.consume("applier", apply), log.consume("applier", apply)
    return spark.read.parquet(target).select("c_custkey", "c_mktsegment").withColumn(
        "first_run", F.lit(first)).withColumn("second_run", F.lit(second))


@query("feed_partitions", "CD6 CD7 PL5", _CHANGED + " SELECT c_custkey, c_mktsegment FROM a")
def feed_partitions(spark, sf):
    """The changes applied to a target laid out by nation; only touched nations are rewritten."""
    log, target = _captured(spark, sf, "feed-parts"), scratch(spark, "feed-parts-target")
    _base(spark, sf).write.partitionBy("c_nationkey").parquet(target)
    log.consume("applier", apply_to_folder(spark, target, ["c_custkey"], partition_by=["c_nationkey"]))
    return spark.read.parquet(target).select("c_custkey", "c_mktsegment")


@query("feed_stream", "CD6 CD7 PL5 ST1", _CHANGED + " SELECT c_custkey, c_mktsegment FROM a")
def feed_stream(spark, sf):
    """The same, as a stream."""
    log, target = _captured(spark, sf, "feed-stream"), scratch(spark, "feed-stream-target")
    wr.reload(_base(spark, sf), target)
    schema = T.StructType(spark.read.parquet(log.path).schema.fields)
    for _ in range(2):
        log.stream("feed_stream", schema, f"{target}-checkpoint", apply_to_folder(spark, target, ["c_custkey"])).awaitTermination(600)
    return spark.read.parquet(target).select("c_custkey", "c_mktsegment")


@query("insert_change_images", "CD6", _CHANGED + """
    , d AS (SELECT a.c_custkey, a.c_mktsegment FROM a ANTI JOIN b ON a.c_custkey = b.c_custkey
      UNION ALL SELECT b.c_custkey, b.c_mktsegment FROM b ANTI JOIN a ON a.c_custkey = b.c_custkey
      UNION ALL SELECT b.c_custkey, b.c_mktsegment FROM a JOIN b ON a.c_custkey = b.c_custkey WHERE a.c_mktsegment <> b.c_mktsegment
      UNION ALL SELECT a.c_custkey, a.c_mktsegment FROM a JOIN b ON a.c_custkey = b.c_custkey WHERE a.c_mktsegment <> b.c_mktsegment)
    SELECT * FROM d""")
def insert_change_images(spark, sf):
    """A plain insert of the feed keeps old images and deleted rows; the apply step does not."""
    log, target = _captured(spark, sf, "feed-insert"), scratch(spark, "feed-images")
    log.consume("copier", lambda changes: wr.append_rows(changes.select("c_custkey", "c_mktsegment"), target))
    return spark.read.parquet(target)


def _star(spark, name):
    dims = {"customers": ("customer_key", ["customer_name", "nation"]), "priorities": ("priority_key", ["priority"])}
    return jobs.Star(scratch(spark, name), dims, "fact", ["order_id"], {"amount": "amount"},
                     null_safe=True)


_SALES_TYPE = T.StructType().add("order_id", T.LongType()).add("customer_name", T.StringType()).add(
    "nation", T.StringType()).add("priority", T.StringType()).add("amount", T.DoubleType())


def _audit_rows(log):
    return log.read().select("job", "status", F.coalesce("source_count", F.lit(-1)).alias("source_count"),
                             F.coalesce("target_count", F.lit(-1)).alias("target_count"),
                             F.coalesce("match_status", F.lit("-")).alias("match_status"))


@query("star_with_audit", "PL7 SP1 SP2 SK21 AU1 AU4", """
    WITH n AS (SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT 'stage_load' AS job, 'SUCCESS' AS status, CAST(-1 AS BIGINT) AS source_count, n AS target_count, '-' AS match_status FROM n
    UNION ALL SELECT 'star_load', 'SUCCESS', n, n, 'MATCH' FROM n""")
def star_with_audit(spark, sf):
    stage, staging = Stage(scratch(spark, "star-stage")), scratch(spark, "star-staging")
    wr.write(_sales(spark, sf).drop("o_orderdate"), stage.path, kind="csv")
    log = AuditLog(spark, scratch(spark, "star-audit"))
    jobs.stage_then_star(spark, stage, _SALES_TYPE, staging, _star(spark, "star"), log, "run-1")
    return _audit_rows(log)


@query("star_new_with_audit", "PL8 SP3 SP4 SC35 IN2 AU2 AU4 AU5", """
    WITH s AS (SELECT o_orderkey, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey),
    f AS (SELECT count(*) AS n FROM s WHERE o_orderstatus = 'F'), a AS (SELECT count(*) AS n FROM s)
    SELECT 'stage_file' AS job, 'SUCCESS' AS status, CAST(-1 AS BIGINT) AS source_count, n AS target_count, '-' AS match_status FROM f
    UNION ALL SELECT 'stage_file', 'SUCCESS', -1, n, '-' FROM a UNION ALL SELECT 'star_new', 'SUCCESS', n, n, '-' FROM f
    UNION ALL SELECT 'star_new', 'SUCCESS', n, n, '-' FROM a UNION ALL SELECT 'star_new', 'SUCCESS', n, n, '-' FROM a""")
def star_new_with_audit(spark, sf):
    """A first file, a second that holds the first, and the second again."""
    stage, staging, star = Stage(scratch(spark, "new-stage")), scratch(spark, "new-staging"), _star(spark, "new-star")
    sales = _sales(spark, sf).drop("o_orderdate")
    status = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), "o_orderstatus")
    finished = sales.join(status.where("o_orderstatus = 'F'"), "order_id", "left_semi")
    log = AuditLog(spark, scratch(spark, "new-audit"))
    for number, rows in enumerate((finished, sales), 1):
        wr.export_named(rows, stage.path, f"sales_{number}.csv", layout="parts")
        jobs.stage_file(spark, stage, f"sales_{number}.csv", _SALES_TYPE, staging, log, f"run-{number}")
        jobs.run_star_new(spark, staging, star, log, f"run-{number}")
    jobs.run_star_new(spark, staging, star, log, "run-3")
    return _audit_rows(log)


@query("empty_input_failure", "AU3 AU5 AU9", """
    SELECT 'star_new' AS job, 'FAILURE' AS status, 'staging is empty' AS message FROM (SELECT count(*) AS n FROM orders WHERE o_totalprice < 0) WHERE n = 0""")
def empty_input_failure(spark, sf):
    staging = scratch(spark, "empty-staging")
    wr.reload(_sales(spark, sf).where("amount < 0"), staging)
    log = AuditLog(spark, scratch(spark, "empty-audit"))
    jobs.run_star_new(spark, staging, _star(spark, "empty-star"), log, "run-1")
    return log.read().select("job", "status", "message")


@query("failure_audit", "AU5", "SELECT 'broken' AS job, 'FAILURE' AS status, count(*) AS source_count FROM orders")
def failure_audit(spark, sf):
    """An error inside the run becomes its audit row; nothing is raised."""
    log = AuditLog(spark, scratch(spark, "failure-audit"))
    with log.run("broken", "run-1") as result:
        result.source_count = table(spark, sf, "orders").count()
        require_rows(table(spark, sf, "orders").where("o_totalprice < 0"), "orders")
    return log.read().select("job", "status", "source_count")


@query("latest_audit_row", "O5 AU4", "SELECT 'run-2' AS run_id, 'SUCCESS' AS status, count(*) AS target_count FROM orders")
def latest_audit_row(spark, sf):
    log = AuditLog(spark, scratch(spark, "latest-audit"))
    for number, name in enumerate(("customer", "orders"), 1):
        log.append(RunResult(f"run-{number}", "load", target_count=table(spark, sf, name).count(),
                             started=AS_OF + dt.timedelta(hours=number), ended=AS_OF + dt.timedelta(hours=number, seconds=9)))
    return log.latest("load").select("run_id", "status", "target_count")


@query("refine_then_star", "PL10 P18 P19 AU4", """
    WITH n AS (SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW')
    SELECT 'refine' AS job, 'SUCCESS' AS status, CAST(-1 AS BIGINT) AS source_count, n AS target_count, '-' AS match_status FROM n
    UNION ALL SELECT 'star_new', 'SUCCESS', n, n, '-' FROM n""")
def refine_then_star(spark, sf):
    """Raw rows come twice and some lack their priority; each order that has one arrives once."""
    sales = _sales(spark, sf).drop("o_orderdate").withColumn(
        "priority", F.when(F.col("priority") != "5-LOW", F.col("priority")))
    log = AuditLog(spark, scratch(spark, "refine-audit"))
    jobs.refine_then_star(spark, sales.unionByName(sales), ["order_id"], ["priority"], scratch(spark, "refined"),
                          _star(spark, "refine-star"), log, "run-1")
    return _audit_rows(log)


@query("normalise_flat", "SP5 DM3 FT3 FT4", """
    SELECT 'segments' AS table_name, count(DISTINCT c_mktsegment) AS row_count FROM customer
    UNION ALL SELECT 'nations', count(DISTINCT c_nationkey) FROM customer UNION ALL SELECT 'fact', count(*) FROM customer""")
def normalise_flat(spark, sf):
    flat = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    specs = [DimensionSpec("segments", "segment", "segment_code", "S"), DimensionSpec("nations", "nation", "nation_code", "N")]
    return table_counts(jobs.normalise_flat(spark, flat, specs, ["customer_id"], scratch(spark, "normal")))


def _staging(spark, sf, name):
    path = scratch(spark, name)
    rows = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("load_id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Y")).otherwise(F.lit("N")).alias("processed_flag"))
    jobs.add_to_staging(rows, path)
    return path


_TARGETS = {"buyer": ["customer_id"], "sale": ["order_id", "customer_id", "amount"]}


@query("flagged_load", "SP7 IN5 SK22 AU6 AU9 G4", """
    SELECT load_id, target_table, n AS source_count, n AS target_count, 'SUCCESS' AS status FROM (
      SELECT strftime(o_orderdate, '%Y-%m') AS load_id, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1),
      (VALUES ('buyer'), ('sale')) t(target_table)""")
def flagged_load(spark, sf):
    staging, root = _staging(spark, sf, "flagged"), scratch(spark, "flagged-targets")
    assert jobs.load_flagged(spark, staging, _TARGETS, root, f"{root}/audit", 1) == "loaded"
    assert jobs.load_flagged(spark, staging, _TARGETS, root, f"{root}/audit", 2) == "nothing waits"
    return spark.read.parquet(f"{root}/audit").select("load_id", "target_table", "source_count", "target_count", "status")


@query("flagged_consumed", "SP7 IN5 SK22 AU6 AU9 PL9", """
    SELECT load_id, target_table, n AS source_count, n AS target_count, 'SUCCESS' AS status FROM (
      SELECT strftime(o_orderdate, '%Y-%m') AS load_id, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1),
      (VALUES ('buyer'), ('sale')) t(target_table)""")
def flagged_consumed(spark, sf):
    """The same load, remembering the files it has read in place of moving them."""
    staging, root = scratch(spark, "consumed"), scratch(spark, "consumed-targets")
    rows = table(spark, sf, "orders").where("o_orderstatus <> 'F'").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("load_id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"))
    load = ConsumedLoad(spark, staging, _TARGETS, root, f"{root}/log")
    for number, part in enumerate(("load_id < '1997'", "load_id >= '1997'"), 1):
        rows.where(part).write.mode("append").parquet(staging)
        load.run(number)
    assert load.run(3) is None
    return load.audit().select("load_id", "target_table", "source_count", "target_count", "status")


@query("flag_after_load", "IN5 UP2 G4", "SELECT 'Y' AS processed_flag, count(*) AS row_count FROM orders")
def flag_after_load(spark, sf):
    staging, root = _staging(spark, sf, "flags"), scratch(spark, "flags-targets")
    jobs.load_flagged(spark, staging, _TARGETS, root, f"{root}/audit", 1)
    return spark.read.parquet(staging).groupBy("processed_flag").agg(F.count(F.lit(1)).alias("row_count"))


@query("debounced_load", "PL9 SP8 AU8", """
    SELECT check_id, CASE WHEN check_id = 4 THEN CAST(0 AS BIGINT) ELSE n END AS waiting_rows, quiet AS quiet_checks, action
    FROM (SELECT count(*) AS n FROM orders WHERE o_orderstatus <> 'F'),
         (VALUES (1, 1::BIGINT, 'WAIT'), (2, 2, 'WAIT'), (3, 3, 'CALL SP'), (4, 0, 'IDLE')) c(check_id, quiet, action)""")
def debounced_load(spark, sf):
    """Four checks: the third finds the rows quiet and loads them, the fourth finds none."""
    staging, root = _staging(spark, sf, "quiet"), scratch(spark, "quiet-targets")
    for minute in range(4):
        jobs.check_and_load(spark, staging, f"{root}/checks", _TARGETS, root, f"{root}/audit",
                            AS_OF + dt.timedelta(minutes=minute))
    return spark.read.parquet(f"{root}/checks").select("check_id", "waiting_rows", "quiet_checks", "action")


@query("quiet_live", "AU8 SP8 PL9 ST3", """
    SELECT status AS series, check_id, n AS record_count, check_id AS quiet_checks,
           CASE WHEN check_id = 3 THEN 'CALL SP' ELSE 'WAIT' END AS action, CASE WHEN check_id = 3 THEN n ELSE 0 END AS loaded
    FROM (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1),
         (SELECT CAST(range AS BIGINT) AS check_id FROM range(1, 4))""")
def quiet_live(spark, sf):
    """Orders arrive as files of a stream; timers check each status until it was quiet three times, then it is loaded."""
    root, called = scratch(spark, "quiet-live"), []
    rows = _orders(spark, sf)
    _arrive(rows, f"{root}/stage", "first")

    def on_check(checks, number):
        checks.write.mode("overwrite").parquet(f"{root}/checks/run={number}")
        ready = [r["series"] for r in checks.where(F.col("action") == CALL).select("series").collect()]
        if ready:
            staged = spark.read.schema(_ORDER_TYPE).options(**FileFormat().reader_options()).csv(f"{root}/stage/*")
            staged.where(F.col("status").isin(ready)).write.mode("overwrite").parquet(f"{root}/rows/run={number}")
        called.extend(ready)

    arrivals = spark.readStream.schema(_ORDER_TYPE).options(**FileFormat().reader_options()).option(
        "recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(f"{root}/stage")
    series = {r[0] for r in rows.select("status").distinct().collect()}
    run_until(start_checks(spark, arrivals, "status", f"{root}/checkpoint", 600, on_check), lambda: set(called) >= series, 300)
    loaded = spark.read.parquet(f"{root}/rows").groupBy(F.col("status").alias("series")).agg(F.count(F.lit(1)).alias("n"))
    checks = spark.read.parquet(f"{root}/checks").join(loaded, "series")
    return checks.select("series", "check_id", "record_count", "quiet_checks", "action",
                         F.when(F.col("action") == CALL, F.col("n")).otherwise(0).alias("loaded"))


@query("marked_duplicate_report", "PL12 SC33 AU10 SC22", """
    SELECT count(*) AS clean_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, CAST(sum(CAST(k AS DOUBLE)) AS DOUBLE) AS measure_total
    FROM (SELECT event_type, user_id, k, count(*) AS n FROM (
      SELECT event_type, user_id, json_extract_string(props, '$.k') AS k FROM events) GROUP BY 1, 2, 3)""")
def marked_duplicate_report(spark, sf):
    folder = scratch(spark, "marked-report")
    rows = table(spark, sf, "events").select("event_type", F.col("user_id").cast("string").alias("user_id"),
                                            F.get_json_object("props", "$.k").alias("k"))
    wr.write(rows, folder, kind="csv", fmt=FileFormat(sep="|"))
    write_text(spark, f"{folder}/batch.ctl", "")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in rows.columns])
    return jobs.marked_duplicate_report(spark, folder, "batch.ctl", schema, "k", glob="*.csv").summary


@query("resend_and_clean", "P19 UP1", "SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders")
def resend_and_clean(spark, sf):
    """Two deliveries of the same rows reduced to one per key."""
    orders = _orders(spark, sf).select("order_id", "status")
    return drop_duplicates(orders.unionByName(orders), ["order_id"])


@query("apply_versions", "CD7 CD6", _CHANGED + " SELECT c_custkey, c_mktsegment FROM b")
def apply_versions(spark, sf):
    """There and back: the second version undoes the first, the last change per key wins."""
    base, after = _base(spark, sf), _after(spark, sf)
    forth = ch.diff_snapshots(base, after, ["c_custkey"]).withColumn("version", F.lit(1))
    back = ch.diff_snapshots(after, base, ["c_custkey"]).withColumn("version", F.lit(2))
    return ch.apply_changes(base, forth.unionByName(back), ["c_custkey"], "version").select("c_custkey", "c_mktsegment")
