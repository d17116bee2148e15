"""Reconciliation, audit rows, quiet periods, run history."""

from __future__ import annotations

from pyspark.sql import functions as F

from pipekit.functions import add_time
from pipekit.operators import audit
from pipekit.plans.catalog.registry import query, table
from pipekit.session import scratch
from pipekit.sinks import writers as wr


@query("reconcile", "AU1 G1", """
    SELECT source_count, target_count, CASE WHEN source_count = target_count THEN 'MATCH' ELSE 'MISMATCH' END AS match_status
    FROM (SELECT (SELECT count(*) FROM orders) AS source_count, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS target_count)""")
def reconcile(spark, sf):
    return audit.reconcile(table(spark, sf, "orders"), table(spark, sf, "lineitem").select("l_orderkey").distinct())


@query("reconcile_content", "AU1 G1", """
    SELECT count(*) AS source_count, count(*) AS target_count, 'same' AS kind, 'MATCH' AS match_status FROM orders
    UNION ALL SELECT count(*), count(*), 'changed', CASE WHEN count(*) FILTER (o_orderkey % 100 = 7) > 0 THEN 'MISMATCH' ELSE 'MATCH' END
    FROM orders""")
def reconcile_content(spark, sf):
    """Counts agree in both cases; contents only where no row was changed."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 100 == 7, F.lit("?")).otherwise(F.col("o_orderstatus")))
    out = [audit.reconcile_content(orders, other, ["o_orderkey"]).withColumn("kind", F.lit(kind))
           for kind, other in (("same", orders.repartition(7)), ("changed", changed))]
    return out[0].unionByName(out[1]).select("source_count", "target_count", "kind", "match_status")


@query("missing_rows", "AU2 J9", """
    SELECT missing, CASE WHEN missing > 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS status FROM (
      SELECT count(*) AS missing FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))""")
def missing_rows(spark, sf):
    fact = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return audit.missing_rows(table(spark, sf, "orders"), fact, ["o_orderkey"])


@query("measured_targets", "AU6 J10", """
    SELECT load_day, target_table, source_count, coalesce(measured, 0) AS target_count FROM
      (SELECT strftime(ts, '%Y-%m-%d') AS load_day, count(*) AS source_count FROM events GROUP BY 1) s
      CROSS JOIN (VALUES ('purchases'), ('users')) t(target_table)
      LEFT JOIN (SELECT 'purchases' AS tt, strftime(ts, '%Y-%m-%d') AS dd, count(*) AS measured FROM events
                   WHERE event_type = 'purchase' GROUP BY 2
                 UNION ALL SELECT 'users', strftime(ts, '%Y-%m-%d'), count(DISTINCT user_id) FROM events GROUP BY 2) m
        ON m.tt = target_table AND m.dd = load_day""")
def measured_targets(spark, sf):
    events = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("load_day"), "event_type", "user_id")
    return audit.load_target_audit(events, "load_day", {
        "purchases": events.where("event_type = 'purchase'"), "users": events.select("load_day", "user_id").distinct()})


_CHECKS = """
    span AS (SELECT date_trunc('hour', min(ts)) AS first, date_trunc('hour', max(ts)) AS last FROM events),
    grid AS (SELECT e.event_type, CAST(unnest(generate_series(first, last, INTERVAL 1 HOUR)) AS TIMESTAMP) AS check_time
             FROM (SELECT DISTINCT event_type FROM events) e, span),
    checks AS (SELECT g.event_type, g.check_time, count(v.event_id) AS record_count FROM grid g
               LEFT JOIN events v ON v.event_type = g.event_type AND v.ts >= g.check_time AND v.ts < g.check_time + INTERVAL 1 HOUR GROUP BY 1, 2)"""


def _checks(spark, sf):
    """Rows waiting at the end of each hour, per event type, as a sequence of checks."""
    events = table(spark, sf, "events")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    first, last = events.agg(F.min(hour), F.max(hour)).first()
    hours = 0 if first is None else int((last - first).total_seconds() // 3600) + 1
    grid = events.select("event_type").distinct().withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(max(1, hours))))).select(
        "event_type", add_time(F.lit(first).cast("timestamp_ntz"), minutes=(F.col("step") - 1) * 60).alias("check_time"))
    counts = events.groupBy("event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("check_time")).agg(
        F.count(F.lit(1)).alias("n"))
    return grid.join(counts, ["event_type", "check_time"], "left").select(
        "event_type", "check_time", F.coalesce("n", F.lit(0)).alias("record_count"))


@query("quiet_period", "AU8", f"""
    WITH {_CHECKS},
    lagged AS (SELECT *, lag(record_count) OVER w AS prev, row_number() OVER w AS pos FROM checks WINDOW w AS (PARTITION BY event_type ORDER BY check_time)),
    marked AS (SELECT *, max(CASE WHEN record_count = 0 OR prev IS NULL OR record_count <> prev THEN pos END)
               OVER (PARTITION BY event_type ORDER BY check_time ROWS UNBOUNDED PRECEDING) AS start FROM lagged),
    folded AS (SELECT *, CASE WHEN record_count = 0 THEN 0 WHEN start = 1 THEN pos ELSE pos - start END AS quiet FROM marked)
    SELECT event_type, strftime(check_time, '%Y-%m-%d %H') AS check_time, record_count, CAST(quiet AS BIGINT) AS quiet_checks,
           CASE WHEN record_count <> 0 AND prev IS NOT NULL AND record_count <> prev THEN 'Y' ELSE 'N' END AS new_record_found,
           CASE WHEN record_count = 0 THEN 'IDLE' WHEN prev IS NOT NULL AND record_count = prev AND quiet >= 3 THEN 'CALL SP'
                ELSE 'WAIT' END AS action FROM folded""")
def quiet_period(spark, sf):
    out = audit.quiet_period(_checks(spark, sf), "check_time", "record_count", ["event_type"])
    return out.withColumn("check_time", F.date_format("check_time", "yyyy-MM-dd HH"))


@query("quiet_period_single", "AU8", """
    WITH checks AS (SELECT date_trunc('hour', ts) AS check_time, count(*) AS record_count FROM events GROUP BY 1),
    lagged AS (SELECT *, lag(record_count) OVER w AS prev, row_number() OVER w AS pos FROM checks WINDOW w AS (ORDER BY check_time)),
    marked AS (SELECT *, max(CASE WHEN prev IS NULL OR record_count <> prev THEN pos END)
               OVER (ORDER BY check_time ROWS UNBOUNDED PRECEDING) AS start FROM lagged)
    SELECT strftime(check_time, '%Y-%m-%d %H') AS check_time, record_count, CAST(CASE WHEN start = 1 THEN pos ELSE pos - start END AS BIGINT) AS quiet_checks FROM marked""")
def quiet_period_single(spark, sf):
    checks = table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("check_time")).agg(
        F.count(F.lit(1)).alias("record_count"))
    return audit.quiet_period(checks, "check_time", "record_count").select(
        F.date_format("check_time", "yyyy-MM-dd HH").alias("check_time"), "record_count", "quiet_checks")


def _runs(spark, sf):
    """Events as runs of tasks: one task per event type."""
    states = F.create_map(*[F.lit(x) for x in ("view", "SUCCEEDED", "click", "EXECUTING", "error", "FAILED", "signup", "SCHEDULED")])
    return table(spark, sf, "events").select(
        F.col("event_id").alias("run_id"), F.concat(F.lit("task_"), "event_type").alias("task_name"),
        F.coalesce(F.try_element_at(states, F.col("event_type")), F.lit("SKIPPED")).alias("state"),
        F.col("ts").alias("scheduled_time"), add_time("ts", seconds=2).alias("start_time"),
        add_time(add_time("ts", seconds=2), minutes=F.col("user_id").cast("int")).alias("completed_time"),
        F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("")).alias("error_message"))


@query("run_history", "AU11 F13 F15 F17 F18 P8 O6 W3", """
    SELECT task_name, execution_status, strftime(check_time + INTERVAL 330 MINUTE, '%Y-%m-%d') AS execution_date,
           strftime(check_time + INTERVAL 330 MINUTE, '%I:%M:%S %p') || ' IST' AS scheduled_clock,
           coalesce(strftime(start_at + INTERVAL 330 MINUTE, '%I:%M:%S %p') || ' IST', '-') AS start_clock, seconds AS execution_seconds
    FROM (SELECT 'task_' || event_type AS task_name, CASE event_type WHEN 'view' THEN 'SUCCESS' WHEN 'click' THEN 'RUNNING'
            WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SCHEDULED' ELSE 'SKIPPED' END AS execution_status,
            ts AS check_time, ts + INTERVAL 2 SECOND AS start_at, user_id * 60 AS seconds FROM events
          UNION ALL SELECT 'task_' || event_type, 'UPCOMING', max(ts) + (step) * INTERVAL 1 MINUTE, NULL, -1
            FROM events, (SELECT CAST(range AS INTEGER) AS step FROM range(1, 6)) GROUP BY event_type, step)""")
def run_history(spark, sf):
    return audit.run_history(_runs(spark, sf), "Asia/Kolkata", " IST").select(
        "task_name", "execution_status", "execution_date", "scheduled_clock",
        F.coalesce("start_clock", F.lit("-")).alias("start_clock"),
        F.coalesce("execution_seconds", F.lit(-1)).cast("bigint").alias("execution_seconds"))


@query("final_status", "AU12 J6", """
    SELECT event_id AS run_id, CASE WHEN event_type = 'click' THEN 'RUNNING'
           WHEN event_type = 'view' AND value < 20 THEN 'SUCCESS' ELSE 'FAILURE' END AS final_status FROM events""")
def final_status(spark, sf):
    log = table(spark, sf, "events").where("value < 20").select(F.col("event_id").alias("run_id"), F.lit("SUCCESS").alias("status"))
    return audit.final_status(_runs(spark, sf), log).select("run_id", "final_status")


@query("arrival_audit", "AU7 G5", """
    SELECT strftime(ts, '%Y-%m-%d %H') AS load_id, count(*) AS arrived, min(event_id) AS first_id FROM events GROUP BY 1""")
def arrival_audit(spark, sf):
    """Two deliveries, morning and afternoon; each appends an audit row for each of its loads."""
    path, events = scratch(spark, "arrival-audit"), table(spark, sf, "events")
    for cond in (F.hour("ts") < 12, F.hour("ts") >= 12):
        wr.append_rows(events.where(cond).groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("load_id")).agg(
            F.count(F.lit(1)).alias("arrived"), F.min("event_id").alias("first_id")), path)
    return spark.read.parquet(path)
