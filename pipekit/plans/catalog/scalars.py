"""Scalar functions, projections, filters, row validation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pipekit import functions as pf
from pipekit.operators import quality
from pipekit.plans.catalog.registry import day, dbl, money, query, table
from pipekit.sources import events as ev


@query("case_and_length", "F1 F2 F3 P1 P2", """
    SELECT c_custkey, upper(c_name) AS upper_name, lower(c_mktsegment) AS lower_segment,
           CAST(length(c_name) AS INTEGER) AS name_length FROM customer""")
def case_and_length(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.upper("c_name").alias("upper_name"), F.lower("c_mktsegment").alias("lower_segment"),
        F.length("c_name").alias("name_length"))


@query("pad_and_concat", "F4 F5", """
    SELECT p_partkey, 'P' || CASE WHEN length(CAST(p_size AS VARCHAR)) >= 2 THEN CAST(p_size AS VARCHAR)
             ELSE lpad(CAST(p_size AS VARCHAR), 2, '0') END AS size_code,
           p_brand || ' / ' || p_type AS label FROM part""")
def pad_and_concat(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", pf.coded_label("P", "p_size").alias("size_code"),
        F.concat("p_brand", F.lit(" / "), "p_type").alias("label"))


@query("trim_split_substr_cast", "F6 F7 F8 F9", """
    SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, split_part(p_name, ' ', 1) AS first_word,
           substr(p_name, 2, 3) AS middle, CAST(substr(p_brand, 7) AS INTEGER) AS brand_no FROM part""")
def trim_split_substr_cast(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.split("p_name", " ").getItem(0).alias("first_word"), F.col("p_name").substr(2, 3).alias("middle"),
        F.substring("p_brand", 7, 20).cast("int").alias("brand_no"))


@query("null_default_arithmetic", "F11 F12 F28", """
    SELECT c.c_custkey, coalesce(n.n_name, 'UNKNOWN') AS nation,
           CAST(CAST(c_acctbal AS DECIMAL(14,2)) * 2 + 1 AS DOUBLE) AS doubled, c_acctbal < 0 AS overdrawn
    FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c.c_nationkey = n.n_nationkey""")
def null_default_arithmetic(spark, sf):
    nation = table(spark, sf, "nation").where("n_regionkey <> 2").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, sf, "customer").join(nation, "c_nationkey", "left").select(
        "c_custkey", F.coalesce("n_name", F.lit("UNKNOWN")).alias("nation"),
        dbl(money("c_acctbal") * 2 + 1).alias("doubled"), (F.col("c_acctbal") < 0).alias("overdrawn"))


@query("add_time", "F13", """
    SELECT event_id, strftime(ts + INTERVAL 1 DAY + INTERVAL 2 HOUR + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS due
    FROM events""")
def add_time(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.date_format(pf.add_time("ts", days=1, hours=2, minutes=30), "yyyy-MM-dd HH:mm:ss").alias("due"))


@query("year_difference", "F14", """
    SELECT o_orderkey, CAST(date_diff('year', o_orderdate, TIMESTAMP '2002-01-01') AS INTEGER) AS years FROM orders""")
def year_difference(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", pf.year_diff("o_orderdate", F.lit("2002-01-01").cast("timestamp_ntz")).alias("years"))


@query("second_difference", "F15 F16", """
    SELECT event_id, date_diff('second', ts, TIMESTAMP '2024-02-01 00:00:00') AS seconds FROM events""")
def second_difference(spark, sf):
    as_of = pf.times.as_of_column(dt.datetime(2024, 2, 1))
    return table(spark, sf, "events").select("event_id", pf.second_diff("ts", as_of).alias("seconds"))


@query("local_clock", "F17 F18", """
    SELECT event_id, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d') AS local_date,
           strftime(ts + INTERVAL 330 MINUTE, '%I:%M:%S %p') || ' IST' AS local_clock FROM events""")
def local_clock(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", pf.local_date("ts", "Asia/Kolkata").alias("local_date"),
        pf.local_clock("ts", "Asia/Kolkata", " IST").alias("local_clock"))


@query("name_stamp", "F19", """
    SELECT event_id, 'events_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv' AS file_name FROM events""")
def name_stamp(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("events_"), pf.stamp("ts"), F.lit(".csv")).alias("file_name"))


@query("parse_dates", "F20", """
    SELECT o_orderkey, CAST(date_diff('day', DATE '1995-01-01', CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE)) AS INTEGER)
           AS day_no FROM orders""")
def parse_dates(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.date_diff(pf.parse_date(day("o_orderdate")), F.lit("1995-01-01").cast("date")).alias("day_no"))


@query("url_decode", "F21", """
    SELECT p_partkey, 'in/' || p_name || '.csv' AS object_key FROM part""")
def url_decode(spark, sf):
    encoded = F.concat(F.lit("in%2F"), F.replace(F.col("p_name"), F.lit(" "), F.lit("+")), F.lit(".csv"))
    return table(spark, sf, "part").select("p_partkey", pf.decode_key(encoded).alias("object_key"))


@query("path_parts", "F22 F23", r"""
    WITH p AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS path FROM pages)
    SELECT page_id, split_part(path, '/', 1) AS first_segment, split_part(path, '/', -1) AS last_segment,
           split_part(path, '/', -1) AS base_name,
           regexp_replace(split_part(path, '/', -1), '(.)\.[^.]*$', '\1') AS stem,
           lower(regexp_extract(split_part(path, '/', -1), '.(\.[^.]*)$', 1)) AS extension FROM p""")
def path_parts(spark, sf):
    path = F.regexp_replace("url", "^https?://", "")
    return table(spark, sf, "pages").select(
        "page_id", pf.first_segment(path).alias("first_segment"), pf.last_segment(path).alias("last_segment"),
        pf.base_name(path).alias("base_name"), pf.stem(path).alias("stem"), pf.extension(path).alias("extension"))


@query("bytes_to_kb", "F24", """
    SELECT doc_id, round(CAST(n_chars * 128 AS DOUBLE) / 1024, 2) AS kb FROM documents""")
def bytes_to_kb(spark, sf):
    return table(spark, sf, "documents").select("doc_id", pf.size_kb(F.col("n_chars") * 128).alias("kb"))


@query("safe_names", "F25 SC36", """
    SELECT page_id, regexp_full_match(url, '[A-Za-z0-9._/-]+') AS url_is_safe,
           regexp_full_match(regexp_replace(url, '[^A-Za-z0-9]', '_', 'g'), '[A-Za-z0-9._/-]+') AS name_is_safe FROM pages""")
def safe_names(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", pf.safe_name("url").alias("url_is_safe"),
        pf.safe_name(F.regexp_replace("url", "[^A-Za-z0-9]", "_")).alias("name_is_safe"))


@query("event_json_fields", "F27", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def event_json_fields(spark, sf):
    return table(spark, sf, "events").select("event_id", pf.json_fields("props", "k bigint")["k"].alias("k"))


@query("array_access", "F26", """
    SELECT p_partkey, split_part(p_name, ' ', 2) AS second_word,
           unnest(string_split(p_name, ' ')) AS word FROM part""")
def array_access(spark, sf):
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey", F.get(words, F.lit(1)).alias("second_word"), F.explode(words).alias("word"))


@query("rename_columns", "P3", "SELECT n.s_suppkey AS id, n.s_name AS name, n.s_nationkey AS nation FROM supplier n")
def rename_columns(spark, sf):
    return pf.rename_by_position(
        table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"), ["id", "name", "nation"])


@query("nested_flatten", "P4 F26 SC27", """
    SELECT c_custkey AS id, c_name AS name, n_name AS city, n_regionkey AS country
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def nested_flatten(spark, sf):
    nested = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.struct(F.col("n_name").alias("city"), F.col("n_regionkey").alias("country")).alias("address"))
    return pf.flatten(nested)


@query("pick_nested", "P4 P2", """
    SELECT o_orderkey AS order_id, o_orderpriority AS priority FROM orders""")
def pick_nested(spark, sf):
    nested = table(spark, sf, "orders").select("o_orderkey", F.struct("o_orderstatus", "o_orderpriority").alias("flags"))
    return pf.pick(nested, {"order_id": "o_orderkey", "priority": "flags.o_orderpriority"})


@query("uplift_price", "P5", """
    SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(14,2)) * 1.10 AS DOUBLE) AS raised FROM part""")
def uplift_price(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", dbl(money("p_retailprice") * F.lit("1.10").cast("decimal(3,2)")).alias("raised"))


@query("line_amount", "P5 F12", """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(l_quantity AS DECIMAL(14,2)) * CAST(l_extendedprice AS DECIMAL(14,2)) AS DOUBLE) AS amount FROM lineitem""")
def line_amount(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", dbl(money("l_quantity") * money("l_extendedprice")).alias("amount"))


@query("band_summary", "P6 G2 F10 SC17", """
    SELECT CASE WHEN o_totalprice >= 300000 THEN 'HIGH' WHEN o_totalprice >= 100000 THEN 'MEDIUM' ELSE 'LOW' END AS band,
           count(*) AS row_count, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total,
           CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) / count(*) AS average,
           min(o_totalprice) AS lowest, max(o_totalprice) AS highest
    FROM orders GROUP BY 1""")
def band_summary(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_totalprice", pf.band("o_totalprice", [(300000, "HIGH"), (100000, "MEDIUM")], "LOW").alias("band"))
    total = dbl(F.sum(money("o_totalprice")))
    return orders.groupBy("band").agg(
        F.count(F.lit(1)).alias("row_count"), total.alias("total"), (total / F.count(F.lit(1))).alias("average"),
        F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest"))


@query("grade_customers", "P7", """
    SELECT c_custkey, CASE WHEN c_acctbal >= 7500 THEN 'A' WHEN c_acctbal >= 5000 THEN 'B'
           WHEN c_acctbal >= 2500 THEN 'C' ELSE 'D' END AS grade FROM customer""")
def grade_customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", pf.band("c_acctbal", [(7500, "A"), (5000, "B"), (2500, "C")], "D").alias("grade"))


@query("status_map", "P8", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'FINISHED' WHEN o_orderstatus = 'O' THEN 'OPEN'
           ELSE o_orderstatus END AS status FROM orders""")
def status_map(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", pf.map_values("o_orderstatus", {"F": "FINISHED", "O": "OPEN"}).alias("status"))


@query("classify_cutoff", "P9 P10", """
    SELECT p_partkey, CASE WHEN p_size > 7 THEN 'PASS' ELSE 'FAIL' END AS above,
           CASE WHEN p_size >= 7 THEN 'PASS' ELSE 'FAIL' END AS at_least FROM part""")
def classify_cutoff(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", pf.classify("p_size", 7, inclusive=False).alias("above"),
        pf.classify("p_size", 7, inclusive=True).alias("at_least"))


@query("filter_eq", "P11", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(spark, sf):
    return table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


@query("filter_range", "P12", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 65000")
def filter_range(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_totalprice") > 65000).select("o_orderkey", "o_totalprice")


@query("filter_and", "P13 F28", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 100000""")
def filter_and(spark, sf):
    return table(spark, sf, "orders").where(
        (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") >= 100000)).select("o_orderkey", "o_custkey")


@query("filter_in", "P14", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def filter_in(spark, sf):
    return table(spark, sf, "orders").where(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("filter_latest", "P15", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def filter_latest(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where(F.col("o_orderdate") == orders.agg(F.max("o_orderdate")).scalar()).select(
        "o_orderkey", "o_custkey")


_CHECKED = """
    SELECT event_id, CASE WHEN user_id IS NULL THEN 'user_id is required'
           WHEN value < 0 OR value > 100 THEN 'value out of range' END AS error_reason FROM events"""


def _rules():
    return [quality.required("user_id"), quality.in_range("value", 0, 100)]


@query("validate_rows", "P17", f"SELECT event_id, coalesce(error_reason, 'OK') AS outcome FROM ({_CHECKED})")
def validate_rows(spark, sf):
    checked = quality.validate(table(spark, sf, "events"), _rules())
    return checked.select("event_id", F.coalesce("error_reason", F.lit("OK")).alias("outcome"))


@query("valid_and_rejects", "P17", f"""
    SELECT CASE WHEN error_reason IS NULL THEN 'valid' ELSE 'reject' END AS part, count(*) AS row_count
    FROM ({_CHECKED}) GROUP BY 1""")
def valid_and_rejects(spark, sf):
    valid, rejects = quality.split_valid(table(spark, sf, "events"), _rules())
    both = valid.select(F.lit("valid").alias("part")).unionByName(rejects.select(F.lit("reject").alias("part")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("row_count"))


@query("drop_null_rows", "P18", """
    SELECT d.doc_id, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NOT NULL AND d.lang IS NOT NULL""")
def drop_null_rows(spark, sf):
    wide = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return quality.drop_nulls(wide, ["quality", "lang"]).select("doc_id", F.col("quality").cast("int").alias("quality"))


@query("drop_duplicate_rows", "P19", """
    SELECT lang, source, min(doc_id) AS doc_id, md5(text) AS text_key FROM documents GROUP BY lang, source, text""")
def drop_duplicate_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return quality.drop_duplicates(docs, ["text", "lang", "source"], ["doc_id"]).select(
        "lang", "source", "doc_id", F.md5("text").alias("text_key"))


@query("file_type_gate", "P20", r"""
    SELECT page_id, url FROM pages WHERE NOT ends_with(lower(url), '#top')""")
def file_type_gate(spark, sf):
    return table(spark, sf, "pages").where(~F.lower("url").endswith("#top")).select("page_id", "url")


@query("mark_status", "P22", "SELECT s_suppkey, 'PROCESSED' AS status FROM supplier")
def mark_status(spark, sf):
    return pf.mark_status(table(spark, sf, "supplier").select("s_suppkey"))


@query("column_profile", "P23", """
    SELECT 'o_orderkey' AS name, 'bigint' AS type, count(o_orderkey) AS filled FROM orders
    UNION ALL SELECT 'o_custkey', 'bigint', count(o_custkey) FROM orders
    UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders""")
def column_profile(spark, sf):
    orders = table(spark, sf, "orders")
    filled = orders.agg(*[F.count(c).alias(c) for c in orders.columns]).unpivot(
        [], orders.columns, "name", "filled")
    return pf.schema_rows(orders).select("name", "type").join(filled, "name")


@query("long_text_check", "P17", """
    SELECT doc_id, 'text longer than 2000' AS error_reason FROM documents WHERE length(text) > 2000""")
def long_text_check(spark, sf):
    return quality.max_length_violations(table(spark, sf, "documents"), {"text": 2000}).select("doc_id", "error_reason")


@query("file_events", "SC30 P9", """
    SELECT s_suppkey, 'landing' AS bucket, 'in put/' || s_name || '.' || kind AS object_key,
           s_nationkey * 1000 + 7 AS size, 'Created:' || kind AS event_name
    FROM supplier, (VALUES ('csv'), ('txt')) k(kind)""")
def file_events(spark, sf):
    def record(kind):
        return F.struct(
            F.lit(f"Created:{kind}").alias("eventName"), F.lit("2024-01-01T00:00:00Z").alias("eventTime"),
            F.struct(F.struct(F.lit("landing").alias("name")).alias("bucket"),
                     F.struct(F.concat(F.lit("in+put/"), F.url_encode("s_name"), F.lit("." + kind)).alias("key"),
                              (F.col("s_nationkey") * 1000 + 7).alias("size")).alias("object")).alias("s3"))
    log = table(spark, sf, "supplier").select(
        "s_suppkey", F.to_json(F.struct(F.array(record("csv"), record("txt")).alias("Records"))).alias("value"))
    return ev.record_events(log).select(
        "s_suppkey", "bucket", "object_key", F.col("size").cast("int").alias("size"), "event_name")


def _envelopes(spark, sf):
    body = F.struct(
        F.when(F.col("event_type") == "error", "Object Deleted").otherwise("Object Created").alias("detail-type"),
        F.lit("store").alias("source"), day("ts").alias("time"),
        F.struct(F.struct(F.concat(F.lit("bucket-"), "event_type").alias("name")).alias("bucket"),
                 F.struct(F.concat(F.lit("k/"), F.col("event_id").cast("string")).alias("key"),
                          F.col("user_id").alias("size")).alias("object")).alias("detail"))
    log = table(spark, sf, "events").select("event_id", F.to_json(body).alias("value"))
    return ev.envelope_events(log)


_ENVELOPES = """
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'Object Deleted' ELSE 'Object Created' END AS detail_type,
           'store' AS source, strftime(ts, '%Y-%m-%d') AS event_time, 'bucket-' || event_type AS bucket,
           'k/' || event_id AS object_key, user_id AS size FROM events"""


@query("bus_events", "SC31", _ENVELOPES)
def bus_events(spark, sf):
    return _envelopes(spark, sf)


@query("bus_event_filter", "SC32", f"""
    SELECT * FROM ({_ENVELOPES}) WHERE source IN ('store') AND detail_type IN ('Object Created')
      AND bucket IN ('bucket-view', 'bucket-click')""")
def bus_event_filter(spark, sf):
    return ev.filter_events(_envelopes(spark, sf), {
        "source": ["store"], "detail_type": ["Object Created"], "bucket": ["bucket-view", "bucket-click"]})
