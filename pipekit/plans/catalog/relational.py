"""Joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from pipekit.operators import aggregates as ag
from pipekit.operators import joins, keys
from pipekit.operators.audit import load_target_audit, schedule_points, upcoming_points
from pipekit.plans.catalog.registry import day, dbl, money, query, table
from pipekit.sources import rows as lit_rows


def _nation(spark, sf, key):
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias(key), "n_name", "n_regionkey")


def _region(spark, sf):
    return table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")


@query("fact_one_dimension", "J1", """
    SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def fact_one_dimension(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.lookup_join(table(spark, sf, "orders"), customer, "o_custkey").select(
        "o_orderkey", "c_name", "o_totalprice")


@query("skewed_lookup", "J1 J6", """
    SELECT l_returnflag, p_brand, count(*) AS row_count, CAST(sum(l_linenumber) AS BIGINT) AS lines
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def skewed_lookup(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    line = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_linenumber")
    joined = joins.lookup_join(line, part, "l_partkey", "left", skewed=True, small_rows=0)
    return joined.groupBy("l_returnflag", "p_brand").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_linenumber").alias("lines"))


@query("star_skewed", "J1 J3 J4 J5 J6 FT1", """
    SELECT l_orderkey, l_linenumber, p_brand, s_name, o_orderstatus, n_name FROM lineitem
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
    JOIN nation ON l_linenumber = n_nationkey""")
def star_skewed(spark, sf):
    """Four lookups, heavy keys of all of them salted at once; every line's number is a heavy key."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    kind = line.schema["l_linenumber"].dataType
    dims = [(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"),
            (table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey"),
            (table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey"),
            (table(spark, sf, "nation").select(F.col("n_nationkey").cast(kind).alias("l_linenumber"), "n_name"), "l_linenumber")]
    return joins.salted_star_join(line, dims).select("l_orderkey", "l_linenumber", "p_brand", "s_name", "o_orderstatus", "n_name")


@query("composite_key_join", "J2", """
    WITH dim AS (SELECT l_partkey, l_suppkey, min(l_linenumber) AS first_line FROM lineitem GROUP BY 1, 2)
    SELECT l.l_orderkey, l.l_linenumber, d.first_line FROM lineitem l
    JOIN dim d ON l.l_partkey = d.l_partkey AND l.l_suppkey = d.l_suppkey""")
def composite_key_join(spark, sf):
    line = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    dim = line.groupBy("l_partkey", "l_suppkey").agg(F.min("l_linenumber").alias("first_line"))
    return joins.lookup_join(line, dim, ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "first_line")


@query("star_filter_join", "J3 P16", """
    SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7'""")
def star_filter_join(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return joins.star_join(table(spark, sf, "orders"), [
        (customer, "o_custkey"), (_nation(spark, sf, "c_nationkey"), "c_nationkey")]).where(
        F.col("n_name") == "NATION_7").select("o_orderkey", "c_name", "n_name")


def _star(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    return joins.star_join(table(spark, sf, "lineitem"), [
        (part, "l_partkey"), (supplier, "l_suppkey"), (_nation(spark, sf, "s_nationkey"), "s_nationkey"),
        (_region(spark, sf), "n_regionkey")])


_STAR = """lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@query("star_four_filter", "J4 P16", f"""
    SELECT l_orderkey, l_linenumber, p_brand, s_name, n_name FROM {_STAR} WHERE r_name = 'ASIA'""")
def star_four_filter(spark, sf):
    return _star(spark, sf).where(F.col("r_name") == "ASIA").select(
        "l_orderkey", "l_linenumber", "p_brand", "s_name", "n_name")


@query("star_full_join", "J5", f"SELECT l_orderkey, l_linenumber, p_brand, s_name, n_name, r_name FROM {_STAR}")
def star_full_join(spark, sf):
    return _star(spark, sf).select("l_orderkey", "l_linenumber", "p_brand", "s_name", "n_name", "r_name")


@query("left_key_lookup", "J6", """
    SELECT c_custkey, coalesce(n_name, 'NONE') AS n_name FROM customer
    LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1) n ON c_nationkey = n_nationkey""")
def left_key_lookup(spark, sf):
    nation = _nation(spark, sf, "c_nationkey").where("n_regionkey = 1")
    return joins.lookup_join(table(spark, sf, "customer"), nation, "c_nationkey", "left").select(
        "c_custkey", F.coalesce("n_name", F.lit("NONE")).alias("n_name"))


@query("anti_new_members", "J7", """
    SELECT DISTINCT l_partkey, l_suppkey FROM lineitem l WHERE NOT EXISTS (
      SELECT 1 FROM lineitem o WHERE o.l_returnflag = 'R' AND o.l_partkey = l.l_partkey AND o.l_suppkey = l.l_suppkey)""")
def anti_new_members(spark, sf):
    line = table(spark, sf, "lineitem")
    pair = ["l_partkey", "l_suppkey"]
    return joins.missing_from(line.select(*pair).distinct(), line.where("l_returnflag = 'R'"), pair)


@query("anti_new_orders", "J8", """
    SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def anti_new_orders(spark, sf):
    loaded = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.missing_from(table(spark, sf, "orders"), loaded, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("anti_missing_count", "J9", """
    SELECT count(*) AS missing FROM orders WHERE NOT EXISTS (
      SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A')""")
def anti_missing_count(spark, sf):
    loaded = table(spark, sf, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    return ag.row_count(joins.missing_from(table(spark, sf, "orders"), loaded, ["o_orderkey"]), "missing")


@query("cross_targets", "J10 AU6 G5 O7", """
    SELECT load_month, target_table, source_count, source_count AS target_count
    FROM (SELECT strftime(o_orderdate, '%Y-%m') AS load_month, count(*) AS source_count FROM orders GROUP BY 1),
         (VALUES ('customer'), ('product'), ('fact')) t(target_table)""")
def cross_targets(spark, sf):
    staged = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("load_month"))
    return load_target_audit(staged, "load_month", {"customer": None, "product": None, "fact": None})


@query("upcoming_points", "W2 SC29 G6", """
    SELECT row_number() OVER (ORDER BY range) AS step, strftime((SELECT max(ts) FROM events) + range * INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS due
    FROM range(1, 9)""")
def upcoming_points_query(spark, sf):
    """The next eight quarters of an hour after the last event."""
    last = table(spark, sf, "events").agg(F.max("ts")).first()[0]
    return upcoming_points(F.lit(last).cast("timestamp_ntz"), 8, 15, spark).select(
        "step", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("due"))


@query("next_points", "J11 W2 W3 SC29", """
    SELECT user_id, step, strftime(last_ts + step * INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS due
    FROM (SELECT user_id, max(ts) AS last_ts FROM events GROUP BY 1), (SELECT CAST(range AS INTEGER) AS step FROM range(1, 6))""")
def next_points(spark, sf):
    last = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last_ts"))
    return schedule_points(last, "last_ts", 5).select("user_id", "step", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("due"))


@query("generated_months", "SC29 J6", """
    WITH months AS (SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS BIGINT) AS m FROM orders),
    span AS (SELECT min(m) AS low, max(m) AS high FROM months)
    SELECT month_no, count(m) AS row_count FROM (SELECT unnest(range(0, high - low + 1)) AS month_no, low FROM span)
    LEFT JOIN months ON m - low = month_no GROUP BY 1""")
def generated_months(spark, sf):
    """Months from the first order to the last, those without orders included."""
    orders = table(spark, sf, "orders").select((F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).alias("m"))
    low, high = orders.agg(F.min("m"), F.max("m")).first()
    count = 0 if low is None else high - low + 1
    counts = ag.count_by(orders, (F.col("m") - F.lit(low)).cast("bigint").alias("month_no"))
    return lit_rows.generate(spark, count, "month_no").join(counts, "month_no", "left").select(
        "month_no", F.coalesce("row_count", F.lit(0)).alias("row_count"))


@query("row_count", "G1", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf):
    return ag.row_count(table(spark, sf, "lineitem"))


@query("group_summary", "G2", """
    SELECT c_mktsegment, count(*) AS row_count, CAST(sum(CAST(c_acctbal AS DECIMAL(14,2))) AS DOUBLE) AS total,
           CAST(sum(CAST(c_acctbal AS DECIMAL(14,2))) AS DOUBLE) / count(*) AS average,
           min(c_acctbal) AS lowest, max(c_acctbal) AS highest FROM customer GROUP BY 1""")
def group_summary(spark, sf):
    out = ag.group_summary(table(spark, sf, "customer"), ["c_mktsegment"], money("c_acctbal"))
    return out.select("c_mktsegment", "row_count", dbl("total").alias("total"),
                      (dbl("total") / F.col("row_count")).alias("average"), dbl("lowest").alias("lowest"),
                      dbl("highest").alias("highest"))


@query("line_summary", "G2", """
    SELECT l_returnflag, l_linestatus, count(*) AS row_count, CAST(sum(CAST(l_quantity AS DECIMAL(14,2))) AS DOUBLE) AS total,
           min(l_quantity) AS lowest, max(l_quantity) AS highest FROM lineitem GROUP BY 1, 2""")
def line_summary(spark, sf):
    out = ag.group_summary(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], money("l_quantity"))
    return out.select("l_returnflag", "l_linestatus", "row_count", *[dbl(c).alias(c) for c in ("total", "lowest", "highest")])


@query("star_count", "G3", """
    SELECT r_name, n_name, count(c_custkey) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def star_count(spark, sf):
    return joins.star_join(table(spark, sf, "customer"), [
        (_nation(spark, sf, "c_nationkey"), "c_nationkey"), (_region(spark, sf), "n_regionkey")]).groupBy(
        "r_name", "n_name").agg(F.count("c_custkey").alias("customers"))


@query("flag_counts", "G4 O1", "SELECT o_orderstatus, count(*) AS row_count FROM orders GROUP BY 1 ORDER BY 1")
def flag_counts(spark, sf):
    return ag.count_by(table(spark, sf, "orders"), "o_orderstatus").orderBy("o_orderstatus")


@query("load_counts", "G5", """
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS load_day, count(*) AS row_count FROM lineitem GROUP BY 1""")
def load_counts(spark, sf):
    return ag.count_by(table(spark, sf, "lineitem"), day("l_shipdate").alias("load_day"))


@query("latest_time", "G6", "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_time FROM events")
def latest_time(spark, sf):
    return table(spark, sf, "events").agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last_time"))


@query("next_id", "G7 F11", "SELECT coalesce(max(o_orderkey), 0) + 1 AS next_id FROM orders")
def next_id(spark, sf):
    return keys.next_id(table(spark, sf, "orders"), "o_orderkey")


@query("distinct_members", "G8", "SELECT DISTINCT event_type, user_id FROM events")
def distinct_members(spark, sf):
    return table(spark, sf, "events").select("event_type", "user_id").distinct()


@query("distinct_values", "G9", "SELECT DISTINCT p_type FROM part")
def distinct_values(spark, sf):
    return table(spark, sf, "part").select("p_type").distinct()


@query("copies_per_row", "G10", """
    SELECT lang, source, md5(text) AS text_key, count(*) AS occurrences FROM documents GROUP BY lang, source, text""")
def copies_per_row(spark, sf):
    return ag.count_by(table(spark, sf, "documents"), "lang", "source", "text", name="occurrences").select(
        "lang", "source", F.md5("text").alias("text_key"), "occurrences")


@query("tolerant_sum", "G11", """
    SELECT CAST(coalesce(sum(TRY_CAST(split_part(p_name, ' ', 1) AS DOUBLE)), 0) AS DOUBLE) AS from_words,
           CAST(sum(TRY_CAST(substr(p_brand, 7) AS DOUBLE)) AS DOUBLE) AS from_brand FROM part""")
def tolerant_sum(spark, sf):
    part = table(spark, sf, "part")
    words = ag.tolerant_sum(part, F.split("p_name", " ")[0], "from_words")
    brand = ag.tolerant_sum(part, F.substring("p_brand", 7, 20), "from_brand")
    return ag.union_blocks(words, brand).agg(
        F.sum("from_words").alias("from_words"), F.sum("from_brand").alias("from_brand"))


@query("sort_many", "O2 O3", """
    SELECT l_shipdate, l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_shipdate DESC, l_orderkey, l_linenumber""")
def sort_many(spark, sf):
    return table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity").orderBy(
        F.col("l_shipdate").desc(), "l_orderkey", "l_linenumber")


@query("top_n", "O4", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_n(spark, sf):
    return ag.top_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 20,
                    F.col("o_totalprice").desc(), F.col("o_orderkey"))


@query("latest_row", "O5 P15", """
    SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""")
def latest_row(spark, sf):
    events = table(spark, sf, "events").select("ts", "event_id", "user_id", "event_type")
    return ag.latest_row(events, ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("latest_per_key", "O5", """
    SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_per_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return ag.latest_row(events, ["ts", "event_id"], ["user_id"]).select("user_id", "event_id", "event_type")


@query("union_blocks", "O6 O8", """
    SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""")
def union_blocks(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    supplier = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return ag.union_blocks(customer, supplier)


@query("chained_steps", "O9 O10", """
    WITH a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT n, count(*) AS customers FROM a GROUP BY 1)
    SELECT n, customers FROM b ORDER BY n DESC LIMIT 10""")
def chained_steps(spark, sf):
    per_customer = ag.count_by(table(spark, sf, "orders"), "o_custkey", name="n")
    sizes = ag.count_by(per_customer, "n", name="customers")
    return ag.top_n(sizes, 10, F.col("n").desc())


@query("literal_tuples", "SC25 O7", """
    SELECT o_orderkey, rank FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3)) r(p, rank)
    ON o_orderpriority = p""")
def literal_tuples(spark, sf):
    ranks = lit_rows.from_tuples(spark, [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)], "o_orderpriority string, rank int")
    return joins.lookup_join(table(spark, sf, "orders"), ranks, "o_orderpriority").select("o_orderkey", "rank")


@query("literal_dicts", "SC26 SC27 P4", """
    SELECT o_orderstatus, label, phase, count(*) AS row_count FROM orders
    JOIN (VALUES ('F', 'finished', 2), ('O', 'open', 1)) r(s, label, phase) ON o_orderstatus = s GROUP BY 1, 2, 3""")
def literal_dicts(spark, sf):
    labels = lit_rows.from_dicts(
        spark, [{"o_orderstatus": "F", "info": {"label": "finished", "phase": 2}},
                {"o_orderstatus": "O", "info": {"label": "open", "phase": 1}}],
        "o_orderstatus string, info struct<label: string, phase: int>")
    flat = labels.select("o_orderstatus", "info.label", "info.phase")
    counts = ag.count_by(table(spark, sf, "orders"), "o_orderstatus")
    return counts.join(flat, "o_orderstatus").select("o_orderstatus", "label", "phase", "row_count")


@query("literal_rows_appended", "SC28 SK20", """
    SELECT c_mktsegment AS segment, count(*) AS row_count FROM (SELECT c_mktsegment FROM customer
      UNION ALL SELECT * FROM (VALUES ('FURNITURE'), ('GARDEN'))) GROUP BY 1""")
def literal_rows_appended(spark, sf):
    base = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"))
    more = lit_rows.from_tuples(spark, [("FURNITURE",), ("GARDEN",)], "segment string")
    return ag.count_by(base.unionByName(more), "segment")


@query("table_counts", "AU13 O6", """
    SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def table_counts(spark, sf):
    return ag.table_counts({n: table(spark, sf, n) for n in ("customer", "orders", "lineitem")})
