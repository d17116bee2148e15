"""Keys, dimensions, facts, duplicate reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from pipekit.operators import dims, keys, quality
from pipekit.operators.joins import missing_from
from pipekit.plans import jobs
from pipekit.operators.zones import ZoneMap
from pipekit.plans.catalog.registry import dbl, money, query, table
from pipekit.session import durable, scratch
from pipekit.sinks.writers import write_counted
from pipekit.sources.provenance import inventory


@query("coded_keys", "KY3 W1 G9 F4", """
    SELECT 'B' || CASE WHEN rn < 10 THEN '0' ELSE '' END || rn AS code, p_brand
    FROM (SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS rn FROM (SELECT DISTINCT p_brand FROM part))""")
def coded_keys(spark, sf):
    return keys.coded_keys(table(spark, sf, "part"), "p_brand", "B")


@query("dense_keys", "KY1 KY2", """
    SELECT row_number() OVER (ORDER BY c_name) AS customer_key, c_name FROM (SELECT DISTINCT c_name FROM customer)""")
def dense_keys(spark, sf):
    members = table(spark, sf, "customer").select("c_name").distinct()
    return keys.dense_keys(members, ["c_name"], "customer_key")


@query("dense_keys_large", "KY2 W1", """
    SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey,
           l_suppkey, l_extendedprice) AS line_key FROM lineitem""")
def dense_keys_large(spark, sf):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return keys.dense_keys(table(spark, sf, "lineitem").select(*order), order, "line_key").select(
        "l_orderkey", "l_linenumber", "line_key")


@query("keys_after_existing", "KY1 G7 DM2", """
    WITH old AS (SELECT p_type, row_number() OVER (ORDER BY p_type) AS type_key
                 FROM (SELECT DISTINCT p_type FROM part WHERE p_size < 2 AND p_type < 'M')),
    fresh AS (SELECT DISTINCT p_type FROM part WHERE p_type NOT IN (SELECT p_type FROM old))
    SELECT (SELECT coalesce(max(type_key), 0) FROM old) + row_number() OVER (ORDER BY p_type) AS type_key, p_type FROM fresh""")
def keys_after_existing(spark, sf):
    part = table(spark, sf, "part")
    old = dims.load_dimension(part.where("p_size < 2 and p_type < 'M'"), ["p_type"], "type_key")
    return dims.load_dimension(part, ["p_type"], "type_key", old)


@query("dimension_distinct_append", "DM1", """
    SELECT row_number() OVER (ORDER BY event_type, user_id) AS member_key, event_type, user_id
    FROM (SELECT DISTINCT event_type, user_id FROM events)""")
def dimension_distinct_append(spark, sf):
    return dims.load_dimension(table(spark, sf, "events"), ["event_type", "user_id"], "member_key", only_new=False)


@query("dimension_new_members", "DM2 J7", """
    WITH old AS (SELECT DISTINCT event_type, user_id FROM events WHERE ts < TIMESTAMP '2024-01-10')
    SELECT (SELECT count(*) FROM old) + row_number() OVER (ORDER BY event_type, user_id) AS member_key, event_type, user_id
    FROM (SELECT DISTINCT event_type, user_id FROM events EXCEPT SELECT * FROM old)""")
def dimension_new_members(spark, sf):
    events = table(spark, sf, "events")
    pair = ["event_type", "user_id"]
    old = dims.load_dimension(events.where("ts < timestamp_ntz'2024-01-10'"), pair, "member_key")
    return dims.load_dimension(events, pair, "member_key", old)


_SPECS = [dims.DimensionSpec("nation", "nation", "nation_code", "N"),
          dims.DimensionSpec("region", "region", "region_code", "R"),
          dims.DimensionSpec("segment", "segment", "segment_code", "S")]

_FLAT = """flat AS (SELECT c_custkey AS customer_id, n_name AS nation, r_name AS region, c_mktsegment AS segment
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""


def _ranked(column, prefix):
    return (f"SELECT '{prefix}' || lpad(CAST(row_number() OVER (ORDER BY {column}) AS VARCHAR), 2, '0') AS code, "
            f"{column} FROM (SELECT DISTINCT {column} FROM flat WHERE {column} IS NOT NULL)")


def _flat(spark, sf):
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    return table(spark, sf, "customer").join(nation, "c_nationkey", "left").select(
        F.col("c_custkey").alias("customer_id"), "nation", "region", F.col("c_mktsegment").alias("segment"))


@query("dims_from_flat", "DM3 FT4", f"""
    WITH {_FLAT} SELECT 'nation' AS dimension, code, nation AS member FROM ({_ranked('nation', 'N')})
    UNION ALL SELECT 'region', code, region FROM ({_ranked('region', 'R')})
    UNION ALL SELECT 'segment', code, segment FROM ({_ranked('segment', 'S')})""")
def dims_from_flat(spark, sf):
    out = dims.dimensions_from_flat(_flat(spark, sf), _SPECS)
    parts = [out[s.name].select(F.lit(s.name).alias("dimension"), F.col(s.code).alias("code"),
                                F.col(s.column).alias("member")) for s in _SPECS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("fact_from_flat", "FT3 FT4 J6 SP5", f"""
    WITH {_FLAT} SELECT customer_id, n.code AS nation_code, r.code AS region_code, s.code AS segment_code FROM flat f
    LEFT JOIN ({_ranked('nation', 'N')}) n ON f.nation = n.nation
    LEFT JOIN ({_ranked('region', 'R')}) r ON f.region = r.region
    LEFT JOIN ({_ranked('segment', 'S')}) s ON f.segment = s.segment""")
def fact_from_flat(spark, sf):
    flat = _flat(spark, sf)
    return dims.fact_from_flat(flat, dims.dimensions_from_flat(flat, _SPECS), _SPECS, ["customer_id"])


@query("fact_one_key", "FT1 J1 P5", """
    WITH dim AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS part_key FROM (SELECT DISTINCT p_partkey FROM part))
    SELECT l_orderkey, l_linenumber, part_key,
           CAST(CAST(l_quantity AS DECIMAL(14,2)) * CAST(l_extendedprice AS DECIMAL(14,2)) AS DOUBLE) AS amount
    FROM lineitem JOIN dim ON l_partkey = p_partkey""")
def fact_one_key(spark, sf):
    staged = table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    dim = dims.load_dimension(table(spark, sf, "part"), ["p_partkey"], "part_key")
    return dims.load_fact(staged, [(dim, ["p_partkey"])], {
        "l_orderkey": F.col("l_orderkey"), "l_linenumber": F.col("l_linenumber"), "part_key": F.col("part_key"),
        "amount": dbl(money("l_quantity") * money("l_extendedprice"))}, check=False)


_DIMS = {"customers": ("customer_key", ["customer_name", "nation"]), "priorities": ("priority_key", ["priority"])}
_MEASURES = {"amount": "amount"}


def _sales(spark, sf, nation="nation", priority="o_orderpriority"):
    """Flat sales; ``nation`` and ``priority`` are expressions over customers with nations, and orders."""
    countries = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    customer = table(spark, sf, "customer").join(countries, "c_nationkey").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("customer_name"), F.expr(nation).alias("nation"))
    return table(spark, sf, "orders").join(customer, "o_custkey").select(
        F.col("o_orderkey").alias("order_id"), "customer_name", "nation", F.expr(priority).alias("priority"),
        F.col("o_totalprice").alias("amount"), "o_orderdate")


_STAR_SQL = """
    sales AS (SELECT o_orderkey AS order_id, c_name AS customer_name, n_name AS nation, o_orderpriority AS priority,
              o_totalprice AS amount, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey),
    first AS (SELECT * FROM sales WHERE o_orderdate < TIMESTAMP '1998-07-01'),
    c1 AS (SELECT customer_name, nation, row_number() OVER (ORDER BY customer_name, nation) AS customer_key
           FROM (SELECT DISTINCT customer_name, nation FROM first)),
    c2 AS (SELECT * FROM c1 UNION ALL SELECT customer_name, nation, (SELECT count(*) FROM c1) +
           row_number() OVER (ORDER BY customer_name, nation) FROM (SELECT DISTINCT customer_name, nation FROM sales
           EXCEPT SELECT customer_name, nation FROM c1)),
    p AS (SELECT priority, row_number() OVER (ORDER BY priority) AS priority_key FROM (SELECT DISTINCT priority FROM sales))"""


@query("fact_idempotent", "FT2 DM2 J2 J8 SP4 PL8", f"""
    WITH {_STAR_SQL}
    SELECT order_id, customer_key, priority_key, amount FROM sales s
    JOIN c2 ON s.customer_name = c2.customer_name AND s.nation = c2.nation JOIN p ON s.priority = p.priority""")
def fact_idempotent(spark, sf):
    """Two overlapping batches of orders into a star; the second adds only what is new."""
    sales = _sales(spark, sf)
    first = jobs.load_star(sales.where("o_orderdate < timestamp_ntz'1998-07-01'"), _DIMS, ["order_id"], _MEASURES, cut=True)
    second = sales.where("o_orderdate >= timestamp_ntz'1998-01-01'")
    return jobs.load_star(second, _DIMS, ["order_id"], _MEASURES, first, cut=True)["fact"]


@query("fact_idempotent_pruned", "FT2 J8 DM2 SP4 PL8", """
    SELECT count(*) AS row_count, count(DISTINCT o_orderkey) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS amount,
           true AS some_files_unread, CAST(0 AS BIGINT) AS added_again FROM orders""")
def fact_idempotent_pruned(spark, sf):
    """Orders arrive by key range, the second batch overlaps the end of the first; only files that can hold a staged key
    are read to leave out what is there."""
    sales = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount"))
    cut = sales.agg(F.percentile_approx("order_id", [0.8, 0.9])).first()[0]
    root = scratch(spark, "zones")
    held = ZoneMap(spark, f"{root}/fact", f"{root}/zones", "order_id")
    touched, added = [], []
    for batch in (f"order_id <= {cut[1]}", f"order_id > {cut[0]}", f"order_id > {cut[0]}"):
        staged = sales.where(batch)
        held.refresh()
        touched.append(len(held.files_for(staged)) if added else 0)
        fresh = held.missing(staged, ["order_id"]).repartitionByRange(8, "order_id")
        added.append(write_counted(fresh, held.folder, "append"))
    held.refresh()
    files = inventory(spark, held.folder, "*.parquet").count()
    return spark.read.parquet(held.folder).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("order_id").alias("orders"), dbl(F.sum(money("amount"))).alias("amount"),
    ).withColumn("some_files_unread", F.lit(0 < touched[1] < files)).withColumn("added_again", F.lit(added[2]).cast("bigint"))


@query("star_dimension_keys", "DM2 KY1 PL8", f"""
    WITH {_STAR_SQL} SELECT customer_key, customer_name, nation FROM c2""")
def star_dimension_keys(spark, sf):
    sales = _sales(spark, sf)
    first = jobs.load_star(sales.where("o_orderdate < timestamp_ntz'1998-07-01'"), _DIMS, ["order_id"], _MEASURES, cut=True)
    second = sales.where("o_orderdate >= timestamp_ntz'1998-01-01'")
    return jobs.load_star(second, _DIMS, ["order_id"], _MEASURES, first, cut=True)["customers"]


@query("star_load", "PL7 SP1 DM1 FT1", """
    WITH c AS (SELECT customer_name, nation, row_number() OVER (ORDER BY customer_name, nation) AS customer_key FROM (
           SELECT DISTINCT c_name AS customer_name, n_name AS nation FROM orders JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey)),
    p AS (SELECT priority, row_number() OVER (ORDER BY priority) AS priority_key FROM (SELECT DISTINCT o_orderpriority AS priority FROM orders))
    SELECT o_orderkey AS order_id, customer_key, priority_key, o_totalprice AS amount
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN c ON c.customer_name = c_name AND c.nation = n_name JOIN p ON priority = o_orderpriority""")
def star_load(spark, sf):
    return jobs.load_star(_sales(spark, sf), _DIMS, ["order_id"], _MEASURES, cut=True)["fact"]


@query("fact_null_member", "FT2 DM2 J2 SP4 PL8", """
    WITH s AS (SELECT o_orderkey AS order_id, c_name AS customer_name, CASE WHEN c_nationkey % 4 > 0 THEN n_name END AS nation,
               CASE WHEN o_custkey % 3 > 0 THEN o_orderpriority END AS priority, o_totalprice AS amount
               FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    c AS (SELECT customer_name, nation, row_number() OVER (ORDER BY customer_name, nation NULLS FIRST) AS customer_key
          FROM (SELECT DISTINCT customer_name, nation FROM s)),
    p AS (SELECT priority, row_number() OVER (ORDER BY priority NULLS FIRST) AS priority_key FROM (SELECT DISTINCT priority FROM s))
    SELECT 'safe' AS mode, order_id, customer_key, priority_key, amount FROM s
    JOIN c ON s.customer_name = c.customer_name AND s.nation IS NOT DISTINCT FROM c.nation
    JOIN p ON s.priority IS NOT DISTINCT FROM p.priority
    UNION ALL SELECT 'plain', order_id, customer_key, priority_key, amount FROM s
    JOIN c ON s.customer_name = c.customer_name AND s.nation = c.nation JOIN p ON s.priority = p.priority""")
def fact_null_member(spark, sf):
    """Orders with NULL dimension values: looked up NULL-safely, all arrive; by plain equality, these find no member."""
    sales = durable(_sales(spark, sf, "if(c_nationkey % 4 > 0, nation, NULL)", "if(o_custkey % 3 > 0, o_orderpriority, NULL)"),
                    "staged")
    facts = [jobs.load_star(sales, _DIMS, ["order_id"], _MEASURES, null_safe=safe)["fact"].withColumn("mode", F.lit(mode))
             for mode, safe in (("safe", True), ("plain", False))]
    return facts[0].unionByName(facts[1]).select("mode", "order_id", "customer_key", "priority_key", "amount")


@query("null_safe_members", "DM2 J7", """
    WITH m AS (SELECT DISTINCT p_type, CASE WHEN p_size > 25 THEN p_brand END AS brand FROM part),
         old AS (SELECT DISTINCT p_type, CASE WHEN p_size > 25 THEN p_brand END AS brand FROM part WHERE p_retailprice < 950)
    SELECT p_type, coalesce(brand, '-') AS brand FROM (SELECT * FROM m EXCEPT SELECT * FROM old)""")
def null_safe_members(spark, sf):
    part = table(spark, sf, "part").select(
        "p_type", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("brand"), "p_retailprice")
    old = part.where("p_retailprice < 950")
    return dims.new_members(part, old, ["p_type", "brand"], null_safe=True).select(
        "p_type", F.coalesce("brand", F.lit("-")).alias("brand"))


@query("plain_new_members", "J7", """
    WITH m AS (SELECT DISTINCT p_type, CASE WHEN p_size > 25 THEN p_brand END AS brand FROM part)
    SELECT p_type, coalesce(brand, '-') AS brand FROM m WHERE NOT EXISTS (
      SELECT 1 FROM m o WHERE o.p_type = m.p_type AND o.brand = m.brand)""")
def plain_new_members(spark, sf):
    """SQL equality: a member with a NULL column is never found, so it stays new."""
    members = table(spark, sf, "part").select(
        "p_type", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("brand")).distinct()
    return missing_from(members, members, ["p_type", "brand"]).select(
        "p_type", F.coalesce("brand", F.lit("-")).alias("brand"))


def _docs_report(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return quality.duplicate_report(docs, ["text", "lang", "source", "n_chars"], ["doc_id"], "n_chars")


def _docs_report_split(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return quality.DuplicateReport(docs, ["text", "lang", "source", "n_chars"], ["doc_id"], small_rows=0)


@query("dup_report_clean", "AU10 W4 G10", """
    SELECT min(doc_id) AS doc_id, lang, source, count(*) AS occurrences, md5(text) AS text_key
    FROM documents GROUP BY text, lang, source, n_chars""")
def dup_report_clean(spark, sf):
    return _docs_report(spark, sf).clean.select("doc_id", "lang", "source", "occurrences", F.md5("text").alias("text_key"))


@query("dup_report_dups", "AU10 W4 G10", """
    SELECT doc_id, occurrences, text_key FROM (
      SELECT doc_id, md5(text) AS text_key, count(*) OVER (PARTITION BY text, lang, source, n_chars) AS occurrences,
             row_number() OVER (PARTITION BY text, lang, source, n_chars ORDER BY doc_id) AS rn FROM documents) WHERE rn > 1""")
def dup_report_dups(spark, sf):
    return _docs_report(spark, sf).duplicates.select("doc_id", "occurrences", F.md5("text").alias("text_key"))


@query("dup_report_totals", "AU10 G11 PL12", """
    SELECT count(*) AS clean_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, CAST(sum(n_chars) AS DOUBLE) AS measure_total
    FROM (SELECT text, lang, source, n_chars, count(*) AS n FROM documents GROUP BY 1, 2, 3, 4)""")
def dup_report_totals(spark, sf):
    return _docs_report(spark, sf).summary


@query("dup_report_clean_split", "AU10 W4", """
    SELECT min(doc_id) AS doc_id, count(*) AS occurrences FROM documents GROUP BY text, lang, source, n_chars""")
def dup_report_clean_split(spark, sf):
    """The way taken when the sets with copies are too many to broadcast."""
    return _docs_report_split(spark, sf).clean.select("doc_id", "occurrences")


@query("dup_report_hot", "AU10 W4", """
    SELECT event_id, occurrences FROM (
      SELECT event_id, count(*) OVER (PARTITION BY event_type, user_id) AS occurrences,
             row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS rn FROM events) WHERE rn > 1""")
def dup_report_hot(spark, sf):
    """Few large sets of copies: the heavy ones are met by broadcast, not shuffled."""
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    report = quality.DuplicateReport(events, ["event_type", "user_id"], ["event_id"], small_rows=0)
    return report.duplicates.select("event_id", "occurrences")
