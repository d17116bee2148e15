"""Upsert, update, delete, history and change feeds over changes derived from customer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pipekit.operators import changes as ch
from pipekit.operators import history as hs
from pipekit.operators import merge
from pipekit.plans.catalog.registry import query, table
from pipekit.session import scratch
from pipekit.sinks.bucketed import BucketedTable

FIRST, SECOND = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal")


def _base(spark, sf):
    """Yesterday: all customers outside nation 3."""
    return _customers(spark, sf).where("c_nationkey <> 3")


def _delta(spark, sf):
    """Today's arrivals: overdrawn customers go to segment REVIEW, nation 3 is new."""
    return _customers(spark, sf).where("c_nationkey = 3 or c_acctbal < 0").withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") < 0, F.lit("REVIEW")).otherwise(F.col("c_mktsegment")))


_BASE = "SELECT c_custkey, c_name, c_mktsegment, c_nationkey, c_acctbal FROM customer WHERE c_nationkey <> 3"
_DELTA = """SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment,
            c_nationkey, c_acctbal FROM customer WHERE c_nationkey = 3 OR c_acctbal < 0"""
_UPSERT = f"""
    WITH t AS ({_BASE}), s AS ({_DELTA})
    SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name,
           coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal,
           CASE WHEN s.c_custkey IS NULL THEN '2024-01-01' ELSE '2024-06-01' END AS updated_date
    FROM t FULL JOIN s ON t.c_custkey = s.c_custkey"""


def _upserted(spark, sf, **options):
    target = _base(spark, sf).withColumn("updated_date", F.lit("2024-01-01"))
    out = merge.upsert(target, _delta(spark, sf), ["c_custkey"], {"updated_date": F.lit("2024-06-01")}, **options)
    return out.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "updated_date")


@query("upsert", "UP1 J12 H5 PL4", _UPSERT)
def upsert(spark, sf):
    return _upserted(spark, sf)


@query("upsert_large_source", "UP1 J12", _UPSERT)
def upsert_large_source(spark, sf):
    """The way taken when the source is too large to broadcast."""
    return _upserted(spark, sf, small_rows=0)


@query("upsert_bucketed", "UP1 J12 CD7 PL4", f"""
    SELECT * FROM ({_UPSERT}) UNION ALL
    SELECT NULL, c_name, 'NO KEY', c_acctbal, '2024-01-01' FROM customer WHERE c_nationkey <> 3 AND c_custkey % 3 = 0 UNION ALL
    SELECT NULL, c_name, 'NEW', c_acctbal, '2024-06-01' FROM customer WHERE c_nationkey = 3""")
def upsert_bucketed(spark, sf):
    """A target that lies bucketed by key, a third of its rows without one; the merge does not shuffle it."""
    target = _base(spark, sf).withColumn("updated_date", F.lit("2024-01-01"))
    keyless = target.where("c_custkey % 3 = 0").withColumns(
        {"c_custkey": F.lit(None).cast(target.schema["c_custkey"].dataType), "c_mktsegment": F.lit("NO KEY")})
    root = scratch(spark, "bucketed")
    held = BucketedTable(spark, "merged_" + root.rsplit("-", 1)[-1], root, ["c_custkey"], buckets=8)
    held.save(target.unionByName(keyless))
    delta = _delta(spark, sf)
    new = delta.where("c_nationkey = 3").withColumns(
        {"c_custkey": F.lit(None).cast(target.schema["c_custkey"].dataType), "c_mktsegment": F.lit("NEW")})
    held.upsert(delta.unionByName(new), {"updated_date": F.lit("2024-06-01")})
    return held.read().select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "updated_date")


@query("update_rows", "UP2", """
    SELECT s_suppkey, CASE WHEN s_nationkey = 5 THEN 90000.0 ELSE s_acctbal END AS s_acctbal FROM supplier""")
def update_rows(spark, sf):
    out = merge.update_rows(table(spark, sf, "supplier"), F.col("s_nationkey") == 5, {"s_acctbal": F.lit(90000.0)})
    return out.select("s_suppkey", "s_acctbal")


@query("delete_rows", "UP3", "SELECT s_suppkey, s_name FROM supplier WHERE NOT s_nationkey = 5")
def delete_rows(spark, sf):
    return merge.delete_rows(table(spark, sf, "supplier"), F.col("s_nationkey") == 5).select("s_suppkey", "s_name")


_HISTORY = f"""
    WITH t AS ({_BASE}), s AS ({_DELTA}),
    changed AS (SELECT s.c_custkey FROM s JOIN t ON s.c_custkey = t.c_custkey WHERE s.c_mktsegment <> t.c_mktsegment),
    h AS (SELECT c_custkey, c_mktsegment, '2024-01-01 00:00:00' AS valid_from,
            CASE WHEN c_custkey IN (SELECT c_custkey FROM changed) THEN '2024-06-01 00:00:00' ELSE '9999-12-31 23:59:59' END AS valid_to,
            c_custkey NOT IN (SELECT c_custkey FROM changed) AS is_current FROM t
          UNION ALL SELECT c_custkey, c_mktsegment, '2024-06-01 00:00:00', '9999-12-31 23:59:59', true FROM s
            WHERE c_custkey IN (SELECT c_custkey FROM changed) OR c_custkey NOT IN (SELECT c_custkey FROM t))"""


def _history(spark, sf):
    return hs.scd2_apply(hs.scd2_initial(_base(spark, sf), FIRST), _delta(spark, sf), ["c_custkey"], SECOND)


def _shown(df):
    fmt = "yyyy-MM-dd HH:mm:ss"
    return df.select("c_custkey", "c_mktsegment", F.date_format("valid_from", fmt).alias("valid_from"),
                     F.date_format("valid_to", fmt).alias("valid_to"), "is_current")


@query("scd2_initial", "H1", """
    SELECT c_custkey, c_mktsegment, '2024-01-01 00:00:00' AS valid_from, '9999-12-31 23:59:59' AS valid_to,
           true AS is_current FROM customer""")
def scd2_initial(spark, sf):
    return _shown(hs.scd2_initial(_customers(spark, sf), FIRST))


@query("scd2_expire_and_add", "H2 H3", """
    SELECT c_custkey, c_mktsegment, '2024-01-01 00:00:00' AS valid_from,
           CASE WHEN c_nationkey = 4 THEN '2024-06-01 00:00:00' ELSE '9999-12-31 23:59:59' END AS valid_to,
           c_nationkey <> 4 AS is_current FROM customer
    UNION ALL SELECT c_custkey, 'MOVED', '2024-06-01 00:00:00', '9999-12-31 23:59:59', true FROM customer WHERE c_nationkey = 4""")
def scd2_expire_and_add(spark, sf):
    history = hs.scd2_initial(_customers(spark, sf), FIRST)
    moved = _customers(spark, sf).where("c_nationkey = 4").withColumn("c_mktsegment", F.lit("MOVED"))
    return _shown(hs.scd2_add(hs.scd2_expire(history, F.col("c_nationkey") == 4, SECOND), moved, SECOND))


@query("scd2_apply", "H4 H2 H3 PL6", _HISTORY + " SELECT * FROM h")
def scd2_apply(spark, sf):
    return _shown(_history(spark, sf))


@query("scd2_current", "H6 P13", _HISTORY + " SELECT * FROM h WHERE is_current")
def scd2_current(spark, sf):
    return _shown(hs.current_rows(_history(spark, sf)))


@query("scd2_as_of", "H6", _HISTORY + " SELECT c_custkey, c_mktsegment FROM h WHERE valid_from <= '2024-03-01' AND valid_to > '2024-03-01'")
def scd2_as_of(spark, sf):
    return hs.rows_as_of(_history(spark, sf), dt.datetime(2024, 3, 1)).select("c_custkey", "c_mktsegment")


@query("scd2_key_history", "H6 O1", _HISTORY + " SELECT * FROM h WHERE c_mktsegment = 'REVIEW' ORDER BY valid_from")
def scd2_key_history(spark, sf):
    return _shown(hs.key_history(_history(spark, sf), F.col("c_mktsegment") == "REVIEW"))


@query("scd1_apply", "H5 UP1", f"""
    WITH t AS ({_BASE}), s AS ({_DELTA})
    SELECT c_custkey, c_mktsegment FROM s UNION ALL
    SELECT c_custkey, c_mktsegment FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM s)""")
def scd1_apply(spark, sf):
    return hs.scd1_apply(_base(spark, sf), _delta(spark, sf), ["c_custkey"]).select("c_custkey", "c_mktsegment")


def _after(spark, sf):
    """Next snapshot: the delta applied and nation 8 gone."""
    target = merge.upsert(_base(spark, sf), _delta(spark, sf), ["c_custkey"], check=False)
    return merge.delete_rows(target, F.col("c_nationkey") == 8)


_DIFF = f"""
    WITH b AS ({_BASE}), s AS ({_DELTA}),
    a AS (SELECT * FROM (SELECT * FROM s UNION ALL SELECT * FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM s))
          WHERE c_nationkey <> 8),
    d AS (SELECT a.c_custkey, a.c_mktsegment, 'INSERT' AS change_action, false AS is_update FROM a ANTI JOIN b ON a.c_custkey = b.c_custkey
      UNION ALL SELECT b.c_custkey, b.c_mktsegment, 'DELETE', false FROM b ANTI JOIN a ON a.c_custkey = b.c_custkey
      UNION ALL SELECT b.c_custkey, b.c_mktsegment, 'DELETE', true FROM a JOIN b ON a.c_custkey = b.c_custkey WHERE a.c_mktsegment <> b.c_mktsegment
      UNION ALL SELECT a.c_custkey, a.c_mktsegment, 'INSERT', true FROM a JOIN b ON a.c_custkey = b.c_custkey WHERE a.c_mktsegment <> b.c_mktsegment)"""


@query("diff_changes", "CD1 CD2 CD3 CD4", _DIFF + " SELECT * FROM d")
def diff_changes(spark, sf):
    return ch.diff_snapshots(_base(spark, sf), _after(spark, sf), ["c_custkey"]).select(
        "c_custkey", "c_mktsegment", "change_action", "is_update")


@query("diff_by_digest", "CD1 CD2 CD3 CD4", _DIFF + " SELECT * FROM d")
def diff_by_digest(spark, sf):
    """The same changes, found by digests of key buckets."""
    return ch.diff_by_digest(_base(spark, sf), _after(spark, sf), ["c_custkey"], leaf_rows=16).select(
        "c_custkey", "c_mktsegment", "change_action", "is_update")


@query("change_row_ids", "CD8", _DIFF + """
    SELECT count(*) AS changes, count(DISTINCT c_custkey) AS row_ids, 64 AS id_length FROM d""")
def change_row_ids(spark, sf):
    diff = ch.diff_snapshots(_base(spark, sf), _after(spark, sf), ["c_custkey"])
    return diff.agg(F.count(F.lit(1)).alias("changes"), F.count_distinct("row_id").alias("row_ids"),
                    F.max(F.length("row_id")).alias("id_length"))


@query("apply_changes", "CD7 UP3", _DIFF + " SELECT c_custkey, c_mktsegment, c_acctbal FROM a")
def apply_changes(spark, sf):
    base = _base(spark, sf)
    diff = ch.diff_snapshots(base, _after(spark, sf), ["c_custkey"])
    return ch.apply_changes(base, diff, ["c_custkey"]).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("apply_large_feed", "CD7 UP3", _DIFF + " SELECT c_custkey, c_mktsegment, c_acctbal FROM a")
def apply_large_feed(spark, sf):
    """The way taken when the feed is too large to broadcast."""
    base = _base(spark, sf)
    diff = ch.diff_snapshots(base, _after(spark, sf), ["c_custkey"])
    return ch.apply_changes(base, diff, ["c_custkey"], small_rows=0).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("net_changes", "CD7", _DIFF + """
    SELECT c_custkey, max(CASE WHEN change_action = 'INSERT' THEN 'INSERT' ELSE 'DELETE' END) AS change_action FROM d GROUP BY 1""")
def net_changes(spark, sf):
    diff = ch.diff_snapshots(_base(spark, sf), _after(spark, sf), ["c_custkey"])
    return ch.net_changes(diff, ["c_custkey"]).select("c_custkey", "change_action")
