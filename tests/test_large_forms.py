"""Forms for large or skewed inputs against the plain ones, and what their plans read and move."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pipekit.operators import audit, changes, dims, history, joins, merge
from pipekit.sinks.bucketed import BucketedTable
from pipekit.sinks.files import list_dirs
from pipekit.sinks.writers import write_counted


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def joined_plan(spark, build):
    """The plan without broadcasts, as on sides too large for them."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(build())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    rng = random.Random(2)
    fact = [(i, rng.choice([1, 1, 1, 2, None, 7]), rng.choice(["x", "x", "y", None]), rng.randint(1, 50), rng.randint(1, 9), i % 2)
            for i in range(3000)]
    spark.createDataFrame(fact, "id int, a int, b string, c int, d int, unused int").repartition(3).write.parquet(f"{root}/fact")
    sides = [("a int, a_name string", [(1, "one"), (2, "two"), (None, "none"), (9, "nine")], "a"),
             ("b string, d int, bd string", [("x", d, f"x{d}") for d in range(1, 9)] + [("y", 1, "y1"), (None, 2, "n2")], ["b", "d"]),
             ("c int, c_name string", [(c, str(c)) for c in range(1, 40)], "c"),
             ("d int, d_name string", [(d, str(d)) for d in range(1, 10)], "d")]
    dims_ = []
    for k, (schema, data, on) in enumerate(sides):
        spark.createDataFrame(data, schema).write.parquet(f"{root}/d{k}")
        dims_.append((spark.read.parquet(f"{root}/d{k}"), on))
    return spark.read.parquet(f"{root}/fact"), dims_, fact, sides


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_star_equals_loop(spark, star, how, null_safe):
    fact, dims_, data, sides = star
    got = joins.salted_star_join(fact.drop("unused"), dims_, how, share=5, salts=6, null_safe=null_safe)
    assert got.columns == ["id", "a", "b", "c", "d", "a_name", "bd", "c_name", "d_name"]
    names = ["id", "a", "b", "c", "d"]
    want = []
    for r in data:
        row, keep = dict(zip(names, r)), True
        found = list(r[:5])
        for schema, side, on in sides:
            on = [on] if isinstance(on, str) else on
            columns = [c.split()[0] for c in schema.split(", ")]
            hit = [s[-1] for s in side if all(row[k] == s[columns.index(k)] and (null_safe or row[k] is not None) for k in on)]
            keep = keep and (hit or how == "left")
            found.append(hit[0] if hit else None)
        if keep:
            want.append(tuple(found))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_salted_star_reads_the_fact_once(spark, star):
    fact, dims_, _, _ = star
    heavy = joins.heavy_hashes(fact, [["a"], ["b", "d"], ["c"], ["d"]], 5)
    assert len(heavy[0]) == 1 and heavy[2] == []
    text = joined_plan(spark, lambda: joins.salted_star_join(fact, dims_, heavy=heavy).select("id", "a_name", "bd", "c_name", "d_name"))
    assert text.count("FileScan") == 5 and text.count("/fact") == 1
    scan = next(line for line in text.splitlines() if "/fact" in line)
    assert "unused" not in scan
    text = joined_plan(spark, lambda: dims.load_fact(fact, [(d, [on] if isinstance(on, str) else on) for d, on in dims_],
                                                     {"id": F.col("id"), "n": F.col("c_name")}, skewed=True, check=False))
    assert text.count("/fact") == 1


def test_salted_keys_spread(spark, star):
    """With one key in half of all rows no partition gets half of them."""
    fact, dims_, _, _ = star
    wide = spark.range(20_000).select(F.col("id").cast("int").alias("id"), F.when(F.col("id") % 2 == 0, 1).otherwise(
        F.col("id")).cast("int").alias("a")).repartition(16)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(old, ("-1", "false", "32")):
        spark.conf.set(k, v)
    try:
        got = joins.salted_star_join(wide, dims_[:1], "left").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in got) == 20_000 and max(r["count"] for r in got) < 4000


def test_key_types_must_agree(spark, star):
    fact, dims_, _, _ = star
    with pytest.raises(ValueError, match="another type"):
        joins.salted_star_join(fact, [(dims_[0][0].withColumn("a", F.col("a").cast("long")), "a")])


def snapshots(spark, n, changed):
    before = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("w"))
    after = before.where("k % 977 <> 5 or k > 3000").withColumn("v", F.when(F.col("k").isin(changed), -1).otherwise(F.col("v")))
    return before, after.union(spark.createDataFrame([(n + 5, 1, "new"), (n + 9, None, None)], "k long, v long, w string")).repartition(5)


@pytest.mark.parametrize("leaf_rows", [1, 64, 1 << 20])
def test_diff_by_digest_equals_diff(spark, leaf_rows):
    before, after = snapshots(spark, 5000, [3, 4444])
    null = spark.createDataFrame([(None, 1, "same"), (None, 1, "same"), (None, 2, "b")], "k long, v long, w string")
    before, after = before.union(null), after.union(null)
    want = sorted(map(repr, changes.diff_snapshots(before, after, ["k"]).collect()))
    assert sorted(map(repr, changes.diff_by_digest(before, after, ["k"], leaf_rows).collect())) == want
    assert changes.diff_by_digest(before.where("k is not null"), before.where("k is not null").repartition(3), ["k"]).isEmpty()
    assert changes.diff_by_digest(before.limit(0), before.where("k < 5"), ["k"]).count() == 5


def test_few_changes_send_few_rows(spark):
    before, after = snapshots(spark, 50_000, [3, 44_444])
    old, new = changes.changed_rows(before, after, ["k"], leaf_rows=100)
    assert 0 < old.count() < 1500 and 0 < new.count() < 1500


def test_contents_are_reconciled(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "z")], "k int, v string")
    assert audit.reconcile_content(a, a.repartition(3), ["k"]).first()["match_status"] == "MATCH"
    for other in ([(1, "x"), (2, "y"), (3, "y"), (None, "z")], [(1, "x"), (2, "y"), (None, "z"), (None, "z")], []):
        got = audit.reconcile_content(a, spark.createDataFrame(other, "k int, v string"), ["k"]).first()
        assert got["match_status"] == "MISMATCH" and got["target_count"] == len(other)


def test_written_rows_are_counted_while_they_are_written(spark, tmp_path):
    df = spark.range(1000).repartition(4).withColumn("p", F.col("id") % 3)
    assert write_counted(df, f"{tmp_path}/a", partition_by=["p"]) == 1000 == spark.read.parquet(f"{tmp_path}/a").count()
    assert write_counted(df.where("id < 0"), f"{tmp_path}/b") == 0
    assert write_counted(spark.createDataFrame([], "a int"), f"{tmp_path}/c") == 0
    assert write_counted(df.groupBy("p").count().orderBy("p"), f"{tmp_path}/a") == 3


def test_bucketed_merge(spark, tmp_path):
    data = [(i if i % 3 else None, f"v{i}", "old") for i in range(300)]
    held = BucketedTable(spark, "bucketed_test", f"{tmp_path}/t", ["k"], buckets=4)
    assert held.version() == 0
    held.save(spark.createDataFrame(data, "k int, v string, day string"))
    source = spark.createDataFrame([(1, "one"), (2, None), (1000, "new"), (None, "keyless")], "k int, v string")
    want = [r for r in data if r[0] not in (1, 2)] + [(1, "one", "now"), (2, None, "now"), (1000, "new", "now"), (None, "keyless", "now")]
    text = joined_plan(spark, lambda: held.merged(source, {"day": F.lit("now")}))
    assert text.count("Exchange hashpartitioning") == 1
    held.upsert(source, {"day": F.lit("now")})
    assert sorted(map(repr, map(tuple, held.read().collect()))) == sorted(map(repr, want))
    assert held.version() == 2
    # A save cut short before the table was pointed to it leaves the version as it was.
    spark.createDataFrame([(None, "lost", "x")], "k int, v string, day string").write.parquet(f"{tmp_path}/t/unkeyed/v=000003")
    assert held.read().where("v = 'lost'").isEmpty()
    held.upsert(source.where("k = 1000").withColumn("v", F.lit("again")))
    assert rows(held.read().where("k = 1000").select("v", "day")) == [("again", "now")]
    assert held.read().where("v = 'lost'").isEmpty() and held.read().count() == len(want)
    with pytest.raises(merge.DuplicateKeyError):
        held.upsert(source.union(source))
    assert len(list_dirs(spark, f"{tmp_path}/t")) == 3
    held.save(spark.createDataFrame([(None, "only", "x")], "k int, v string, day string"))
    assert rows(held.read()) == [(None, "only", "x")]


def test_null_keys_do_not_meet_in_one_task(spark):
    """A third of the target without a key: the outer join spreads it and pairs none of it."""
    target = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    source = spark.createDataFrame([(1, -1), (None, -2)], "k long, v long")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = merge.upsert(target, source, ["k"], small_rows=0)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 30_001 and max(sizes) < 4000
    assert got.where("k is null").count() == 10_001
    diff = changes.diff_snapshots(
        target.where("v < 9"), target.where("v < 9"), ["k"])
    assert diff.count() == 6
    assert changes.apply_changes(target, diff.limit(0), ["k"], small_rows=0).count() == 30_000
    import datetime as dt
    opened = history.scd2_initial(target.where("v < 9"), dt.datetime(2024, 1, 1))
    assert history.scd2_changes(opened, target.where("v < 6"), ["k"], dt.datetime(2024, 2, 1)).count() == 9 + 2


def test_fact_of_null_members_joins_staged_rows_once(spark):
    """Computing the staged rows again under each lookup sorts them again inside the same tasks."""
    from pipekit.plans.catalog import QUERIES
    text = joined_plan(spark, lambda: QUERIES["fact_null_member"](spark, "/root/testdata/sf0.001"))
    assert text.count("SortMergeJoin") == 4 and "orders.parquet" not in text
