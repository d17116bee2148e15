"""Suffix order of integer strings by the difference-cover algorithm (Karkkainen and Sanders, 2003), as Spark jobs.

Strings live in rows (chunk, i, name, cover): names of one chunk stand at i = 0, 1, 2 ... and a chunk's last name occurs
nowhere else, so no comparison runs past a chunk. Positions with i mod 3 of 1 or 2 are the sample. Their triples are
sorted and named; where names repeat, the string of names is solved by recursion; the remaining suffixes are sorted by
their first name and the rank of what follows, and merged by counting how many of the others come before.

``cover`` is what a name stands for in the text. Comparison beyond ``enough`` of it is of no interest, so a name is final
if it occurs once or covers that much: no comparison runs past it, and suffixes that are equal so far may share a rank.
Recursion takes only names that are not final, and the one that ends each run of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pipekit.llm.common import free_shuffles
from pipekit.session import durable, scratch, working_tables


def _running(columns: list[str]):
    """Exclusive running sums of count columns down a sorted partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), np.zeros(len(columns), dtype=np.int64)
        for batch in batches:
            arrays, names = list(batch.columns), list(batch.schema.names)
            for k, c in enumerate(columns):
                sums = np.cumsum(batch.column(names.index(c)).to_numpy(), dtype=np.int64)
                arrays[names.index(c)] = pa.array(np.concatenate([[0], sums[:-1]]) + at[k])
                arrays.append(batch.column(names.index(c)))
                at[k] += sums[-1] if len(sums) else 0
            arrays.append(pa.array(np.full(batch.num_rows, part, dtype=np.int32)))
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *[f"own_{c}" for c in columns], "part"])
    return run


def rank_keys(rows: DataFrame, keys: list[str], counts: dict[str, F.Column]) -> DataFrame:
    """``rows`` with, for each named count, how many rows with smaller keys it has counted; own_<name> is the count
    among rows with equal keys. Equal keys are summed before they are sorted, so a frequent key is one row."""
    sums = rows.groupBy(keys).agg(*[F.sum(c.cast("long")).alias(n) for n, c in counts.items()])
    sums = durable(sums, "sa-keys")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join([*[f"{k} long" for k in keys], *[f"{n} long" for n in counts], *[f"own_{n} long" for n in counts],
                        "part int"])
    local = durable(sums.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(
        _running(list(counts)), schema), "sa-sorted")
    # One row for each partition.
    totals = sorted(local.groupBy("part").agg(*[F.sum(f"own_{n}") for n in counts]).collect())
    before, at = {}, [0] * len(counts)
    for part, *own in totals:
        before[part] = list(at)
        at = [a + b for a, b in zip(at, own, strict=True)]
    spark = rows.sparkSession
    base = spark.createDataFrame([(p, *v) for p, v in before.items()] or [(-1, *at)],
                                 ", ".join(["part int", *[f"base_{n} long" for n in counts]]))
    whole = local.join(base, "part").select(
        *keys, *[(F.col(n) + F.col(f"base_{n}")).alias(n) for n in counts], *[f"own_{n}" for n in counts])
    return rows.join(whole, keys)


def suffix_ranks(strings: DataFrame, enough: int) -> DataFrame:
    """chunk, i, rank of every suffix of ``strings`` (chunk, i, name, cover; all long). The rank lies between the
    number of smaller suffixes and that plus the number of equal ones."""
    spark = strings.sparkSession
    path = scratch(spark, "sa-ranks")
    with working_tables(spark):  # a level's tables go with it
        _level(strings, enough).write.parquet(path)
    free_shuffles(spark)
    return spark.read.schema("chunk long, i long, rank long").parquet(path)


def _level(strings: DataFrame, enough: int) -> DataFrame:
    order = Window.partitionBy("chunk").orderBy("i")
    rows = durable(strings.select(
        "chunk", "i", "name", F.lead("name", 1, 0).over(order).alias("n1"), F.lead("name", 2, 0).over(order).alias("n2"),
        "cover", (F.col("cover") + F.lead("cover", 1, 0).over(order) + F.lead("cover", 2, 0).over(order)).alias("covers")),
        "sa-rows")
    sample = rows.where("i % 3 != 0").select("chunk", "i", "name", "n1", "n2", "covers")
    named = durable(rank_keys(sample, ["name", "n1", "n2"], {"r": F.lit(1)}).select("chunk", "i", "covers", "r", "own_r"),
                    "sa-named")
    open_ = named.where("own_r > 1").agg(F.min("covers")).first()[0]
    if open_ is None or open_ >= enough:
        ranked = named.select("chunk", "i", "r")
    else:
        half = Window.partitionBy("chunk").orderBy(F.col("i") % 3, "i")
        goes_on = (F.col("own_r") > 1) & (F.col("covers") < enough)
        kept = named.withColumn("goes_on", goes_on).withColumn("ends", F.lag("goes_on", 1, False).over(half)).where("goes_on or ends")
        numbered = durable(kept.select("chunk", "i", "r", "covers", "goes_on",
                                       (F.row_number().over(half) - 1).cast("long").alias("j")), "sa-numbered")
        deeper = suffix_ranks(numbered.select("chunk", F.col("j").alias("i"), (F.col("r") + 1).alias("name"),
                                              F.col("covers").alias("cover")), enough)
        inner = durable(numbered.where("goes_on").select("chunk", "i", "r", "j").join(
            deeper.withColumnRenamed("i", "j"), ["chunk", "j"]).select("chunk", "i", "r", "rank"), "sa-inner")
        # Ranks among equal names, on top of the number of smaller names.
        least = inner.groupBy("r").agg(F.min("rank").alias("least"))
        ranked = named.where(~goes_on).select("chunk", "i", "r").union(
            inner.join(least, "r").select("chunk", "i", (F.col("r") + F.col("rank") - F.col("least")).alias("r")))
    joined = rows.select("chunk", "i", "name", "n1").join(ranked, ["chunk", "i"], "left")
    full = durable(joined.select("chunk", "i", "name", "n1", "r", F.coalesce(F.lead("r", 1).over(order), F.lit(-1)).alias("r1"),
                                 F.coalesce(F.lead("r", 2).over(order), F.lit(-1)).alias("r2")), "sa-full")
    kind = F.col("i") % 3
    with_one = rank_keys(full.where(kind != 2), ["name", "r1"], {"zeros": kind == 0, "ones": kind == 1})
    with_two = rank_keys(full.where(kind != 1), ["name", "n1", "r2"], {"zeros": kind == 0, "twos": kind == 2})
    first = with_one.select("chunk", "i", F.when(kind == 0, F.col("zeros") + F.col("ones")).otherwise(
        F.col("r") + F.col("zeros")).alias("part"))
    second = with_two.select("chunk", "i", F.when(kind == 0, F.col("twos")).otherwise(
        F.col("r") + F.col("zeros")).alias("part"))
    return first.union(second).groupBy("chunk", "i").agg(F.sum("part").alias("rank")).select("chunk", "i", "rank")
