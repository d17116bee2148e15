"""The corpus pipeline: documents in, packed training sequences out.

Every stage is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pipekit.llm import stages
from pipekit.session import scratch

STAGES = [
    ("language_id", stages.identify),
    ("minhash_near_dedup", stages.one_of_each_group),
    ("suffix_array_dedup", stages.cut_repeats),
    ("source_mixing", stages.mix_sources),
    ("best_fit_packing", stages.pack),
]

# Learned models, sketches and genetic search have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path, out = scratch(spark, f"pipeline-{name}"), stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
