"""The pipeline's stages: (spark, docs, sf_dir) to the documents that go on.

A stage's result is written and read again as the next one's ``docs``. So a stage first deletes the working tables and
shuffle files of the stage before it in the same thread, and executors give unused heap back; a result that is not saved
yet by then can't be read any more.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipekit.llm import language_id, near_dedup, packing, source_mixing, suffix_dedup
from pipekit.llm.common import fold, free_heaps, free_shuffles, read_table, ship
from pipekit.session import drop_tables, held_tables

#: Bytes of a repeated passage that is cut: fifty words of three letters and a blank. Passages of over fifty words have as
#: many unless their words are shorter still.
PASSAGE = 200
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_BEFORE: ContextVar[list[str] | None] = ContextVar("pipeline_stage_tables", default=None)


def stage(run: Stage) -> Stage:
    @wraps(run)
    def kept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _BEFORE.get() or [])
        free_shuffles(spark)
        free_heaps(spark)
        ship(spark)
        with held_tables() as made:
            _BEFORE.set(made)
            return run(spark, docs, sf_dir)
    return kept


@stage
def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language could be told; those without a letter go. Learns from the labelled documents of
    ``sf_dir`` outside fold 2 of 4."""
    labelled = read_table(spark, sf_dir, "documents").where(fold(F.col("doc_id"), 4) != 2)
    return language_id.keep_identified(docs, language_id.train(labelled))


@stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.keep_one(docs)


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of PASSAGE bytes or more that also start elsewhere in the corpus."""
    return suffix_dedup.without_repeats(docs, length=PASSAGE)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources reach their tempered weights; every document appears at least once."""
    return source_mixing.mixed_documents(docs)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
