"""Dropping lines that many documents share.

Lines are exploded with their positions, normalised and hashed; each hash counts its distinct documents; lines whose
hash is in too many go, except in the document with the smallest id; texts are put together again by position.

Texts move once, to meet their list of dropped positions. The rest works on 128-bit hashes: the hashes of a line that
fills a third of the corpus are combined before they move, and the few keys that hold a thousandth of all lines or
more are looked up by broadcast, so no task gets one line's occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pipekit.llm.common import text_slices
from pipekit.session import durable

MIN_CHARS = 10
MIN_DOCS = 2
HOT_SHARE = 1000
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """A line without ASCII blanks at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines at the positions listed beside them."""
    for batch in text_slices(batches, "kept"):
        texts, gone = batch.column("kept").to_pylist(), batch.column("gone").to_pylist()
        for i, positions in enumerate(gone):
            if positions:
                drop = set(positions)
                texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in drop)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(texts, pa.string()), batch.column("n_lines"),
             pa.array([len(g or ()) for g in gone], pa.int64())], names=["row", "kept", "n_lines", "n_dropped"])


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS,
                        min_docs: int = MIN_DOCS) -> DataFrame:
    """One row (row, kept, n_lines, n_dropped) for each row of ``docs``; ``row`` holds all its columns.

    A line is dropped if its key has ``min_chars`` code points or more and is found in ``min_docs`` documents or more,
    unless its document has the smallest id of those. A null or empty text is one empty line and comes back as the
    empty text. Rows with one id are one document: a line they alone share stays in each of them, as do a line's
    repeats inside the document that keeps it. Rows with a null id are one document, after all others. An empty table
    gives no rows; columns of any name may stand beside the two.
    """
    numbered = durable(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("n")), "line-docs")
    doc, body = F.col("row").getField(doc_id), F.col("row").getField(text)

    lines = numbered.select("n", doc.alias("doc"), F.posexplode(_split(body)).alias("pos", "line"))
    keyed = lines.select("n", "doc", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    found = durable(keyed.select("n", "doc", "pos", F.xxhash64("key").alias("h1"),
                                 F.xxhash64(F.lit(1), "key").alias("h2")), "line-keys")
    shared = durable(found.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one")).groupBy("h1", "h2")
                     .agg(F.count("one").alias("docs"), F.min("doc").alias("first"), F.lit(True).alias("shared"))
                     .where(F.col("docs") >= min_docs), "line-shared")

    # At most HOT_SHARE keys can be in so many documents, each of which has a line of them.
    hot_from = found.count() // HOT_SHARE + 1
    hot = F.broadcast(shared.where(F.col("docs") >= hot_from)
                      .select("h1", "h2", F.col("first").alias("hot_first"), F.col("shared").alias("hot")))
    rest = shared.where(F.col("docs") < hot_from)
    marked = found.join(hot, ["h1", "h2"], "left")
    gone_hot = marked.where("hot and not doc <=> hot_first").select("n", "pos")
    gone_rest = (found.join(hot, ["h1", "h2"], "left_anti").join(rest, ["h1", "h2"])
                 .where("not doc <=> first").select("n", "pos"))
    gone = gone_hot.union(gone_rest).groupBy("n").agg(F.collect_list("pos").alias("gone"))

    schema = StructType([numbered.schema["row"], StructField("kept", StringType()), StructField("n_lines", LongType()),
                         StructField("n_dropped", LongType())])
    return numbered.join(gone, "n", "left").select(
        "row", F.coalesce(body, F.lit("")).alias("kept"), F.size(_split(body)).cast("long").alias("n_lines"), "gone"
    ).mapInArrow(_without, schema)


def without_repeated_lines(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """``docs`` with its own columns, repeated lines taken out of its texts; a text that loses nothing, null among
    them, stays as it is."""
    done = drop_repeated_lines(docs, text, **settings)
    return done.select(*[F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row").getField(c)).alias(c)
                         if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
