"""The queries over training data: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipekit.llm import language_id, line_dedup, near_dedup, ngram_lm, packing, periodic_runs, source_mixing, spelling
from pipekit.llm import suffix_dedup, token_files, toxicity, vector_dedup, vp_search
from pipekit.llm.common import fold, read_table
from pipekit.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


VOCABULARY = 49_408


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written in coded blocks and read back from them."""
    path = scratch(spark, "token-files")
    token_files.write(read_table(spark, sf_dir, "documents"), path, tokenizer_path(), VOCABULARY, end=2)
    return token_files.read_documents(spark, path)


@query
def op2_vp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return vp_search.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


@query
def op3_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a bigram model by deleted interpolation."""
    return ngram_lm.score(read_table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from the labelled folds other than 1 of 3."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs.where(fold(F.col("doc_id"), 3) != 1), read_table(spark, sf_dir, "labels"))
    marked = toxicity.score(docs.select("doc_id", "text"), model)
    return marked.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text once all strings of 400 bytes that also start elsewhere are cut."""
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


@query
def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label with a cosine of 0.93 or more, and their components."""
    return vector_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut to 4096 tokens at most and packed into as few sequences of 4096 as can be."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the folds other than 2 of 4."""
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(fold(F.col("doc_id"), 4) != 2))
    marked = language_id.predict(docs.select("doc_id", "text"), model)
    return marked.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose five-word shingle sets are at least three quarters alike."""
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every draw of a document in the flattest mixture that runs no source more than twice and each at least once."""
    drawn = source_mixing.mixture(read_table(spark, sf_dir, "documents"))
    return drawn.select("row.doc_id", "source", "n_tokens", "weight", "epoch", "slot", "within")


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text once lines that other documents hold too stay in the first of them only."""
    done = line_dedup.drop_repeated_lines(read_table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op11_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT keyed.*, shared.first IS NOT NULL AND keyed.doc_id <> shared.first AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of the words of every text, with the contract's runs planted in every tenth one."""
    return periodic_runs.run_report(read_table(spark, sf_dir, "documents"), plant=True)


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all texts with its commoner spelling, with the contract's deletions."""
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"), delete_every=spelling.DELETE_EVERY)
