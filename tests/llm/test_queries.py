"""Every query over training data and the pipeline run on the smallest tables with the columns they promise."""

import pytest
from conftest import rows

import corpus_pipeline
from pipekit.llm import queries, stages

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_gives_a_row_for_each_input(spark, name):
    got = queries.QUERIES[name](spark, SF)
    table = "embeddings" if name[:3] in ("op2", "op6") else "documents"
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    count = got.count()
    if name.startswith("op13"):
        assert count > 0
    else:
        assert count == 500 if name.startswith("op2") else count == n if name[:4] not in ("op7_", "op10") else count >= n


def test_stages_keep_columns_and_take_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "minhash_near_dedup", "suffix_array_dedup", "source_mixing", "best_fit_packing"]
    docs = spark.createDataFrame([(1, "the and of that edly " * 30, "en", "a", 1), (2, "12 34", None, "a", 1), (3, None, "en", "b", 1)],
                                 spark.read.parquet(f"{SF}/documents.parquet").schema)
    kept = stages.identify(spark, docs, SF)
    assert rows(kept, "doc_id") == [(1,)] and kept.columns == docs.columns


def test_the_pipeline_runs_on_odd_documents(spark, tmp_path):
    """Nulls, empty texts, repeated rows and ids, columns of clashing names; an empty table."""
    real = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    schema = real.schema
    long = "storm over the silver garden and the copper river " * 30
    odd = [(None, None, None, None, None), (900_001, "", "en", "web", 0), (900_002, long, "en", None, 1), (900_002, long, "en", None, 1),
           (900_003, long + "tail", None, "web", 1), (None, "a text without an id, of some plain words", "en", "web", 1)]
    assert [f.name for f in schema] == ["doc_id", "text", "lang", "source", "n_chars"]
    for name, rows_ in (("odd", real.union(spark.createDataFrame(odd, schema))), ("none", real.limit(0))):
        more = rows_.selectExpr("*", *[f"1 as {c}" for c in ("row", "n", "__row", "chunk", "node", "lang_pred", "weight", "kept")])
        more.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        ids = [r.doc_id for r in got.select("doc_id").distinct().collect()]
        assert (len(ids) > 0) == (name == "odd")
        if name == "odd":
            assert 900_001 not in ids and ids.count(900_002) + ids.count(900_003) == 1
            assert got.agg({"length": "max"}).first()[0] <= 4096
