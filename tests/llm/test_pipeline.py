import zlib

import pytest

import corpus_pipeline
from panelrisk.llm import queries


def test_stages_filter_and_keep_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, small)
        assert after.columns == docs.columns, name
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in before.select("doc_id").collect()}
        before = after
    assert before.count() < docs.count()
    last = corpus_pipeline.run(spark, small)
    assert last.count() == before.count() and "n_tokens" in last.columns


@pytest.mark.parametrize("n,columns", [
    (1, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]), (2, ["doc_id", "held_out", "score", "predicted"]),
    (3, ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]),
    (4, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]), (5, ["query_id", "rank", "vec_id", "score"]),
    (6, ["doc_id", "n_shingles", "component_id"]), (7, ["doc_id", "held_out", "lang_pred", "score"]),
    (8, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]),
    (9, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]), (10, ["doc_id", "text"]),
])
def test_contract_columns(spark, small, n, columns):
    name = next(q for q in queries.QUERIES if q.startswith(f"op{n}_"))
    df = queries.QUERIES[name](spark, small)
    assert set(columns) <= set(df.columns)
    docs = spark.read.parquet(f"{small}/documents.parquet").count()
    assert df.count() == (docs if n != 5 else 25 * 20)


def test_held_out_is_the_rule(spark, small):
    for r in queries.op2_quality(spark, small).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.3)
