"""The corpus pipeline stage by stage, each judged on its own input."""

import re

import corpus_pipeline
from ventis.llm import queries

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    extra = spark.createDataFrame(
        [(10_000, None, "en", "s", 0), (10_001, "12 34 !!", None, "s", 8),
         (10_002, "the end of this one is at that time", None, "s", 35)], docs.schema)
    docs = docs.union(extra)
    seen = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        seen[name] = docs
    ids = {r["doc_id"] for r in seen["language_id"].collect()}
    assert ids == set(range(200)) | {10_002}
    kept = {r["doc_id"] for r in seen["simhash_dedup"].collect()}
    again = corpus_pipeline.drop_near_duplicates(spark, seen["simhash_dedup"], SMALL)
    assert again.count() == len(kept) < len(ids)
    for row in seen["pii"].collect():
        assert row["n_chars"] == len(row["text"])
        assert not re.search(r"@mail\d+\.example\.com", row["text"])
    assert {r["doc_id"] for r in seen["packing"].collect()} == kept


def test_every_query_is_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert "pipeline" in names and set(queries.ORACLES) <= set(names)
