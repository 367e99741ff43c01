from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from citeweave.llm.queries import QUERIES, SQL

from .cases import no_docs, odd_docs


def test_stages_keep_the_columns(spark, tmp_path):
    docs = odd_docs(spark)
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs.write.parquet(str(tmp_path / f"stage{i}"))
        docs = stage(spark, spark.read.parquet(str(tmp_path / f"stage{i}")), str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert docs.columns == ["doc_id", "ids", "decoded"] and docs.count() > 0


def test_stages_carry_columns_of_any_name(spark, tmp_path):
    names = ["_li", "_lines", "_shard", "_place", "_mx_key", "_ld_id", "_nd_id", "a.b"]
    docs = odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(f"my {n}").alias(n) for n in names])
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, str(tmp_path)).collect()
        assert rows and rows[0].__fields__ == docs.columns
        assert all(tuple(row)[5:] == tuple(f"my {n}" for n in names) for row in rows)


def test_stages_on_no_documents(spark, tmp_path):
    docs = no_docs(spark)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs.write.parquet(str(tmp_path / f"stage{i}"))
        docs = stage(spark, spark.read.parquet(str(tmp_path / f"stage{i}")), str(tmp_path))
    assert docs.count() == 0


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(SQL) <= set(QUERIES)
