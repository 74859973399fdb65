"""The pipeline's stages keep the columns of documents, and run() equals the stages in turn."""

from llm_support import SF

import __spark_entry__ as entry
import corpus_pipeline


def test_queries_are_registered():
    names = set(entry.queries())
    assert {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert {"op4_line_dedup", "op5_quality_rules", "op7_chat_format"} <= set(entry.oracle_sql())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[1] == seen[2] and seen[4] == seen[5] > 100
    again = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, tuple(r.ids)) for r in again.collect()) == sorted((r.doc_id, tuple(r.ids)) for r in docs.collect())
