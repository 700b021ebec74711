from __future__ import annotations

import corpus_pipeline
from corpus_pipeline import STAGES, run


def test_stages_one_by_one(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [name for name, _ in STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    counts = {}
    for name, stage in STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        counts[name] = docs.count()
        if name != "packing":
            assert docs.columns == columns
            assert docs.where("n_chars <> length(text)").count() == 0
    assert before > counts["quality"] == counts["line_dedup"] > counts["near_dedup"] == counts["decontamination"]
    assert docs.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    # The same rows whole as stage by stage; nothing is lost on the way.
    assert sorted(run(spark, sf_dir).drop("sequence_id", "offset").collect()) == sorted(
        docs.drop("sequence_id", "offset").collect()
    )


def test_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0, name


def test_registered():
    from __spark_entry__ import queries

    assert queries()["pipeline"] is corpus_pipeline.run
