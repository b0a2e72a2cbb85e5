"""The pipeline's stages, each on what its predecessor kept."""

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_turn(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == columns and set(after) <= set(before)
        gone = set(before) - set(after)
        if name == "quality_rules":
            assert gone and all(len(before[i].split()) < 50 for i in gone & good)
        if name == "quality_classifier":
            assert not gone & good
        if name == "repeated_passages":
            assert not gone and any(len(after[i]) < len(before[i]) for i in after)
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        else:
            assert all(after[i] == before[i] for i in after)
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r["doc_id"] for r in packed.collect()} == set(before)
    whole = corpus_pipeline.run(spark, FOLDER)
    ids = lambda df: sorted((r["doc_id"], r["doc_tokens"]) for r in df.where("start = 0").collect())
    assert ids(whole) == ids(packed)
