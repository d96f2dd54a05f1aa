import corpus_pipeline
from tests.llm.helpers import documents


def test_stages_keep_columns_and_work_on_what_is_left(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(function(spark, docs, sf_dir))
        left = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and left <= ids
        ids = left
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in last.collect()} == ids and len(ids) > 100


def test_run_on_planted_documents(spark, tmp_path):
    clean = [" ".join(f"c{i}w{j}" for j in range(80)) for i in range(30)]
    passage = " ".join(f"bench{i}" for i in range(30))
    planted = [clean[0], clean[0] + " more", "too short", f"{clean[1]} {passage}", clean[2].replace("w5 ", 'w5 token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ')]
    documents(spark, clean + planted, first=1000).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert kept == {1000, 1001, 1002, None, *range(1004, 1030)}
