import corpus_pipeline
from frames import messy

from barwatch.llm.common import read_table


def test_stages_keep_the_columns_and_pack_what_is_left(spark):
    docs = messy(spark)
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        left.append({r.doc_id for r in docs.collect()})
    assert not left[0] & {7, 8, 9, 11}
    assert len(left[1] & {10, 12}) == 1
    assert len(left[2] & {0, 1, 2}) == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {p.doc_id for p in packed} == left[3]


def test_run_packs_documents_of_the_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = corpus_pipeline.run(spark, sf_dir)
    known = {r.doc_id for r in read_table(spark, sf_dir, "documents").select("doc_id").collect()}
    assert {r.doc_id for r in found.select("doc_id").distinct().collect()} <= known
