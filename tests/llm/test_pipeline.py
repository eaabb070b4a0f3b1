import os

import corpus_pipeline
import pytest
from test_tokens_packing import check

from tidewell.llm import decontaminate, neardup, pii, quality, queries

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


def test_stages_keep_the_columns_of_documents_and_pack_the_rest(spark):
    docs = queries.table(spark, FOLDER, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "near-duplicates", "benchmark decontamination", "pseudonyms", "best-fit packing"]
    kept = docs
    ids = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = neardup.settle(stage(spark, kept, FOLDER), "stage")
        assert kept.dtypes == docs.dtypes
        ids.append({r["doc_id"] for r in kept.select("doc_id").collect()})
    # what each operator says about the stage's own input
    model = quality.fit(docs, queries.table(spark, FOLDER, "labels"))
    good = {r["doc_id"] for r in quality.score(docs, model).collect() if r["predicted"]}
    assert ids[0] == good
    rows = docs.collect()
    input_two = spark.createDataFrame([r for r in rows if r["doc_id"] in ids[0]], docs.schema)
    assert ids[1] == {r["doc_id"] for r in neardup.near_duplicates(input_two, corpus_pipeline.SIMILAR).collect() if r["kept"]}
    leaked = {r["doc_id"] for r in decontaminate.overlaps(docs, queries.table(spark, FOLDER, "benchmark")).collect()}
    assert ids[2] == ids[3] == ids[1] - leaked
    final = pii.pseudonymised(docs, queries.PSEUDONYM_KEY).where(docs["doc_id"].isin(list(ids[3])))
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    check(packed, [tuple(r) for r in final.select("doc_id", "text").collect()], 2048)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op8_lsh_forest", "op5_fm_index", "op4_best_fit_packing"}))
def test_queries_answer_for_their_whole_table(spark, name):
    found = queries.QUERIES[name](spark, FOLDER)
    assert found.count() > 0
    if name in ("op2_subword_quality", "op6_feistel_pseudonyms", "op7_token_counts", "op10_kneser_ney_language"):
        assert found.count() == queries.table(spark, FOLDER, "documents").count()


def test_entry_points():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
