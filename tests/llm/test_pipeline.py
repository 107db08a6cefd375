import corpus_pipeline
from starloom.llm.queries import importable


def test_stages_keep_the_columns_and_their_decisions(spark, tmp_path):
    importable(spark)
    body = " ".join(f"tok{i}" for i in range(40))
    passage = " ".join(f"bench{i}" for i in range(20))
    rows = [
        (1, f"{body} one jo@x.example.org", "en", "s", 5, "k"), (2, f"{body} two jo@x.example.org", "en", "s", 5, "k"),
        (3, "too short", "en", "s", 9, "k"), (4, f"{passage} and some more words here", "en", "s", 9, "k"),
        (5, " ".join(f"other{i}" for i in range(30)), None, None, None, None), (6, None, "en", "s", 0, "k"),
    ]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, uid string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(9, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(found) == [1, 5]
    assert "<EMAIL>" in found[1].text and found[1].n_chars == len(found[1].text) and found[1].ids
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "pieces"]
