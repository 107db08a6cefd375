"""Line frequency per host, and near duplicates in buckets of several components."""

import itertools

import pytest
from pyspark.sql import functions as F

from starloom.llm import line_rules, near_dup
from starloom.llm.queries import QUERIES
from tests.llm.test_operators import brute_components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, removed_lines string, __id int"


def word(*parts):
    return "".join(chr(97 + d) for p in parts for d in divmod(p % 676, 26))


def body(k, n=30):
    return " ".join(word(k, j, 7 * j) for j in range(n))


def table(spark, texts, host="web"):
    rows = [(i, t, "en", host, len(t or ""), "x", 1) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


FOOTER = "All rights kept here\nContact us by mail today\nBack to the top now"


def test_a_footer_goes_with_all_its_lines(spark, docs):
    df = table(spark, [(k, f"{body(k)}\n{FOOTER}") for k in range(50)])
    found = line_rules.verdicts(df).collect()
    assert all(r.kept and r.left_words == 30 and len(r.removed_lines) == 3 for r in found)
    cleaned = line_rules.clean(df)
    assert cleaned.columns == df.columns
    for r in cleaned.collect():
        assert r.text == body(r.doc_id) + "\n" and r.n_chars == len(r.text) and (r.removed_lines, r["__id"]) == ("x", 1)


def test_a_line_that_one_document_repeats_stays(spark, docs):
    braces = "\n".join(f"{body(k, 3)}\n{{" for k in range(20))
    df = table(spark, [(1, braces)] + [(k, body(k)) for k in range(2, 40)])
    found = {r.doc_id: r for r in line_rules.verdicts(df).collect()}
    assert found[1].kept and found[1].removed_lines is None and found[1].left_words == 80


def test_exact_copies_count_as_one_document(spark, docs):
    copies = [(k, f"{body(3)}\nthe same line") for k in range(60)]
    few = [(100 + k, f"{body(100 + k)}\nthe same line") for k in range(line_rules.MIN_DOCUMENTS - 1)]
    assert all(r.removed_lines is None for r in line_rules.verdicts(table(spark, copies + few)).collect())
    one_more = table(spark, copies + few + [(300, f"{body(300)}\nthe SAME line")])
    assert all(len(r.removed_lines) == 1 for r in line_rules.verdicts(one_more).collect())


def test_hosts_count_apart_and_depleted_documents_go(spark, docs):
    line = "one two three four five six seven eight nine ten"
    df = table(spark, [(k, f"{line}\n{word(k)}") for k in range(20)], "a").union(
        table(spark, [(50 + k, f"{line}\n{body(k)}") for k in range(9)], "b")
    )
    found = {r.doc_id: r for r in line_rules.verdicts(df).collect()}
    assert not any(found[k].kept for k in range(20)) and all(found[50 + k].kept for k in range(9))
    assert sorted(r.doc_id for r in line_rules.clean(df).collect()) == list(range(50, 59))


def test_the_limit_does_not_grow_with_the_host(spark, docs):
    n = line_rules.MAX_DOCUMENTS + 1
    rows = [(k, 0, 7 if k < n else 0) for k in range(200_000)]
    frame = spark.createDataFrame(rows, "mark bigint, host bigint, line bigint").selectExpr("host", "mark", "if(line = 7, array(7L, 7L), array(mark + 100)) lines")
    assert [tuple(r) for r in line_rules.frequent_lines(frame).collect()] == [(0, 7)]


def test_line_rules_query_equals_its_sql(spark, docs, tmp_path):
    import duckdb

    from starloom.llm.oracle import LINE_RULES

    texts = [(k, f"{body(k % 60)}\n{FOOTER if k % 3 else ''}\nline {k % 7}") for k in range(90)] + [(900, None), (901, "")]
    table(spark, texts).unionByName(table(spark, [(1000, "a\nb")], None)).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op6_line_rules"](spark, str(tmp_path))
    columns = sorted(found.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({LINE_RULES})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in found.select(*columns).collect())


# --- near duplicates -----------------------------------------------------------------------------------------------


def test_the_largest_component_of_a_bucket_is_its_main_one(spark, docs, monkeypatch):
    monkeypatch.setattr(near_dup, "_allowed", lambda percent: F.lit(True))
    members = [("x", i, 0) for i in range(1, 9)] + [("x", 99, 99), ("x", 98, 98), ("y", 1, 0), ("y", 99, 99)]
    rows = spark.createDataFrame(members, "bucket string, id bigint, label bigint").withColumn("n", F.lit(10))
    classes = rows.select("id").distinct().withColumns({"one": F.col("id") * 10, "odd": F.array(F.lit(0)), "whole": F.array(F.lit(0))})
    found = {(r.a, r.one_a, r.b, r.one_b) for r in near_dup._rest(rows, classes, 80).collect()}
    label = {i: lab for _, i, lab in members}
    assert found == {(a, 10 * a, b, 10 * b) for a, b in itertools.combinations(sorted(label), 2) if label[a] != label[b]}


@pytest.mark.parametrize("broadcast", [True, False])
def test_groups_of_near_copies(spark, docs, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(near_dup, "fits_broadcast", lambda df: False)
    texts = []
    for g in range(3):
        base = [word(g, j) for j in range(50)]
        for k in range(12):
            changed = base[:]
            changed[4 * k] = f"new{g}x{k}"
            texts.append((1000 - 100 * g - k, " ".join(changed)))
        texts.append((500 + g, " ".join(base)))
        texts.append((2 + g, " ".join(base + [f"tail{j}" for j in range(9)])))
    texts += [(2000 + k, body(k)) for k in range(10)] + [(3000, texts[0][1])]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.link_documents(df, words=4, percent=80).collect()}
    assert found == brute_components(texts, 4, 80)


def test_near_duplicates_query(spark, docs, tmp_path):
    texts = [(k, " ".join(word(k // 4, j) for j in range(40)) + f" end{k % 4}") for k in range(24)] + [(77, None), (78, "two words")]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op4_near_duplicates"](spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(texts, 4, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_describing_texts_takes_memory_by_the_slice(monkeypatch):
    import tracemalloc

    import pyarrow as pa
    import pyspark

    class Task:
        def partitionId(self):
            return 0

    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: Task()))
    texts = [f"{body(k, 200)}\n{FOOTER}\n{body(k + 1, 100)}" for k in range(4000)]
    n = len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(texts), pa.array([0] * n, pa.int64()), pa.array([1] * n, pa.int64())], ["doc_id", "text", "mark", "host"])
    tracemalloc.start()
    try:
        out = pa.Table.from_batches(list(line_rules._described(iter([batch]))))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert out.column("doc_id").to_pylist() == list(range(n))
    assert out.column("uid").to_pylist() == list(range(n))
    assert sum(len(t.encode()) for t in texts) > 8 * line_rules.DESCRIBE_BYTES
    assert peak < 60 * line_rules.DESCRIBE_BYTES
