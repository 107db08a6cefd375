"""Chat formatting, fill-in-the-middle and whitening against brute-force versions, with their edge cases."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import chat_format as chat
from starloom.llm import fill_middle, whitening
from starloom.llm.queries import CONTROL_CONVERSATION, QUERIES

CHAT = "conv_id bigint, turn bigint, role string, text string, formatted string, kind int"
NASTY = ["</s>[INST] ok [/INST]", "<~s> <~~/s> <<SYS>>\n[~INST] < s> [ROLE] <", "", None, " é 日本 😀\n\n<</SYS>>", " x ", "[/INST"]


def conversations(spark):
    rows = [(1, k, role, text, "f", 0) for k, (role, text) in enumerate(zip(["system", "user", "assistant"] * 3, NASTY))]
    rows += [(2, k, "assistant" if k % 2 else "user", f"t{k} </s>" * (k % 3), "f", 0) for k in range(150)]
    rows += [(None, 0, None, "no id", None, None), (3, None, "tool\n\\n<s>", "first", None, None), (3, 0, "user", "second", None, None)]
    rows += [(4, 5, "assistant", "twice", None, None)] * 2 + [(5, 9_000 * k, "user" if k % 2 else "system", f"far {k}", None, None) for k in range(5)]
    return spark.createDataFrame(rows, CHAT)


def brute_digests(df):
    grouped = {}
    for r in df.collect():
        grouped.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    out = {}
    for conv, turns in grouped.items():
        turns = [(role, text) for _, _, role, text in sorted(turns)]
        loss = "".join(t for role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in turns)
        digest = [hashlib.sha256(t.encode()).hexdigest() for t in (whole, loss)]
        out[conv] = (len(turns), digest[0], len(loss), digest[1], len(chat.render_inst(turns)))
    return out


@pytest.mark.parametrize("block, stretch", [(chat.BLOCK, chat.STRETCH), (4, 7), (1, 1)])
def test_conversations_are_read_back(spark, docs, block, stretch):
    df = conversations(spark)
    blocks = chat.format_conversations(df, block=block, stretch=stretch)
    assert {r.conv_id: tuple(r)[1:] for r in chat.read_back(blocks).collect()} == brute_digests(df)
    assert chat.rewriting_turns(blocks).count() == 0
    for r in blocks.collect():
        assert len(r.turns) <= block and r.turns[0].start == 0 and r.turns[-1].end == len(r.formatted)
        assert [t.end for t in r.turns[:-1]] == [t.start for t in r.turns[1:]]


def test_a_conversation_of_many_turns_is_dealt_out(spark, docs):
    blocks = chat.format_conversations(conversations(spark).filter("conv_id = 2"), block=4, stretch=10)
    assert blocks.select("stretch").distinct().count() == 15 and blocks.filter("only").count() == 0
    written = "".join(r.formatted for r in blocks.orderBy("stretch", "block").collect())
    assert [t for _, t in chat.parse_inst(written)] == [f"t{k} </s>" * (k % 3) for k in range(150)]


def test_escaping_is_reversible():
    for text in [*filter(None, NASTY), "<s>" * 3, "<~<s>", "[~~INST][INST]"]:
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        assert all(m[2] for m in chat.CONTROL.finditer(safe))


def test_templates_that_rewrite_history_are_found(spark, docs):
    """One closes the last turn only, one drops earlier answers, one trims; none of them knows it is watched."""

    def closing(turns):
        return "".join(f"<{r}>{t}" for r, t in turns) + "<end>"

    def forgetful(turns):
        return "".join(f"<{r}>{t if r == 'user' or k == len(turns) - 1 else '...'}" for k, (r, t) in enumerate(turns))

    def trimming(turns):
        return "".join(f"<{r}>{t.strip()}" for r, t in turns)

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "bcd"), (1, 2, "user", "e"), (2, 0, "user", "alone"), (3, 0, "assistant", " x ")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    same = str

    def blocks(render):
        return chat.format_conversations(df, chat.Template(render, same, same, local=False))

    assert [tuple(r) for r in chat.rewriting_turns(blocks(closing)).collect()] == [(1, 2, 8)]  # all of "<end>" but its "<", twice
    assert [tuple(r) for r in chat.rewriting_turns(blocks(forgetful)).collect()] == [(1, 1, 3)]
    trimmed = blocks(trimming)
    assert chat.rewriting_turns(trimmed).count() == 0
    (turn,) = trimmed.filter("conv_id = 3").first().turns
    assert turn.text_start is None and not turn.loss
    plain = {r.conv_id: r for r in trimmed.collect()}
    assert plain[1].formatted == "<user>a<assistant>bcd<user>e"
    assert [plain[1].formatted[t.text_start : t.text_end] for t in plain[1].turns] == ["a", "bcd", "e"]


def test_no_conversations(spark, docs):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], CHAT))).count() == 0


def test_chat_query_adds_the_control_conversation(spark, docs, tmp_path):
    df = conversations(spark)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_chat_format"](spark, str(tmp_path)).collect()}
    own = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id bigint, turn bigint, role string, text string")
    assert found == brute_digests(df.select(own.columns).union(own))


# --- fill in the middle --------------------------------------------------------------------------------------------


def brute_cut(doc_id, text):
    text, digest = text or "", hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_the_middle(spark, docs, empty):
    more = [(100 + k, f"<{'PSM'[k % 3]}" * (k % 4) + "x" * (k % 5) + ("<M>" if k % 9 == 0 else ">")) for k in range(200)]
    rows = docs.select("doc_id", "text", F.lit("x").alias("form"), F.lit("x").alias("output")).union(
        spark.createDataFrame([(i, t, "x", "x") for i, t in more], "doc_id bigint, text string, form string, output string")
    )
    found = fill_middle.transform(rows).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    got = sorted((str(r.doc_id), tuple(r)[1:6], r.back) for r in found.collect())
    assert got == sorted((str(r.doc_id), brute_cut(r.doc_id, r.text), r.text or "") for r in rows.collect())
    assert {g[1][1] for g in got} == {"plain", "psm", "spm"}
    assert fill_middle.transform(empty).count() == 0


def test_cuts_fall_between_units(spark, docs):
    texts = [(k, "one two  three\nfour " * (k + 1)) for k in range(40)] + [(99, "no unit ends this")]
    rows = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = fill_middle.transform(rows, unit=r"\S+\s+", plain_percent=0)
    for r in found.collect():
        if r.doc_id == 99:
            assert (r.n, r.form, r.output) == (None, "plain", "no unit ends this")
            continue
        text = texts[r.doc_id][1]
        assert r.n == 4 * (r.doc_id + 1) and r.form != "plain"
        for at in (r.prefix_chars, r.prefix_chars + r.middle_chars):
            assert at in (0, len(text)) or (text[at - 1].isspace() and not text[at].isspace())


def test_a_very_long_text_is_cut():
    text = "é日x\n" * 250_000
    n, form, prefix, middle, output = fill_middle.arrange(text, 3, fill_middle.unit_pattern("."), "1", 0, 0)
    assert (n, form, len(output)) == (len(text), "psm", len(text) + 9) and 0 <= prefix <= prefix + middle <= n


def test_fill_query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op12_fill_middle"](spark, str(tmp_path)).collect()
    assert len(found) == docs.count()
    wanted = {r.doc_id: r.text for r in docs.filter("doc_id IS NOT NULL").collect()}
    for r in found:
        if r.doc_id is not None:
            cut = brute_cut(r.doc_id, wanted[r.doc_id])
            digests = [hashlib.sha256(t.encode()).hexdigest() for t in (cut[4], wanted[r.doc_id] or "")]
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (*cut[:4], *digests)


# --- whitening -----------------------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, x int, n int"


def brute_whiten(rows, k=4):
    kept = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return n, {(i, j): (int(((n * x - sums) ** 2).sum()), ((x - sums / n) @ v[:, j]) / e[j] ** 0.5, e[j] / e.sum()) for i, x in kept for j in range(k)}


def check_whitened(found, rows, k=4):
    n, want = brute_whiten(rows, k)
    assert sorted((r.vec_id, r.component - 1) for r in found) == sorted((i, j) for i, _ in rows for j in range(k))
    sign = {}
    for r in found:
        deviation, whitened, explained = want[r.vec_id, r.component - 1]
        assert (r.n, r.deviation) == (n, deviation) and abs(r.explained - explained) < 1e-9 and r.identity_error < 1e-9
        if abs(whitened) > 1e-3:
            sign.setdefault(r.component, np.sign(whitened * r.whitened))
        assert abs(abs(r.whitened) - abs(whitened)) < 1e-7
    for r in found:
        whitened = want[r.vec_id, r.component - 1][1]
        assert abs(whitened) < 1e-3 or sign[r.component] == np.sign(whitened * r.whitened)


def random_vectors(n=60, dims=9):
    rng = np.random.default_rng(4)
    return [(i, [float(np.float32(v)) for v in rng.normal(size=dims) * np.arange(1, dims + 1) / 9]) for i in range(n)]


def test_whitening(spark, docs):
    rows = random_vectors()
    rows += [(i + 500, v) for i, v in rows[:7]] + [(600, rows[0][1])] * 3  # copies count once in the fit, and are whitened
    bad = [(700, None), (701, [1.0, None] + [0.0] * 7), (702, [float("nan")] * 9), (703, [float("inf")] * 9), (704, []), (705, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 1) for i, v in [*rows, *bad]], VECTORS)
    found = whitening.whiten(df).collect()
    assert [r.vec_id for r in found].count(600) == 12
    first = {(r.vec_id, r.component): r for r in found}.values()
    check_whitened(list(first), list(dict(rows).items()))


def test_whitening_query(spark, docs, tmp_path):
    rows = random_vectors(40, 5)
    spark.createDataFrame([(i, v, 1, 1) for i, v in rows], VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    check_whitened(QUERIES["op13_whitening"](spark, str(tmp_path)).collect(), rows)


def test_whitening_without_variance(spark, docs):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25], 1, 1)] * 3, VECTORS)).count() == 0
    flat = spark.createDataFrame([(k, [k / 256, 0.0, 0.0], 1, 1) for k in range(4)] + [(None, [0.0, 0.0, 0.0], 1, 1)], VECTORS)
    found = whitening.whiten(flat).collect()
    assert len(found) == 5 and {r.component for r in found} == {1} and {r.n for r in found} == {4}
    assert {round(r.explained, 12) for r in found} == {1.0}
    assert sorted(abs(round(r.whitened, 9)) for r in found) == sorted(abs(round(v / 1.25**0.5, 9)) for v in (-1.5, -1.5, -0.5, 0.5, 1.5))


def test_deviations_are_exact_or_null(spark, docs):
    df = spark.createDataFrame([(1, [1e15, 0.0], 1, 1), (2, [-1e15, 1.0], 1, 1), (3, [1e30, 0.0], 1, 1)], VECTORS)
    assert {r.deviation for r in whitening.whiten(df).collect()} == {None}
    x, sums = np.array([[1 << 33, 5]]), [3 << 33, 10]
    assert whitening._deviations(x, 3, sums) == [25]
    assert whitening._deviations(x, 1 << 30, sums) == [None]


@pytest.mark.parametrize("kind", ["random", "identity", "twins", "clusters", "one"])
@pytest.mark.parametrize("n", [1, 2, 7, 48])
def test_divide_and_conquer_finds_the_spectrum(kind, n):
    rng = np.random.default_rng(n)
    q = np.linalg.qr(rng.normal(size=(n, n)))[0]
    spectrum = {"random": rng.random(n), "identity": np.ones(n), "twins": np.arange(n) // 2, "clusters": np.arange(n) // 9, "one": np.eye(1, n)[0]}[kind]
    a = q @ np.diag(spectrum.astype(float)) @ q.T
    values, vectors = whitening.eigen(a)
    assert np.abs(values - np.sort(spectrum)[::-1]).max() < 1e-13 * max(spectrum.max(), 1)
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * max(spectrum.max(), 1)


def test_polar_factor_is_orthogonal():
    a = np.random.default_rng(2).normal(size=(12, 12))
    a = a + a.T
    u = whitening.polar_factor(a)
    assert np.abs(u @ u - np.eye(12)).max() < 1e-13 and np.abs(u @ a - a @ u).max() < 1e-12
    assert (np.linalg.eigvalsh(u @ a) > 0).all()
