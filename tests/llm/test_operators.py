"""Edge cases and brute-force versions of the operators; the registered SQL is compared by the driver."""

import hashlib
import re
import string
import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from starloom.llm import decontaminate, licences, line_rules, lm_scoring, near_dup, pii_crf, piece_viterbi, quality_svm
from starloom.llm import queries, token_counts, token_files
from starloom.session import work_folder

BYTES, WORDS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
INK = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern=PLAIN):
    return pattern.findall((text or "").translate(LOWER))


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_token_counts(docs, empty):
    lib = token_counts.tokenizer(BYTES)
    want = [(i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in texts_of(docs)]
    assert pairs(token_counts.count_tokens(docs, BYTES), "doc_id", "n_bytes", "n_tokens") == sorted(want, key=str)
    assert token_counts.count_tokens(empty, BYTES).count() == 0


def test_token_files(spark, docs, empty):
    lib, folder = token_counts.tokenizer(WORDS), work_folder(spark)
    token_files.write_ids(docs, folder, WORDS, end_id=2)
    ordered = sorted(texts_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start, stream = [], 0, []
    for i, t in ordered:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start, stream = start + len(ids), stream + ids
    assert pairs(token_files.read_documents(spark, folder), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)
    assert token_files.read_ids(spark, folder, 5, 4000) == stream[5:4000]
    other = work_folder(spark)
    token_files.write_ids(empty, other, WORDS, end_id=2)
    assert token_files.read_documents(spark, other).count() == 0


@pytest.mark.parametrize("width", [1, 5, 15, 16, 17])
def test_packed_ids_are_read_from_anywhere(width):
    ids = np.random.default_rng(1).integers(0, 1 << width, 999).astype(np.uint32)
    packed = token_files.pack(ids, width)
    assert len(packed) == (999 * width + 7) // 8
    assert (token_files.unpack(packed, width, 333, 721) == ids[333:721]).all()


def brute_components(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return {i: (len(s), label[i]) for i, s in sets.items()}


def test_near_duplicates(spark, docs, empty):
    base = [f"t{i}" for i in range(60)]
    more = [(100 + k, " ".join(base[:k] + ["new"] + base[k + 1 :])) for k in range(0, 60, 4)]
    more += [(200 + k, " ".join(base[: 60 - k])) for k in range(0, 40, 3)]
    rows = docs.select("doc_id", "text", "bucket").union(spark.createDataFrame([(i, t, "b") for i, t in more], "doc_id bigint, text string, bucket string"))
    found = near_dup.link_documents(rows, words=4, percent=80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect() if r.doc_id is not None}
    assert got == brute_components([r for r in texts_of(rows) if r[0] is not None], 4, 80)
    lonely = found.filter("doc_id IS NULL").first()
    assert lonely.component_id is None and lonely.kept
    kept = near_dup.keep_one_of_each(docs)
    assert kept.columns == docs.columns and 5 not in [r.doc_id for r in kept.collect()]
    assert near_dup.link_documents(empty).count() == 0


def test_whole_sketches_never_differ_more_than_the_sets():
    texts = [" ".join(f"a{i + k}" for i in range(300)) for k in range(0, 120, 7)]
    sets, first = near_dup.shingles(pa.array(texts), 4)
    bits = np.unpackbits(near_dup._whole_sketches(sets, first).view(np.uint8), axis=1)
    parts = [set(sets[a:b].tolist()) for a, b in zip(first[:-1], first[1:], strict=True)]
    for i, x in enumerate(parts):
        for j, y in enumerate(parts):
            assert (bits[i] ^ bits[j]).sum() <= len(x ^ y)


def test_decontamination(spark, docs, empty):
    passage = " ".join(f"p{i}" for i in range(20))
    items = spark.createDataFrame([(1, passage), (2, "two three"), (3, None), (4, ""), (1, passage)], "item_id bigint, text string")
    more = spark.createDataFrame([(50, f"x y {passage} z"), (51, passage.upper()), (52, " ".join(passage.split()[:12]))], "doc_id bigint, text string")
    rows = docs.select("doc_id", "text").union(more)
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in decontaminate.contamination(rows, items).collect()}
    assert got[50] == (23, 20, ["1"], True) and got[51][1:] == (20, ["1"], True) and got[52][1:] == (0, [], False)
    assert got[3] == (3, 2, ["2"], True) and got[0] == (0, 0, [], False)
    assert all(got[i][0] == len(words(t, INK)) for i, t in texts_of(rows))
    index = decontaminate.build_index(more, items)
    assert 50 in {r.doc_id for r in decontaminate.proximity_matches(index, slack=3).collect()}
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.clean(docs, items).columns == docs.columns


def test_line_rules(spark, docs, empty):
    letters = string.ascii_lowercase  # digits are folded
    lines = [(300 + k, f"Shared Notice number {k % 10} here\n" + " ".join(f"u{letters[k % 26]}{letters[k // 26]}{letters[j % 26]}" for j in range(25))) for k in range(40)]
    more = spark.createDataFrame([(i, t, "en", "web", len(t), "b", "x") for i, t in lines], docs.schema)
    found = {r.doc_id: r for r in line_rules.verdicts(docs.union(more)).collect()}
    assert all(found[i].kept and found[i].left_words == found[i].n_words - 5 for i, _ in lines)
    assert found[8].base_failed and not found[8].kept and found[0].n_words == 0
    for i, t in texts_of(docs):
        w = PLAIN.findall(t or "")
        runs = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {p for k in range(len(w) - 4) if runs[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
        assert (found[i].n_words, found[i].word_chars, found[i].n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
    cleaned = line_rules.clean(docs.union(more))
    assert cleaned.columns == docs.columns
    assert cleaned.filter("text LIKE '%Shared Notice%'").count() == 0 and cleaned.filter("doc_id >= 300").count() == 40
    assert line_rules.verdicts(empty).count() == 0 and line_rules.clean(empty).count() == 0


def test_personal_data(docs, empty):
    found = {r.doc_id: r.spans for r in pii_crf.find_spans(docs).collect()}
    text = dict(texts_of(docs))[7]
    base = [(pii_crf.KINDS[s["kind"]], text[s["start"] : s["end"]]) for s in found[7] if s["base"]]
    assert base == [
        ("email", "jo.do@mail.example.com"), ("ip", "192.168.1.7"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 010-2030"),
    ]
    assert found[0] == [] and found[1] == []
    clean = pii_crf.redact(docs)
    assert clean.columns == docs.columns and "jo.do" not in {r.doc_id: r for r in clean.collect()}[7].text
    assert pii_crf.find_spans(empty).count() == 0


def test_messages_bring_repeated_tokens_in_line():
    node = np.array([[0.0, 3.0], [0.6, 0.5]])
    pair = np.log(np.array([[[0.45, 0.05], [0.05, 0.45]]]))
    joint = np.exp(node[0][:, None] + node[1][None] + pair[0])
    p = pii_crf.marginals(node, np.array([[0, 1]]), pair)
    assert np.allclose(p[1], joint.sum(0) / joint.sum(), atol=1e-3) and p[1].argmax() == 1


def test_the_random_field_learns_from_all_tokens(spark, docs, monkeypatch):
    copy = "part 1234567 of 77"
    texts = [copy] * 25_000 + [f"token: zq{k}abcdef{k}x password: Hx{k}kk99zz{k}" for k in range(40)] + ["pay 4111 1111 1111 1111 now"] * 3
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    seen = Counter()
    for b in pii_crf._examples([pa.RecordBatch.from_pydict({"text": texts})]):
        for r in b.to_pylist():
            seen[r["sort"], r["label"]] += r["n"]
    assert seen[0, 0] == 50_000 and seen[0, 5] == 80 and seen[0, 3] == 12 and seen[1, 3] == 9
    model = pii_crf.fit(rows)
    words = ["token:", "zq7abcdef7x", "part", "1234567"]
    node = [model[0][pii_crf._features(words, i)].sum(0).argmax() for i in (1, 3)]
    assert node == [5, 0] and model[1][3, 3] > 0

    monkeypatch.setattr(pii_crf, "STEPS", 5)  # the same steps in one task, and as a job each
    one = pii_crf.fit(rows)
    monkeypatch.setattr(pii_crf, "FITTED_ROWS", 10)
    many = pii_crf.fit(rows)
    assert all(np.allclose(a, b, rtol=1e-9, atol=1e-12) for a, b in zip(one, many, strict=True)) and one[0].any()


def test_words_and_passwords_are_read_whole(spark):
    long = "q" * 300
    assert pii_crf._features([f"{long}7", "x"], 0) != pii_crf._features([f"{long}q7k7", "x"], 0)
    letters = "Nothing else here. password: horsebatterystaple and the secret: persistence"
    texts = [f"token: zq{k}abcdef{k}x ok" for k in range(40)] + [f"pwd={'abcdefghij'[k:] * 3} ok 77" for k in range(5)]
    texts += [letters, 'key: 24bead0c24bead0c24bead0c24beadff"### end']
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: [(pii_crf.KINDS[s["kind"]], texts[r.doc_id][s["start"] : s["end"]]) for s in r.spans] for r in pii_crf.find_spans(docs).collect()}
    assert found[45] == [("secret", "horsebatterystaple")]
    assert found[46] == [("secret", "24bead0c24bead0c24bead0c24beadff")]
    assert found[40] == [("secret", "abcdefghij" * 3)]


def test_spans_do_not_depend_on_neighbours_and_hubs_reach_far():
    """The first of 60 like tokens has the evidence; other documents of the slice change no number."""
    n, same = 60, np.log(np.array([[0.49, 0.01], [0.01, 0.49]]))
    node = np.zeros((n + 1, 2))
    node[0, 1] = 9.0
    edges = np.array([(i, n) for i in range(n)])
    p = pii_crf.marginals(node, edges, np.repeat(same[None], n, 0))
    assert (p[:, 1] > 0.9).all()
    more = np.random.default_rng(1).normal(0, 3, (4, 2))
    cycle = np.array([(0, 1), (1, 2), (2, 3), (3, 0)])
    both = pii_crf.marginals(
        np.concatenate([node, more]), np.concatenate([edges, cycle + n + 1]),
        np.repeat(same[None], n + 4, 0), np.repeat([0, 1], [n + 1, 4]),
    )
    alone = pii_crf.marginals(more, cycle, np.repeat(same[None], 4, 0))
    assert (both[: n + 1] == p).all() and (both[n + 1 :] == alone).all()


def _spans_plainly(text):
    """The fixed patterns as the contract words them."""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 16 <= len(d) <= 19 and sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_the_query_of_personal_data_against_plain_patterns(spark, docs):
    folder = "/root/testdata/sf0.001"
    texts = dict(texts_of(spark.read.parquet(f"{folder}/documents.parquet")))
    rows = {r.doc_id: r for r in queries.QUERIES["op7_personal_data"](spark, folder).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        base = _spans_plainly(text or "")
        kinds = Counter(kind for kind, _, _ in base)
        r = rows[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
        spans = [f"{kind}:{a}:{z}" for kind, a, z in base]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r.spans.split(","))


def test_patterns_stay_fast_on_long_runs():
    assert pii_crf.base_spans("a" * 300_000 + " x@y.zz " + "1" * 100_000)[0][0] == 0


def test_licences(docs, empty):
    found = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert found[7].labels == ["mit"] and found[7].base[0]["at"] == 1 and found[7].score == 1
    assert found[0].labels == [] and found[0].score == 0 and found[0].n_words == 0
    assert all(found[i].n_words == len(words(t, INK)) for i, t in texts_of(docs))
    assert licences.scan(empty).count() == 0


def test_templates_find_reworded_notices(spark, docs):
    rows = [(1, "x " * 50 + "This work is licensed under the GNU General Public License, version 3."), (2, "general public version of a license")]
    found = {r.doc_id: r.labels for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {1: ["gpl-3"], 2: []}


def test_no_notice_is_lost_to_rarer_words_of_another(spark, docs):
    mit = next(t for label, t, _ in licences.TEMPLATES if label == "mit" and len(t) > 100)
    cases = [(text, label) for label, text, _ in licences.TEMPLATES]
    rows = [(i, f"{mit}. filler words stand here\n{text}") for i, (text, _) in enumerate(cases)]
    common = "released under the license, licensed 4 0 cc version public general gnu terms creative commons international"
    rows += [(1000 + i, common) for i in range(40)]
    found = {r.doc_id: r.labels for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all({"mit", label} <= set(found[i]) for i, (_, label) in enumerate(cases))
    assert all(len(anchor[2]) >= 2 for anchor in licences._anchors())


def test_pieces(docs, empty):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coded = piece_viterbi.decode(piece_viterbi.encode(docs, PIECES), PIECES)
    for r in coded.collect():
        assert r.ids == lib.encode(r.text or "")
        assert r.decoded == (r.text or "").replace(piece_viterbi.SPACE, " ")
    assert coded.columns == [*docs.columns, "ids", "decoded"] and piece_viterbi.encode(empty, PIECES).count() == 0
    with pytest.raises(ValueError):
        piece_viterbi.encode(coded, PIECES)


def test_long_words_have_the_pieces_of_the_library():
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcde ē日"), n)) for n in (1, 30, 199, 200, 201, 900)] + ["a" * 5000]
    ids, at = piece_viterbi.encode_texts(PIECES, pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == lib.encode(texts)


def test_quality(spark, docs, empty):
    rng = np.random.default_rng(3)
    good = [" ".join(rng.choice(["the", "river", "of", "stone", "was", "cold"], 40)) for _ in range(120)]
    bad = [" ".join(w + "###" for w in rng.choice(["buy", "now", "cheap"], 40)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    labels = spark.createDataFrame([(i, int(i < 120)) for i, _ in rows], "doc_id bigint, quality int")
    train = F.col("doc_id") % 3 != 0
    found = quality_svm.score_quality(spark.createDataFrame(rows, "doc_id bigint, text string"), labels, train).collect()
    assert all((r.score > 0.5) == (r.doc_id < 120) for r in found)
    alone = quality_svm.score_quality(docs, labels.limit(0), train).collect()
    assert len(alone) == docs.count() and all(r.score == 0.5 for r in alone)
    assert quality_svm.score_quality(empty, labels, train).count() == 0


def test_dual_coordinate_descent_meets_its_conditions(monkeypatch):
    monkeypatch.setattr(quality_svm, "EPOCHS", 400)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.where(x[:, 0] + 0.1 * rng.normal(size=80) > 0, 1.0, -1.0)
    w = quality_svm.dual_coordinate_descent(x.reshape(-1), np.tile(np.arange(5), 80), np.arange(0, 401, 5), y, 5)

    def loss(v):
        return 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v[:5] + v[5])).sum()

    assert all(loss(w) <= loss(w + rng.normal(0, 0.1, 6)) + 1e-2 for _ in range(200))


def test_lm_scores(docs, empty):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0
    args = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50_256)
    found = {(r.doc_id): r for r in lm_scoring.score_texts(docs, held, *args).collect()}
    counts = Counter()
    for i, t in texts_of(docs):
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            counts.update([*words(t), None])
    total = sum(counts.values())
    for i, t in texts_of(docs):
        w = [*words(t), None]
        base = sum(log10((counts[x] + 0.1) / (total + 0.1 * (len(counts) + 1))) for x in w)
        assert found[i].n_tokens == len(w) and found[i].train_tokens == total and found[i].n_known == sum(counts[x] > 0 for x in w)
        assert found[i].base_score == pytest.approx(base) and found[i].score < 0
    assert lm_scoring.score_texts(empty, held, *args).count() == 0


def test_every_word_of_a_long_text_is_learned_from():
    subwords = lm_scoring.Subwords(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50_256)
    texts = ["", "a b c", None, " ".join(f"w{k % 7} the of" for k in range(400)), "x " * 31, "x " * 32, "x " * 33]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "learn": pa.array([True] * len(texts))})
    rows = [r for b in lm_scoring._gathered(subwords)([batch]) for r in b.to_pylist()]
    windows = [np.frombuffer(r["window"], lm_scoring._stored_id(50_257)).tolist() for r in rows if r["kind"] == 2]
    pairs = Counter(p for w in windows for p in zip(w, w[1:]))
    first = {w: subwords.words(pa.RecordBatch.from_pydict({"text": [w]}))[1] for t in texts for w in words(t)}
    expected = Counter()
    for t in texts:
        ids = [subwords.size, *(int(subwords.ids(first[w])[0][0]) for w in words(t)), subwords.size]
        expected.update(zip(ids, ids[1:]))
    assert pairs == expected and sum(pairs.values()) == sum(r["n"] for r in rows if r["kind"] == 0)


def test_every_id_of_every_word_is_in_the_windows():
    subwords = lm_scoring.Subwords(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50_256)
    texts = ["", "unbelievably tokenization", None, " ".join(f"antidisestablishment{k % 7} of" for k in range(40)), "x " * 33]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "learn": pa.array([True] * len(texts))})
    rows = [r for b in lm_scoring._gathered(subwords)([batch]) for r in b.to_pylist()]
    windows = [np.frombuffer(r["window"], lm_scoring._stored_id(50_257)).tolist() for r in rows if r["kind"] == 2]
    encoding = lm_scoring._encoding(*(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))[0]
    expected = Counter()
    for t in texts:
        ids = [subwords.size, *(i for w in words(t) for i in encoding.encode_ordinary(f" {w}")), subwords.size]
        expected.update(zip(ids, ids[1:]))
    assert Counter(p for w in windows for p in zip(w, w[1:])) == expected
    assert any(len(encoding.encode_ordinary(f" {w}")) > 1 for t in texts for w in words(t))


def test_gradient_of_the_id_level_is_that_of_the_loss():
    rng = np.random.default_rng(3)
    n = (2, lm_scoring.WINDOW)
    c, y = (rng.integers(0, lm_scoring.CLASSES, n) for _ in range(2))
    bucket = rng.integers(0, lm_scoring.BUCKETS, n)
    spread = rng.random((lm_scoring.CLASSES, lm_scoring.BUCKETS)).astype(np.float32)
    weight = (rng.random(n) * (np.arange(n[1]) < [[9], [32]])).astype(np.float32)
    bigram = rng.normal(size=(lm_scoring.CLASSES,) * 2).astype(np.float32)
    w, gradient = lm_scoring._start(), lm_scoring.Gradient(2)
    _, got = gradient(w, bigram, c, y, weight, (bucket, spread))
    assert np.abs(lm_scoring._named(got)["G"]).sum() > 0
    for name, part in lm_scoring._named(got).items():
        direction = np.zeros_like(w)
        lm_scoring._named(direction)[name][:] = rng.normal(size=part.shape) * 0.01
        up, down = (gradient(w + s * direction, bigram, c, y, weight, (bucket, spread))[0] for s in (1, -1))
        assert (up - down) / 2 == pytest.approx(float((got * direction).sum()), rel=0.02, abs=2e-4), name


def test_ids_in_a_class_sum_to_one_whatever_the_context():
    rng = np.random.default_rng(6)
    model = rng.normal(size=(lm_scoring.CLASSES,) * 2).astype(np.float32), lm_scoring._start()
    lm_scoring._named(model[1])["G"][:] = rng.normal(size=(lm_scoring.WIDTH, lm_scoring.BUCKETS))
    counts = rng.integers(0, 50, 300).astype(float)
    classes, share = lm_scoring.class_table(counts)
    spread = np.zeros((lm_scoring.CLASSES, lm_scoring.BUCKETS))
    np.add.at(spread, (classes, np.arange(300) % lm_scoring.BUCKETS), 10**share)
    second = spread.astype(np.float32), (share * np.log(10)).astype(np.float32)
    prefix = rng.integers(0, 300, 20)
    total = 0.0
    for last in range(300):
        ids = np.append(prefix, last)
        got = lm_scoring._predicted(model, classes[ids], np.array([0, 21]), classes[-1], (ids, *second))
        total += 10 ** float(got[-1])
    assert total == pytest.approx(1, rel=1e-4)


def test_words_have_the_ids_they_have_alone(monkeypatch):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    subwords, (encoding, _, cached) = lm_scoring.Subwords(path, pattern, 50_256), lm_scoring._encoding(path, pattern)
    monkeypatch.setattr(cached, "limit", 40)  # entries go while others are still wanted
    rng = random.Random(4)
    for _ in range(60):
        text = " ".join("".join(rng.choice("ab é\x00\x1c\x85\u00a0\u3000's12,.#<|>漢🙂\u200b_-") for _ in range(rng.randint(1, 8))) for _ in range(20))
        keys, found, at, _ = subwords.words(pa.RecordBatch.from_pydict({"text": ["", text, text[::-1]]}))
        ids, sizes = subwords.ids(found)
        each = [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]
        wanted = [encoding.encode_ordinary(f" {w}") for t in (text, text[::-1]) for w in words(t)]
        assert [each[i] for i in at] == wanted and len(each) == len(keys)


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(2)
    n = (3, lm_scoring.WINDOW)
    c, y = (rng.integers(0, lm_scoring.CLASSES, n) for _ in range(2))
    weight = (rng.random(n) * (np.arange(n[1]) < [[5], [32], [1]])).astype(np.float32)
    bigram = rng.normal(size=(lm_scoring.CLASSES,) * 2).astype(np.float32)
    w, gradient = lm_scoring._start(), lm_scoring.Gradient(3)
    _, got = gradient(w, bigram, c, y, weight)
    for name, part in lm_scoring._named(got).items():
        direction = np.zeros_like(w)
        lm_scoring._named(direction)[name][:] = rng.normal(size=part.shape) * 0.01
        up, down = (gradient(w + s * direction, bigram, c, y, weight)[0] for s in (1, -1))
        assert (up - down) / 2 == pytest.approx(float((got * direction).sum()), rel=0.02, abs=2e-4), name


def test_windows_give_every_class_once_with_all_its_context():
    rng = np.random.default_rng(5)
    model = rng.normal(size=(lm_scoring.CLASSES,) * 2).astype(np.float32), lm_scoring._start()
    c = rng.integers(0, lm_scoring.CLASSES, 100)
    got = lm_scoring._predicted(model, c, np.array([0, 100]), 0)
    p, n = lm_scoring._named(model[1]), lm_scoring.WINDOW
    before = np.append(0, c[:-1])
    for t in (0, 5, n - 1, n, 60, 99):
        turn = max(0, -(-(t + 1 - n) // (n - lm_scoring.CONTEXT)))
        low = turn * (n - lm_scoring.CONTEXT)
        x = p["E"][before[low : t + 1]] + p["P"][: t + 1 - low]
        s = (x @ p["Q"])[-1] @ (x @ p["K"]).T / 4
        a = np.exp(s) / np.exp(s).sum()
        z = np.tanh(a @ (x @ p["V"]) @ p["O"] + x[-1] @ p["X"]) @ p["U"] + model[0][before[t]]
        assert got[t] == pytest.approx((z[c[t]] - np.log(np.exp(z).sum())) / np.log(10), abs=1e-4)
