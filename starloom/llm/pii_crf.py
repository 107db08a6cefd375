"""Personal data: fixed patterns, and a skip-chain conditional random field that adds what they miss.

Patterns give base spans. The nodes of a conditional random field are the words with a digit or ``@``, and words of letters
that stand where a password or key is named; labels are the kinds, ``secret`` for keys and passwords, and none.
Neighbouring nodes share chain potentials. Tokens of one document that repeat or have the same digits share skip
potentials with a variable of their own, a hub, so any two of them are two steps apart and edges grow with the tokens, not
with their square. Loopy message passing, damped, brings the labels of a document in line: a number that is a phone number
in one place is one in the other. It ends for each document when that document settles, or after ``ROUNDS`` rounds with
the labels of the last one, so no result depends on which documents share a slice. Confident labels outside base spans
become spans of their own.

Node weights are fitted by logistic regression and pair potentials by counting, on all candidate tokens of all texts;
their labels come from the patterns and from key names that stand before a value. Tokens of the same features and label
are one row with a count, summed per task and then in a shuffle, and pairs of labels are 36 counts of each sort of edge,
so copies cost nothing and crowd nothing out. The gradient is that of all rows in every step: up to ``FITTED_ROWS`` rows
one task takes all steps, beyond that each step is a Spark job that sums the gradients of parts of the rows. Both give
the same weights but for rounding.

Edge cases: a null or empty text has no spans; very long texts and words are read whole, one at a time; repeated rows
give a row each; ties between labels go to the earlier kind; without candidate tokens to learn from only base spans are
returned; an empty table gives an empty result; ``redact`` passes all other columns through, ``find_spans`` reads only
``doc_id`` and ``text``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.text import flat, slices
from starloom.session import materialize, work_folder

KINDS = ("email", "ip", "card", "phone", "secret")
FITTED_ROWS = 20_000
CONFIDENT = 0.9
ROUNDS, STEPS = 200, 200
_PLACES = 1024

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_KEY_NAMES = frozenset("token secret password passwd pwd key apikey api_key auth credential bearer".split())
_CONTEXT = _KEY_NAMES | frozenset("phone tel telephone mobile fax call mail email contact card visa account ip host server addr address".split())
_ASSIGNED = re.compile(r"(?i)^\W*(?:\w*(?:token|secret|passw(?:or)?d|pwd|api_?key))[=:](.+)$")
_LETTERS_NAMED = r"(?:(?:passw(?:or)?d|passphrase|pwd|api_?key)\W?[:=]|(?:secret|token)\W?=)"
_NAMED = re.compile(rf"(?i){_LETTERS_NAMED}")
_NAMED_BEFORE = re.compile(rf"(?i){_LETTERS_NAMED}$")
_NAMED_INSIDE = re.compile(rf"(?i)^\W*\w*{_LETTERS_NAMED}\W*\w{{8,}}")
_ACCESS_KEY = re.compile(r"^\W*AKIA[0-9A-Z]{16}\W*$")

_CANDIDATE = np.zeros(256, bool)
_CANDIDATE[48:58] = True
_CANDIDATE[64] = True
_ASSIGNS = np.zeros(256, bool)
_ASSIGNS[[58, 61]] = True

Span = tuple[int, int, int]  # kind, start, end


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Goes from one at sign to the next, so that a long run of other characters is read once."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def _shape(word: str) -> str:
    """Runs of digits, capitals, letters and other characters; of words with many runs only the sorts."""
    kinds = ("9" if c in "0123456789" else "A" if c.isupper() else "a" if c.isalpha() else c for c in word)
    out = [c for c, _ in groupby(kinds)]
    return "".join(out) if len(out) <= 8 else f"many {''.join(sorted(set(out)))}"


def _of_letters(words: list[str], i: int) -> bool:
    """Whether a word without digit or at sign stands where a password or key is named."""
    w = words[i]
    if re.search("[0-9@]", w):
        return False
    return bool(_NAMED_INSIDE.match(w) or (i and len(w) >= 8 and _NAMED_BEFORE.search(words[i - 1])))


def _features(words: list[str], i: int) -> list[int]:
    w = words[i]
    p1, p2 = (words[i - 1] if i else ""), (words[i - 2] if i > 1 else "")
    digits = sum(c in "0123456789" for c in w)
    letters = sum(c.isalpha() for c in w)
    core = re.sub(r"[^0-9A-Za-z]", "", w)
    names = ["bias", f"shape {_shape(w)}", f"size {min(len(w), 48) // 3}", f"digits {min(digits, 24) // 2}"]
    if _of_letters(words, i):
        names.append("named letters")
    names += [f"has {c}" for c in '@.:="(+-' if c in w]
    if core and re.fullmatch(r"[0-9a-f]+", core) and letters > 2:
        names.append("hex")
    if digits > 2 and letters > 2:
        names.append("mixed")
    if core.isupper() and digits and letters > 3:
        names.append("capitals")
    names.append(f"before {_shape(p1)}")
    names += [f"{n} {x}" for n, p in (("one", p1), ("two", p2)) if (x := re.sub(r"\W", "", p.lower())) in _CONTEXT]
    return sorted({zlib.crc32(n.encode()) % _PLACES for n in names})


def _tokens(text: str) -> tuple[list[str], list[int], list[tuple[int, int]]]:
    """All words, the numbers of the candidate words, and their places."""
    words, nodes, at = [], [], []
    named = _NAMED.search(text)
    for i, m in enumerate(_WORD.finditer(text)):
        words.append(m[0])
        if re.search("[0-9@]", m[0]) or (named and _of_letters(words, i)):
            nodes.append(i)
            at.append((m.start(), m.end()))
    return words, nodes, at


def _edges(words: list[str], nodes: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """Chain edges between neighbouring words; the tokens of each hub."""
    chain = [(k, k + 1) for k, (i, j) in enumerate(pairwise(nodes)) if j == i + 1]
    alike: dict[str, list[int]] = {}
    for k, i in enumerate(nodes):
        core = re.sub(r"[^0-9a-z]", "", words[i].lower())
        digits = re.sub(r"[^0-9]", "", core)
        for key in {core if len(core) > 3 else "", digits if len(digits) > 5 else ""} - {""}:
            alike.setdefault(key, []).append(k)
    return chain, sorted({tuple(tokens) for tokens in alike.values() if len(tokens) > 1})


def _weak_label(words: list[str], i: int, place: tuple[int, int], base: list[Span]) -> int:
    """0 for none, else 1 + kind."""
    for kind, a, b in base:
        if a < place[1] and place[0] < b:
            return kind + 1
    if _of_letters(words, i):
        return 5
    before = [re.sub(r"\W", "", w.lower()) for w in words[max(0, i - 2) : i]]
    named = len(words[i]) > 8 and i and words[i - 1][-1] in "=:" and bool(_KEY_NAMES & set(before))
    return 5 if named or _ASSIGNED.match(words[i]) or _ACCESS_KEY.match(words[i]) else 0


def _with_candidates(b: pa.RecordBatch) -> Iterator[tuple[int, str]]:
    """Number and text of the rows that have a digit, an at sign or a named password; the patterns match in no others."""
    buf, offsets = flat(b.column("text"))
    sure, maybe = (np.diff(np.append(0, np.cumsum(x[buf], dtype=np.int64))[offsets]) > 0 for x in (_CANDIDATE, _ASSIGNS))
    for i in np.flatnonzero(sure | maybe).tolist():
        text = b.column("text")[i].as_py()
        if sure[i] or _NAMED.search(text):
            yield i, text


_COUNTED = "sort int, places array<int>, `first` int, label int, n bigint"


def _examples(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the tokens have features (sort 0) and a label, and chain (1) and skip (2) edges have a pair of labels.

    The label of a hub is the most frequent one of its tokens.
    """
    types = (pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int64())

    def rows():
        columns = zip(*((*key, n) for key, n in counts.items()), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["sort", "places", "first", "label", "n"])

    counts: Counter = Counter()
    for b in slices(batches):
        for _, text in _with_candidates(b):
            base = base_spans(text)
            words, nodes, at = _tokens(text)
            label = [_weak_label(words, i, p, base) for i, p in zip(nodes, at, strict=True)]
            counts.update((0, tuple(_features(words, i)), 0, y) for i, y in zip(nodes, label, strict=True))
            chain, hubs = _edges(words, nodes)
            counts.update((1, (), label[i], label[j]) for i, j in chain)
            for hub in hubs:
                most = int(np.bincount([label[i] for i in hub]).argmax())
                counts.update((2, (), label[i], most) for i in hub)
        if len(counts) > 1 << 16:
            yield rows()
            counts.clear()
    if counts:
        yield rows()


class _Rows:
    """Rows of places, a label and a count, for gradients of the log loss."""

    def __init__(self, places: list, y: list, times: list):
        self.at = np.concatenate(places)
        row = np.repeat(np.arange(len(y)), [len(p) for p in places])
        self.starts = np.flatnonzero(np.diff(row, prepend=-1))
        self.target, self.times = np.eye(len(KINDS) + 1)[y], np.array(times, float)
        order = np.argsort(self.at, kind="stable")
        self.used, self.first = np.unique(self.at[order], return_index=True)
        self.row = row[order]
        self.tokens = np.add.reduceat(self.times[self.row], self.first)

    def gradient(self, w: np.ndarray) -> np.ndarray:
        """Of the weights of the places in ``used``."""
        z = np.add.reduceat(w[self.at], self.starts)
        z = np.exp(z - z.max(1, keepdims=True))
        miss = (z / z.sum(1, keepdims=True) - self.target) * self.times[:, None]
        return np.add.reduceat(miss[self.row], self.first)


def weights(gradient) -> np.ndarray:
    """Logistic regression by gradient steps with momentum: weights (place x label).

    ``gradient`` takes weights and returns the places in use, their tokens, and the summed gradient of their weights.
    """
    w, speed = np.zeros((_PLACES, len(KINDS) + 1)), np.zeros((_PLACES, len(KINDS) + 1))
    for _ in range(STEPS):
        used, tokens, sums = gradient(w)
        grad = 1e-4 * w
        grad[used] += sums / np.maximum(tokens, 1)[:, None]
        speed = 0.9 * speed - 0.1 * grad
        w += speed
    return w


def _rows_of(batch: pa.RecordBatch) -> _Rows:
    return _Rows(*(batch.column(c).to_pylist() for c in ("places", "label", "n")))


def _placed(used: np.ndarray, tokens: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    edge = np.arange(len(used) + 1, dtype=np.int32) * values.shape[1]
    lists = pa.ListArray.from_arrays(edge, pa.array(values.reshape(-1)))
    return pa.RecordBatch.from_arrays([pa.array(used), pa.array(tokens), lists], ["place", "tokens", "w"])


_PLACED = "place bigint, tokens double, w array<double>"


def _fitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All steps in one task."""
    parts = [b for b in batches if len(b)]
    if parts:
        rows = _rows_of(pa.Table.from_batches(parts).combine_chunks().to_batches()[0])
        w = weights(lambda w: (rows.used, rows.tokens, rows.gradient(w)))
        yield _placed(rows.used, rows.tokens, w[rows.used])


def _partial(w: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                rows = _rows_of(b)
                yield _placed(rows.used, rows.tokens, rows.gradient(w))

    return run


def _node_weights(nodes: DataFrame) -> np.ndarray | None:
    """Of the counted rows of features and label; None without any."""
    spark, n = nodes.sparkSession, len(KINDS) + 1
    parts = -(-nodes.count() // FITTED_ROWS)
    if not parts:
        return None
    w = np.zeros((_PLACES, n))
    if parts == 1:
        # Sorted, so that sums have the same order whichever task wrote its rows first.
        for r in nodes.repartition(1).sortWithinPartitions("places", "label").mapInArrow(_fitted, _PLACED).collect():
            w[r["place"]] = r["w"]
        return w
    dealt = materialize(nodes.repartition(parts, "places", "label"), work_folder(spark))

    def gradient(w: np.ndarray):
        sums = dealt.mapInArrow(_partial(w), _PLACED).groupBy("place")
        sums = sums.agg(F.sum("tokens").alias("tokens"), *[F.sum(F.col("w")[k]).alias(f"w{k}") for k in range(n)]).toPandas()
        return sums["place"].to_numpy(), sums["tokens"].to_numpy(), sums[[f"w{k}" for k in range(n)]].to_numpy()

    return weights(gradient)


def fit(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Node weights (place x label), chain and skip potentials (label x label)."""
    spark, n = docs.sparkSession, len(KINDS) + 1
    counted = docs.select("text").mapInArrow(_examples, _COUNTED).groupBy("sort", "places", "first", "label").agg(F.sum("n").alias("n"))
    counted = materialize(counted, work_folder(spark))
    w = _node_weights(counted.filter("sort = 0").select("places", "label", "n"))
    if w is None:
        return None
    pairs = np.zeros((3, n, n))
    for r in counted.filter("sort > 0").collect():  # 72 rows at most
        pairs[r["sort"], r["first"], r["label"]] = r["n"]

    def potential(counts: np.ndarray, agree: float) -> np.ndarray:
        share = counts + 1 + agree * np.eye(n)
        share /= share.sum()
        return 0.5 * np.log(share / (share.sum(1, keepdims=True) * share.sum(0)))

    return w, potential(pairs[1], 0.0), potential(pairs[2], 50.0)


def marginals(node: np.ndarray, edges: np.ndarray, pair: np.ndarray, doc: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities by damped loopy message passing, until the document of a node (``doc``) has settled.

    ``pair`` holds the log potential of each edge.
    """
    node = node - node.max(1, keepdims=True)
    if len(edges):
        doc = np.zeros(len(node), np.int64) if doc is None else doc
        src = np.concatenate([edges[:, 0], edges[:, 1]])
        dst = np.concatenate([edges[:, 1], edges[:, 0]])
        both = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.roll(np.arange(len(src)), len(edges))
        sent = np.zeros((len(src), node.shape[1]))
        live = np.arange(len(src))
        for _ in range(ROUNDS):
            belief = node.copy()
            np.add.at(belief, dst[live], sent[live])
            out = (belief[src[live]] - sent[back[live]])[:, :, None] + both[live]
            top = out.max(1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
            new -= new.max(1, keepdims=True)
            change = np.zeros(doc[-1] + 1)
            np.maximum.at(change, doc[src[live]], np.abs(new - sent[live]).max(1))
            sent[live] = 0.5 * sent[live] + 0.5 * new
            live = live[change[doc[src[live]]] >= 1e-3]
            if not len(live):
                break
        belief = node.copy()
        np.add.at(belief, dst, sent)
        node = belief
    p = np.exp(node - node.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _trimmed(text: str, start: int, end: int, kind: int) -> tuple[int, int]:
    if KINDS[kind] == "secret" and (m := _ASSIGNED.match(text[start:end])):
        start += m.start(1)
    while start < end and text[start] in "\"'`([{<":
        start += 1
    while end > start and text[end - 1] in "\"'`)]}>,.;:!?#*":
        end -= 1
    return start, end


def label_batch(model, b: pa.RecordBatch) -> tuple[list[list[Span]], dict[int, list[Span]]]:
    """All spans of each row by kind and start, and the base spans of the rows that may have some."""
    found: list[list[Span]] = [[] for _ in range(len(b))]
    base, graphs, places, sizes, tokens, edges, kinds, docs, n = {}, [], [], [], [], [], [], [], 0
    for row, text in _with_candidates(b):
        base[row] = found[row] = base_spans(text)
        if model is None:
            continue
        words, nodes, at = _tokens(text)
        chain, hubs = _edges(words, nodes)
        graphs.append((row, text, nodes, at, n))
        for i in nodes:
            f = _features(words, i)
            places += f
            sizes.append(len(f))
        tokens += range(n, n + len(nodes))
        skip = [(i + n, n + len(nodes) + h) for h, hub in enumerate(hubs) for i in hub]
        edges += [(a + n, c + n) for a, c in chain] + skip
        kinds += [0] * len(chain) + [1] * len(skip)
        n += len(nodes) + len(hubs)
        docs += [len(graphs) - 1] * (len(nodes) + len(hubs))
    if n:
        weights, *pairs = model
        node = np.zeros((n, len(KINDS) + 1))
        node[tokens] = np.add.reduceat(weights[places], np.cumsum(sizes) - sizes)
        pair = np.array(pairs)[kinds] if kinds else np.zeros((0, len(KINDS) + 1, len(KINDS) + 1))
        p = marginals(node, np.array(edges).reshape(-1, 2), pair, np.array(docs))
        label, sure = p.argmax(1), p.max(1)
        for row, text, nodes, at, offset in graphs:
            added: list[list[int]] = []
            for k, (i, (start, end)) in enumerate(zip(nodes, at, strict=True)):
                kind = int(label[offset + k]) - 1
                if kind < 0 or sure[offset + k] < CONFIDENT or any(a < end and start < z for _, a, z in base[row]):
                    continue
                if added and added[-1][0] == kind and added[-1][3] == i - 1 and kind == 3:
                    added[-1][2:] = [end, i]
                else:
                    added.append([kind, start, end, i])
            more = [(kind, *_trimmed(text, a, z, kind)) for kind, a, z, _ in added]
            found[row] = sorted(base[row] + [s for s in more if s[1] < s[2]])
    return found, base


_SPANS = "array<struct<kind:int,start:bigint,`end`:bigint,base:boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def _found(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            found, base = label_batch(shared.value, b)
            for i, spans in enumerate(found):
                fixed = set(base.get(i, ()))
                rows.append([{"kind": k, "start": a, "end": z, "base": (k, a, z) in fixed} for k, a, z in spans])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, _ARROW)], ["doc_id", "spans"])

    return run


def _redacted(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            for i, spans in enumerate(label_batch(shared.value, b)[0]):
                out, at = [], 0
                for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
                    if start >= at:
                        out += [texts[i][at:start], f"<{KINDS[kind].upper()}>"]
                    at = max(at, end)
                if spans:
                    texts[i] = "".join([*out, texts[i][at:]])
            at = b.schema.get_field_index("text")
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    return run


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (kind as a number of ``KINDS``, start, end in characters, base) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_found(shared), f"doc_id {kind}, spans {_SPANS}")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind; ``n_chars``, if there is such a column, is counted again."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    out = docs.mapInArrow(_redacted(shared), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out
