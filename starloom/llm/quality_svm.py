"""Quality classifier: naive Bayes support vectors.

N-gram indicators (byte trigrams, and n-grams of word shapes, which mark capitals, symbols, digits and repetition) are
hashed into ``FEATURES`` places. Each is scaled by the log ratio of its counts in the two classes, rows get unit length,
and a linear hinge-loss model is fitted by dual coordinate descent; a sigmoid fitted on rows the model has not seen
turns margins into probabilities.

The model is fitted on a bounded sample: the ``SAMPLE_ROWS`` labelled training rows of smallest id hash. The sample's
ids are the only thing that is broadcast besides the weights (fixed size), so no text is shuffled. Scoring covers every
whole text and reads nothing but the text.

Edge cases: a null text is empty and gets the score of no features; labels that are null, repeated or without a
document are left out or counted once; with no labels, or only one class, the score is the share of label 1 (0.5 without
any); repeated rows give a row each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.text import PLAIN, distinct, expand, flat, hashes, mix, slices, spans

FEATURES = 1 << 18
SAMPLE_ROWS = 20_000
SMOOTHING, COST, EPOCHS, FOLD = 1.0, 1.0, 12, 5

_STEP = np.uint64(0x9E3779B97F4A7C15)
_KINDS = np.zeros((4, 256), bool)
_KINDS[0, 97:123] = True
_KINDS[1, 65:91] = True
_KINDS[2, 48:58] = True
_KINDS[3, list(b"#*$%&|<>!{}[]~^=@_\\/")] = True


def _place(keys: np.ndarray) -> np.ndarray:
    return (mix(keys) >> np.uint64(46)).astype(np.int64)


def _shapes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A small code per word: which kinds of characters it has, whether it is capitals only, whether it repeats."""
    code = np.zeros(len(starts), np.uint64)
    counts = []
    for k in range(4):
        total = np.append(0, np.cumsum(_KINDS[k][buf], dtype=np.int32))
        counts.append(total[ends] - total[starts])
    lower, upper, digit, symbol = counts
    size = ends - starts
    code |= (lower > 0).astype(np.uint64)
    code |= ((upper > 0) & (lower > 0)).astype(np.uint64) << np.uint64(1)
    code |= ((upper > 1) & (lower == 0)).astype(np.uint64) << np.uint64(2)
    code |= (digit > 0).astype(np.uint64) << np.uint64(3)
    code |= (symbol > 0).astype(np.uint64) << np.uint64(4)
    code |= (symbol == size).astype(np.uint64) << np.uint64(5)
    code |= (size > 20).astype(np.uint64) << np.uint64(6)
    # Whether the word and the two after it stood in this text before.
    h = hashes(buf, starts, ends)
    doc, place = expand(np.diff(first))
    after = np.concatenate([h, np.zeros(2, np.uint64)])
    key = mix(mix(h * _STEP + after[1:-1]) * _STEP + after[2:] + doc.astype(np.uint64))
    _, at, where = distinct(key[::-1])  # where: the last place in reversed order is the first in the text
    seen = (len(key) - 1 - where)[at][::-1]
    code |= (seen < np.arange(len(key))).astype(np.uint64) << np.uint64(7)
    return code


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct feature places of each text, and the first of each text (n + 1)."""
    buf, offsets = flat(column)
    n = len(offsets) - 1
    size = np.diff(offsets)
    three = buf[:-2].astype(np.uint64) | buf[1:-1].astype(np.uint64) << np.uint64(8) | buf[2:].astype(np.uint64) << np.uint64(16) if len(buf) > 2 else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(n), size)
    inside = doc[:-2] == doc[2:] if len(buf) > 2 else np.zeros(0, bool)
    keys, docs = [_place(three[inside])], [doc[:-2][inside]]
    starts, ends, first = spans(buf, offsets, PLAIN)
    if len(starts):
        code = _shapes(buf, starts, ends, first)
        word_doc, _ = expand(np.diff(first))
        gram = np.zeros(len(code), np.uint64)
        for k in range(3):
            gram = mix(gram[: len(code) - k] * _STEP + code[k:] + np.uint64(1 + k))
            whole = word_doc[: len(gram)] == word_doc[k:]
            keys.append(_place(gram[whole] ^ np.uint64(0xABCDEF)))
            docs.append(word_doc[: len(gram)][whole])
    both = np.concatenate(docs) * FEATURES + np.concatenate(keys)
    both.sort()
    both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
    return both & (FEATURES - 1), np.searchsorted(both, np.arange(n + 1) * FEATURES)


def _examples(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        found, first = features(b.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(found.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([b.column("label"), b.column("fold"), lists], ["label", "fold", "found"])


def dual_coordinate_descent(values: np.ndarray, places: np.ndarray, first: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Weights (the last is the bias) of the linear model of least hinge loss; rows have unit length."""
    w, alpha, rng = np.zeros(n + 1), np.zeros(len(y)), np.random.Generator(np.random.PCG64(7))
    square = np.array([values[a:b] @ values[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]) + 1
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            a, b = first[i], first[i + 1]
            at, x = places[a:b], values[a:b]
            slope = y[i] * (x @ w[at] + w[n]) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), COST)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * x
                w[n] += step
                alpha[i] = new
    return w


def _sigmoid(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps on the smoothed log loss."""
    target = np.where(y > 0, (np.sum(y > 0) + 1) / (np.sum(y > 0) + 2), 1 / (np.sum(y < 0) + 2))
    v = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(v @ x, -30, 30)))
        grad = x @ (p - target)
        hess = (x * np.maximum(p * (1 - p), 1e-9)) @ x.T + 1e-6 * np.eye(2)
        v = v - np.clip(np.linalg.solve(hess, grad), -5, 5)
    return float(v[0]), float(v[1])


def _fit(label: np.ndarray, fold: np.ndarray, places: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """Scaled weights by feature, bias, slope and offset."""
    weights, y = np.zeros(FEATURES), np.where(label == 1, 1.0, -1.0)
    n1, n0 = int((y > 0).sum()), int((y < 0).sum())
    if not n1 or not n0:
        share = (n1 + 1) / (n1 + n0 + 2) if n1 + n0 else 0.5
        return weights, 0.0, 1.0, float(np.log(share / (1 - share)))
    row = np.repeat(np.arange(len(y)), np.diff(first))
    p = SMOOTHING + np.bincount(places[y[row] > 0], minlength=FEATURES)
    q = SMOOTHING + np.bincount(places[y[row] < 0], minlength=FEATURES)
    ratio = np.log(p / (n1 + 2 * SMOOTHING)) - np.log(q / (n0 + 2 * SMOOTHING))
    values = ratio[places] / np.sqrt(np.maximum(np.diff(first), 1))[row]
    fitted = fold > 0
    if len(set(y[fitted])) < 2 or len(set(y[~fitted])) < 2:
        fitted = np.ones(len(y), bool)
    keep = np.repeat(fitted, np.diff(first))
    w = dual_coordinate_descent(values[keep], places[keep], np.append(0, np.cumsum(np.diff(first)[fitted])), y[fitted], FEATURES)
    margins = np.bincount(row, values * w[places], len(y)) + w[FEATURES]
    held = ~fitted if not fitted.all() else fitted
    slope, offset = _sigmoid(margins[held], y[held])
    return w[:FEATURES] * ratio, float(w[FEATURES]), slope, offset


def _scored(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, slope, offset = model.value
        for b in slices(batches):
            found, first = features(b.column("text"))
            total = np.append(0, np.cumsum(weights[found]))[first]
            margin = np.diff(total) / np.sqrt(np.maximum(np.diff(first), 1)) + bias
            score = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """``doc_id`` and ``score`` of every row of ``docs`` (``doc_id``, ``text``).

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1); rows are learned from where ``training`` holds.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & training)
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    sample = sample.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLD)).cast("int"))
    examples = docs.join(F.broadcast(sample), "doc_id").select("text", "label", "fold")
    rows = examples.mapInArrow(_examples, "label int, fold int, found array<int>").toArrow()
    found = rows.column("found").combine_chunks()
    first = np.append(0, np.cumsum(found.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
    model = _fit(
        rows.column("label").to_numpy(), rows.column("fold").to_numpy(), found.flatten().to_numpy(zero_copy_only=False), first
    )
    shared = spark.sparkContext.broadcast(model)
    return docs.mapInArrow(_scored(shared), "doc_id bigint, score double")
