"""Language-model scoring: causal self-attention in numpy over subword ids, with word counts below it.

Words are lower-cased (A-Z) and split into the ids of a public byte-level BPE vocabulary; a text is the sequence of all
ids of its words, then the end mark. The softmax has two levels: the most frequent ids are classes of their own, the
others share classes of about equal mass. The probability of an id is that of its class given the ids before it, times
that of the id in its class given them too: its share of the class, weighted by the context through one of ``BUCKETS``
output vectors (id modulo ``BUCKETS``). A class is predicted by bigram log-probabilities plus one head of causal
self-attention. All is learned from all training documents:
1. One pass counts words and ids and cuts every training document into windows that follow one another: every id and
   end mark is predicted in one of them. Counts are summed per task, then by key in a shuffle.
2. Class bigrams are counted over all windows. Attention weights are trained by averaging: each task runs Adam over its
   windows from the same start, weights are averaged by windows, twice. Only sums of parameter size reach the driver.
3. Texts are scored in windows that overlap by ``CONTEXT`` positions; the masked attention runs over batches of windows,
   and each token is predicted once, in the window where it has the longer context.

Counts of words (for the unigram base) come from a head of fixed size (broadcast) or, for the words beyond, from a join on
word hashes, so neither the vocabulary nor a document is ever in one place.

Edge cases: a null or empty text is the end mark alone; a null id is neither held out nor learned from; repeated rows
give a row each; with no training document all ids are equally likely; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.text import LOWER, PLAIN, distinct, expand, flat, hashes, slices, spans, texts_of
from starloom.session import materialize, work_folder

CLASSES, SINGLE = 64, 52
WIDTH, WINDOW, CONTEXT = 16, 32, 6
HEAD_WORDS = 1 << 17
ROUNDS, BATCH, RATE = 2, 64, 0.004
BUCKETS = 64
_END = np.int64(0x1E5D)  # key of the end mark among word hashes
_INNER = 1 << 24  # added to ids inside of words where they are counted

_SHAPES = {"E": (CLASSES, WIDTH), "P": (WINDOW, WIDTH), "Q": (WIDTH, WIDTH), "K": (WIDTH, WIDTH), "V": (WIDTH, WIDTH),
           "O": (WIDTH, WIDTH), "X": (WIDTH, WIDTH), "U": (WIDTH, CLASSES), "G": (WIDTH, BUCKETS)}
_SIZE = sum(a * b for a, b in _SHAPES.values())
_CAUSAL = np.tril(np.ones((WINDOW, WINDOW), np.float32))


def _named(flat_weights: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, (a, b) in _SHAPES.items():
        out[name] = flat_weights[at : at + a * b].reshape(a, b)
        at += a * b
    return out


def _start() -> np.ndarray:
    w = np.random.Generator(np.random.PCG64(11)).normal(0, 0.25, _SIZE).astype(np.float32)
    _named(w)["U"][:] *= 0.1
    _named(w)["G"][:] *= 0.1
    return w


# --- subword ids ---------------------------------------------------------------------------------------------------


class _Ids:
    """Ids of words by the words' hashes, in flat arrays. Beyond ``limit`` ids only those of the last slice are kept."""

    def __init__(self, limit: int = 1 << 21):
        self.limit = limit
        self.keys, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        found = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        found[inside] = self.keys[at[inside]] == keys[inside]
        return at, found

    def get(self, keys: np.ndarray, compute) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each of the distinct ``keys`` where its own begin and how many they are.

        ``compute`` takes places among ``keys`` and returns the ids of those words one after the other, and their numbers.
        """
        at, found = self._places(keys)
        if not found.all():
            missing = np.flatnonzero(~found)
            missing = missing[np.argsort(keys[missing])]
            ids, sizes = compute(missing)
            if len(self.ids) + len(ids) > self.limit:
                kept = at[found]
                kept = kept[np.argsort(kept)]
                word, place = expand(self.sizes[kept])
                self.ids = self.ids[self.begins[kept][word] + place]
                self.keys, self.sizes = self.keys[kept], self.sizes[kept]
                self.begins = np.cumsum(self.sizes) - self.sizes
            into = np.searchsorted(self.keys, keys[missing])
            self.keys = np.insert(self.keys, into, keys[missing])
            self.begins = np.insert(self.begins, into, len(self.ids) + np.cumsum(sizes) - sizes)
            self.sizes = np.insert(self.sizes, into, sizes)
            self.ids = np.append(self.ids, ids)
            at, _ = self._places(keys)
        return self.ids, self.begins[at], self.sizes[at]


@cache
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
    n_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
    n_bytes[list(ranks.values())] = [len(piece) for piece in ranks]
    return tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), n_bytes, _Ids()


def _encoded(encoding, n_bytes: np.ndarray, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words (of ``lengths`` bytes), each with a space before it, one after the other, and how many each has.

    A pattern that takes a space with what follows it splits before each word, if no word holds a space of another kind:
    such words are encoded as one text, and cut where their bytes end. If an id crosses such an end after all, and for
    words with spaces, each is encoded by itself.
    """
    plain = np.fromiter((w.isascii() or len(w.split()) == 1 for w in words), bool, len(words))
    whole = np.array(encoding.encode_ordinary("".join(f" {w}" for w, p in zip(words, plain.tolist(), strict=True) if p)), np.int32)
    ends, wanted = np.cumsum(n_bytes[whole]), np.cumsum(lengths[plain] + 1)
    cut = np.searchsorted(ends, wanted)
    if not np.isin(wanted, ends).all():
        plain[:], whole, cut = False, whole[:0], cut[:0]
    single = [encoding.encode_ordinary(f" {w}") for w, p in zip(words, plain.tolist(), strict=True) if not p]
    sizes = np.zeros(len(words), np.int64)
    sizes[plain] = np.diff(cut + 1, prepend=0)
    sizes[~plain] = np.fromiter(map(len, single), np.int64, len(single))
    joined = np.repeat(plain, sizes)
    ids = np.empty(len(joined), np.int32)
    ids[joined] = whole
    ids[~joined] = np.fromiter((i for some in single for i in some), np.int32, len(ids) - len(whole))
    return ids, sizes


class Subwords:
    """Splits words into ids; the id after the last is the end mark. Small enough to be sent to every task."""

    def __init__(self, path: str, pattern: str, size: int):
        self.path, self.pattern, self.size = path, pattern, size

    def words(self, b: pa.RecordBatch):
        """Of a slice: hashes of the distinct words and their ids (for :meth:`ids`), the number of each word, the words of texts (n + 1)."""
        buf, offsets = flat(b.column("text"))
        buf = LOWER[buf]
        starts, ends, first = spans(buf, offsets, PLAIN)
        encoding, n_bytes, cached = _encoding(self.path, self.pattern)
        if not len(starts):
            return np.zeros(0, np.uint64), (cached.ids, np.zeros(0, np.int64), np.zeros(0, np.int64)), np.zeros(0, np.int64), first
        keys, at, where = distinct(hashes(buf, starts, ends))

        def compute(missing):
            some = where[missing]
            return _encoded(encoding, n_bytes, texts_of(buf, starts[some], ends[some]), ends[some] - starts[some])

        return keys, cached.get(keys, compute), at, first

    def ids(self, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all distinct words in a row, and the number of ids of each."""
        ids, begins, sizes = found
        word, place = expand(sizes)
        return ids[begins[word] + place], sizes


# --- what is gathered from the corpus ------------------------------------------------------------------------------


def _sequences(subwords: Subwords, ids: np.ndarray, sizes: np.ndarray, at: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of every word of each text, then the end mark; and where each text starts (one more than texts)."""
    word, place = expand(sizes[at])
    offsets = np.append(0, np.cumsum(sizes[at]))[first] + np.arange(len(first))
    out = np.full(offsets[-1], subwords.size, np.int64)
    inside = np.ones(len(out), bool)
    inside[offsets[1:] - 1] = False
    out[inside] = ids[(np.cumsum(sizes) - sizes)[at[word]] + place]
    return out, offsets


def _stored_id(n_classified: int) -> np.dtype:
    """How an id or end mark is kept in the bytes of a window."""
    return np.dtype("<u2" if n_classified <= 1 << 16 else "<u4")


def _bytes_of(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    """Values as one binary each from ``edge`` to ``edge``; Spark moves those as a whole, lists one entry at a time."""
    at = (edge * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def _gathered(subwords: Subwords):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "key", "n", "window"]

        def rows(kind, keys, counts, windows=None):
            n = len(keys)
            windows = pa.nulls(n, pa.binary()) if windows is None else windows
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(keys), pa.array(counts), windows], names)

        def merged(parts):
            keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)

        parts, pending = [], 0
        begins, inside = np.zeros(subwords.size + 1, np.int64), np.zeros(subwords.size, np.int64)
        for b in slices(batches):
            b = b.filter(b.column("learn"))
            if not len(b):
                continue
            keys, values, at, first = subwords.words(b)
            counts = np.bincount(at, minlength=len(keys))
            ids, sizes = subwords.ids(values)
            opens = np.zeros(len(ids), bool)
            opens[np.cumsum(sizes) - sizes] = True
            each = np.repeat(counts, sizes)
            begins[: subwords.size] += np.bincount(ids[opens], each[opens], subwords.size).astype(np.int64)
            begins[subwords.size] += len(b)
            inside += np.bincount(ids[~opens], each[~opens], subwords.size).astype(np.int64)
            parts.append((np.append(keys.view(np.int64), _END), np.append(counts, len(b))))
            pending += len(keys)
            if pending > 1 << 21:
                parts, pending = [merged(parts)], 0
                if len(parts[0][0]) > 1 << 20:
                    yield rows(0, *parts.pop())
            # All windows of each text, so that every entry is predicted once: an end mark stands before the first word and after the last.
            sequence, offsets = _sequences(subwords, ids, sizes, at, first)
            n = np.diff(offsets)
            doc, turn = expand(-(-n // WINDOW))
            row, place = expand(np.minimum(n[doc] - turn * WINDOW, WINDOW) + 1)
            place += turn[row] * WINDOW
            window = np.where(place == 0, subwords.size, sequence[np.maximum(offsets[doc[row]] + place - 1, 0)])
            edge = np.searchsorted(row, np.arange(len(doc) + 1))
            zeros = np.zeros(len(doc), np.int64)
            yield rows(2, zeros, zeros, _bytes_of(window.astype(_stored_id(subwords.size + 1)), edge))
        if parts:
            yield rows(0, *merged(parts))
        for counts, base in ((begins, 0), (inside, _INNER)):
            used = np.flatnonzero(counts)
            yield rows(1, used + base, counts[used])

    return run


def class_table(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each id, and the log10 of its share of the class."""
    order = np.argsort(-counts, kind="stable")
    classes = np.zeros(len(counts), np.int64)
    classes[order[:SINGLE]] = np.arange(SINGLE)
    rest = order[SINGLE:]
    mass = np.cumsum(counts[rest] + 0.5)
    classes[rest] = SINGLE + np.minimum((mass - 1e-9) / mass[-1] * (CLASSES - SINGLE), CLASSES - SINGLE - 1).astype(np.int64)
    smooth = counts + 0.5
    return classes, np.log10(smooth / np.bincount(classes, smooth, CLASSES)[classes])


def _windows(batch: pa.RecordBatch, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows as classes (one more than WINDOW, filled up with 0), the number of predictions in each, and their ids."""
    kept, windows = _stored_id(len(classes)), batch.column("window").cast(pa.large_binary())
    edge = np.frombuffer(windows.buffers()[1], np.int64, len(windows) + 1, windows.offset * 8)
    size = np.diff(edge) // kept.itemsize
    out, ids = (np.zeros((len(batch), WINDOW + 1), np.int64) for _ in range(2))
    row, place = expand(size)
    if len(row):
        ids[row, place] = np.frombuffer(windows.buffers()[2], kept, len(row), edge[0])
        out[row, place] = classes[ids[row, place]]
    return out, np.maximum(size - 1, 0), ids


def _bigrams(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            c, size, _ = _windows(batch, shared.value)
            inside = np.arange(WINDOW) < size[:, None]
            total += np.bincount((c[:, :-1] * CLASSES + c[:, 1:])[inside], minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "n"])

    return run


# --- the model -----------------------------------------------------------------------------------------------------


class Gradient:
    """The gradient of the mean log loss over ``n`` windows at a time, in buffers that are used again."""

    def __init__(self, n: int):
        self.n, self.row = n, np.arange(n * WINDOW)
        self.x, self.qkvx, self.d = (np.empty((n * WINDOW, a * WIDTH), np.float32) for a in (1, 4, 4))
        self.a, self.da = (np.empty((n, WINDOW, WINDOW), np.float32) for _ in range(2))
        self.out, self.bigrams = (np.empty((n * WINDOW, CLASSES), np.float32) for _ in range(2))

    def __call__(self, w: np.ndarray, bigram: np.ndarray, c: np.ndarray, y: np.ndarray, weight: np.ndarray, second=None) -> tuple[float, np.ndarray]:
        """Loss of predicting ``y`` after ``c``, each prediction by its weight (0 outside of the text), and its gradient.

        ``second``, the ids' buckets and each class's shares by bucket, adds the loss of the id within its class.
        """
        p, n, scale = _named(w), self.n, np.float32(WIDTH**-0.5)
        c, weight = c.reshape(-1), weight.reshape(-1)
        by_class, by_width = np.ones(CLASSES, np.float32), np.ones((WIDTH, 1), np.float32)
        # Vectors of class and place; queries, keys, values and the place's own share in one product.
        table = (p["E"][:, None] + p["P"]).reshape(-1, WIDTH)
        x = table.take(c * WINDOW + self.row % WINDOW, 0, out=self.x, mode="clip")
        into = np.concatenate([p["Q"] * scale, p["K"], p["V"], p["X"]], 1)
        qkvx = np.matmul(x, into, out=self.qkvx)
        q, k, v = (qkvx[:, i * WIDTH : (i + 1) * WIDTH].reshape(n, WINDOW, WIDTH) for i in range(3))
        a = np.matmul(q, k.transpose(0, 2, 1), out=self.a)
        np.exp(np.minimum(a, 60, out=a), out=a)  # never reached by weights of any use
        a *= _CAUSAL
        a /= a @ np.ones((WINDOW, 1), np.float32)
        z = (a @ v).reshape(-1, WIDTH)
        h = z @ p["O"]
        h += qkvx[:, 3 * WIDTH :]
        np.tanh(h, out=h)
        out = np.matmul(h, p["U"], out=self.out)
        out += bigram.take(c, 0, out=self.bigrams, mode="clip")
        goal = self.row * CLASSES + y.reshape(-1)
        hit = out.reshape(-1).take(goal)
        np.exp(out, out=out)  # |h| < 1: no logit is beyond the sum of its column of U
        total = out @ by_class
        loss = float(((np.log(total) - hit) * weight).sum())
        out *= (weight / total)[:, None]
        out.reshape(-1)[goal] -= weight

        grad = np.empty_like(w)
        g = _named(grad)
        g["U"][:] = h.T @ out
        du = out @ p["U"].T
        if second is None:
            g["G"][:] = 0
        else:
            bucket, spread = second[0].reshape(-1), second[1]
            inner = h @ p["G"]
            hit = inner[self.row, bucket]
            np.exp(inner, out=inner)
            inner *= spread.take(y.reshape(-1), 0)
            total = inner @ np.ones(BUCKETS, np.float32)
            loss += float(((np.log(total) - hit) * weight).sum())
            inner *= (weight / total)[:, None]
            inner[self.row, bucket] -= weight
            g["G"][:] = h.T @ inner
            du += inner @ p["G"].T
        h *= h
        du *= np.subtract(1, h, out=h)
        g["O"][:] = z.T @ du
        dz = du @ p["O"].T
        z *= dz
        da = np.matmul(dz.reshape(n, WINDOW, WIDTH), v.transpose(0, 2, 1), out=self.da)
        da -= (z @ by_width).reshape(n, WINDOW, 1)
        da *= a
        d = self.d
        d[:, 3 * WIDTH :] = du
        dq, dk, dv = (d[:, i * WIDTH : (i + 1) * WIDTH].reshape(n, WINDOW, WIDTH) for i in range(3))
        dq[:], dk[:], dv[:] = da @ k, da.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dz.reshape(n, WINDOW, WIDTH)
        g["Q"][:], g["K"][:], g["V"][:], g["X"][:] = np.split(x.T @ d, 4, 1)
        g["Q"][:] *= scale
        dx = d @ into.T
        order = np.argsort(c, kind="stable")
        begin = np.flatnonzero(np.diff(c[order], prepend=-1))
        g["E"][:] = 0
        g["E"][c[order[begin]]] = np.add.reduceat(dx.take(order, 0), begin, 0)
        g["P"][:] = dx.reshape(n, -1).sum(0).reshape(WINDOW, WIDTH)
        return loss, grad


def train(w: np.ndarray, bigram: np.ndarray, c: np.ndarray, size: np.ndarray, rate: float = RATE, second=None) -> np.ndarray:
    """One pass of Adam over windows; ``second``, the windows' ids and each class's shares by bucket, trains the id level."""
    w, one, two = w.copy(), np.zeros_like(w), np.zeros_like(w)
    gradient = Gradient(min(BATCH, max(1, len(c))))
    for step, at in enumerate(range(0, len(c), BATCH), 1):
        part = c[at : at + BATCH]
        if len(part) != gradient.n:
            gradient = Gradient(len(part))
        inside = np.arange(WINDOW) < size[at : at + BATCH, None]
        weight = (inside / max(1, inside.sum())).astype(np.float32)
        inner = None if second is None else ((second[0][at : at + BATCH, 1:] % BUCKETS), second[1])
        _, g = gradient(w, bigram, part[:, :-1], part[:, 1:], weight, inner)
        one += 0.1 * (g - one)
        two += 0.01 * (g * g - two)
        w -= rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-8)
    return w


def _trained(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, bigram, start, spread = shared.value
        w, n = start, 0
        for batch in batches:
            c, size, ids = _windows(batch, classes)
            w = train(w, bigram, c, size, second=(ids, spread))
            n += len(c)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(_SIZE)), pa.array(w.astype(float) * n), pa.array(np.full(_SIZE, n))], ["at", "total", "n"])

    return run


def _predicted(model, c: np.ndarray, offsets: np.ndarray, end: int, second=None) -> np.ndarray:
    """log10 probability of each class of the texts; class ``end`` stands before each text.

    With ``second`` (the ids, each class's shares by bucket and the natural log of each id's share) that of each id.
    """
    bigram, weights = model
    p = _named(weights)
    x = (p["E"][:, None] + p["P"][None]).reshape(-1, WIDTH)  # class x position
    q, k, v, own = (x @ p[n] for n in "QKVX")
    q *= np.float32(WIDTH**-0.5)
    n = np.diff(offsets)
    step = WINDOW - CONTEXT
    windows = np.maximum(0, -(-(n - WINDOW) // step)) + 1
    doc, turn = expand(windows)
    out = np.empty(len(c), np.float32)
    place = np.arange(WINDOW)
    window_ones, class_ones = np.ones((WINDOW, 1), np.float32), np.ones(CLASSES, np.float32)
    for a in range(0, len(doc), 32):
        d, t = doc[a : a + 32], turn[a : a + 32]
        target = (offsets[d] + t * step)[:, None] + place
        ask = (target < offsets[d + 1][:, None]) & ((t == 0)[:, None] | (place >= CONTEXT))
        at = np.minimum(target, len(c) - 1)
        before = c.take(at - 1)
        before[t == 0, 0] = end
        row = before * WINDOW + place
        s = q.take(row, 0) @ k.take(row, 0).transpose(0, 2, 1)
        np.exp(s, out=s)
        s *= _CAUSAL
        z = s @ v.take(row, 0)
        z /= s @ window_ones
        row, before, goal = (x.reshape(-1).compress(ask.reshape(-1)) for x in (row, before, at))
        h = z.reshape(-1, WIDTH).compress(ask.reshape(-1), 0) @ p["O"]
        h += own.take(row, 0)
        np.tanh(h, out=h)
        z = h @ p["U"]
        z += bigram.take(before, 0)
        hit = z[np.arange(len(goal)), c.take(goal)]
        np.exp(z, out=z)
        out[goal] = hit - np.log(z @ class_ones)
        if second is not None:
            ids, spread, share = second
            inner = h @ p["G"]
            hit = inner[np.arange(len(goal)), ids.take(goal) % BUCKETS]
            np.exp(inner, out=inner)
            inner *= spread.take(c.take(goal), 0)
            out[goal] += hit - np.log(inner @ np.ones(BUCKETS, np.float32)) + share.take(ids.take(goal))
    return out / np.float32(np.log(10))


# --- scoring -------------------------------------------------------------------------------------------------------

_SCORED = (
    "uid bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, "
    "tail array<bigint>, times array<bigint>"
)


def _scored(subwords: Subwords, shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, classes, spread, share, head, head_counts = shared.value
        uid = TaskContext.get().partitionId() << 33
        for b in slices(batches):
            keys, values, at, first = subwords.words(b)
            n, end = len(b), len(keys)
            ids, sizes = subwords.ids(values)
            sequence, offsets = _sequences(subwords, ids, sizes, at, first)
            c = classes[sequence]
            score = np.add.reduceat(_predicted(model, c, offsets, classes[-1], (sequence, spread, share)).astype(float), offsets[:-1])
            # By distinct word, the end mark last: whether training documents have it, for the unigram base.
            own = np.append(keys.view(np.int64), _END)
            where = np.minimum(np.searchsorted(head, own), max(len(head) - 1, 0))
            known = head[where] == own if len(head) else np.zeros(end + 1, bool)
            value = np.zeros(end + 1)
            value[known] = np.log10(head_counts[where[known]] + 0.1)

            def per_text(x, at=at, first=first):
                return np.diff(np.append(0, np.cumsum(x[at]))[first]) + x[-1]

            doc, _ = expand(np.diff(first))
            rare = np.flatnonzero(~known[at])
            pair = doc[rare] * (end + 1) + at[rare]
            if not known[-1]:
                pair = np.append(pair, np.arange(n) * (end + 1) + end)
            pair, times = np.unique(pair, return_counts=True)
            word = pair % (end + 1)
            edge = pa.array(np.searchsorted(pair // (end + 1), np.arange(n + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(edge, pa.array(v)) for v in (own[word], times)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(uid, uid + n)), b.column("doc_id"), b.column("held_out"), pa.array(np.diff(first) + 1)]
                + [pa.array(per_text(known.astype(np.int64))), pa.array(per_text(value)), pa.array(score), *lists],
                [part.split()[0] for part in _SCORED.split(", ")],
            )
            uid += n

    return run


def score_texts(docs: DataFrame, held_out: Column, path: str, pattern: str, n_ids: int) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``).

    ``doc_id``, ``held_out``, ``n_tokens`` (words and the end mark), ``n_known``, ``train_tokens``, ``base_score`` (the
    unigram's log10 probability of the words) and ``score`` (the model's of the text). The model learns from rows whose
    ``held_out`` is false. ``path`` is a file of ranks for ``n_ids`` ids, ``pattern`` its splitting pattern.
    """
    spark = docs.sparkSession
    subwords = Subwords(path, pattern, n_ids)
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(~held_out, F.lit(False)).alias("learn"),
    )
    found = docs.select("text", "learn").mapInArrow(_gathered(subwords), "kind int, key bigint, n bigint, window binary")
    found = materialize(found, work_folder(spark))

    words = materialize(found.filter("kind = 0").groupBy("key").agg(F.sum("n").alias("n")), work_folder(spark))
    total, vocabulary = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = words.orderBy(F.col("n").desc(), "key").limit(HEAD_WORDS).toPandas().sort_values("key")
    by_id = found.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).toPandas()  # two rows an id at most
    begins, inside = np.zeros(n_ids + 1), np.zeros(n_ids)
    first = by_id["key"] < _INNER
    begins[by_id["key"][first]] = by_id["n"][first]
    inside[by_id["key"][~first] - _INNER] = by_id["n"][~first]
    begins[:n_ids] += inside  # every id, the end mark last
    classes, share = class_table(begins)
    spread = np.zeros((CLASSES, BUCKETS))
    np.add.at(spread, (classes, np.arange(n_ids + 1) % BUCKETS), 10**share)
    spread, share = spread.astype(np.float32), (share * np.log(10)).astype(np.float32)

    windows = found.filter("kind = 2").select("window")
    context = spark.sparkContext
    cells = windows.mapInArrow(_bigrams(context.broadcast(classes)), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    pairs = np.zeros(CLASSES * CLASSES)
    pairs[cells["cell"]] = cells["n"]
    pairs = pairs.reshape(CLASSES, CLASSES)
    single = (pairs.sum(0) + 1) / (pairs.sum() + CLASSES)
    bigram = np.log((pairs + 20 * single) / (pairs.sum(1, keepdims=True) + 20)).astype(np.float32)
    weights = _start()
    for _ in range(ROUNDS):
        trained = windows.mapInArrow(_trained(context.broadcast((classes, bigram, weights, spread))), "at bigint, total double, n bigint")
        mean = trained.groupBy("at").agg((F.sum("total") / F.sum("n")).alias("w")).toPandas().sort_values("at")
        if len(mean):
            weights = mean["w"].to_numpy().astype(np.float32)

    head = top["key"].to_numpy(np.int64), top["n"].to_numpy(np.int64)
    shared = context.broadcast(((bigram, weights), classes, spread, share, *head))
    scored = materialize(docs.select("doc_id", "text", "held_out").mapInArrow(_scored(subwords, shared), _SCORED), work_folder(spark))
    tail = scored.select("uid", F.explode(F.arrays_zip("tail", "times")).alias("x")).select("uid", F.col("x.tail").alias("key"), "x.times")
    tail = tail.join(words, "key", "left").groupBy("uid").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("tail_base"),
    )
    out = scored.drop("tail", "times").join(tail, "uid", "left")
    norm = float(np.log10(total + 0.1 * (vocabulary + 1)))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"),
        "score",
    )
