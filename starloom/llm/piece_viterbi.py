"""SentencePiece encoding and decoding by a batched numpy Viterbi over words.

Text is cut into words (a run of spaces and what follows it); no piece reaches over such a cut. Distinct words of a
slice are segmented together: substring hashes of all positions and lengths probe the sorted keys of the pieces, words
of equal length advance together position by position, and the maximum over the last pieces stores the backpointer.

The model file is a BPE model, so the path wanted is not the one of greatest summed score but the one that merging
gives. That is a property of neighbours: a segmentation is what merging gives exactly if each of its pieces and each
pair of neighbouring pieces is. The Viterbi state at a position is therefore the last piece of the prefix, a transition
is allowed if merging keeps the two pieces apart, and one path remains. Whether merging keeps a pair apart is decided
from the merge trees of both pieces: only symbols along the inner edge can meet, and only while both exist.

A character without a piece becomes its UTF-8 bytes. Decoding joins the surfaces and drops the one space that encoding
put first. Round trips are exact except that U+2581, which stands for a space inside the model, comes back as a space.

Edge cases: a null or empty text has no pieces and decodes to the empty text; repeated rows give a row each; an empty
table gives an empty result; ``encode`` keeps all other columns as they are and refuses one named like its result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starloom.llm.text import PieceCache, distinct, expand, flat, hashes, mix, slices, texts_of

SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C55)
_LONG = 200  # characters; longer words are merged one by one
_SLICE_BYTES, _SLICE_IDS = 1 << 20, 1 << 18  # a task works on so much at once
_UNKNOWN = -2  # in paths: a character without a piece


class Model:
    """Pieces of a BPE model file without normalisation, with a space put before each text."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        byte = {sp.id_to_piece(i): i for i in range(n) if sp.is_byte(i)}
        self.byte_ids = np.array([byte[f"<0x{b:02X}>"] for b in range(256)])
        self.surface = [b""] * n
        plain = []
        for i in range(n):
            if sp.is_byte(i):
                self.surface[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain.append(i)
                self.surface[i] = sp.id_to_piece(i).replace(SPACE, " ").encode()
        self.flat_surface = np.frombuffer(b"".join(self.surface), np.uint8)
        self.surface_size = np.array([len(s) for s in self.surface])
        self.surface_at = np.cumsum(self.surface_size) - self.surface_size
        pieces = {sp.id_to_piece(i): i for i in plain}
        # Merge order: single characters are there from the start, others come by falling score.
        order = sorted(plain, key=lambda i: -sp.get_score(i))
        self.rank = np.full(n, -1)
        for r, i in enumerate(i for i in order if len(sp.id_to_piece(i)) > 1):
            self.rank[i] = r
        self.left, self.right = np.full(n, -1), np.full(n, -1)
        usable = []
        for text, i in pieces.items():
            if len(text) == 1 or self._split(text, i, pieces):
                usable.append(i)
        self.length = np.zeros(n, np.int64)
        self.key = np.zeros(n, np.uint64)
        self.power = np.ones(n, np.uint64)
        for text, i in pieces.items():
            self.length[i] = len(text)
            h, p = 0, 1
            for c in text:
                h, p = (h * int(_BASE) + ord(c) + 1) % 2**64, p * int(_BASE) % 2**64
            self.key[i], self.power[i] = h, p
        self.longest = int(self.length.max())
        self.barrier = np.zeros(256, bool)  # ASCII characters that no piece holds
        self.barrier[sorted(set(range(128)) - {ord(c) for text in pieces for c in text} - {0x20})] = True
        self.all_keys = self._sorted(np.array(list(pieces.values())))
        self.keys = self._sorted(np.array(usable))
        self.seen = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)

    def _sorted(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys in order, their ids, and a filter that most other keys fail."""
        ids = ids[np.argsort(self.key[ids])]
        keys = self.key[ids]
        maybe = np.zeros(1 << 20, bool)
        maybe[mix(keys) >> np.uint64(44)] = True
        return keys, ids, maybe

    def _split(self, text: str, i: int, pieces: dict[str, int]) -> bool:
        """Merges the characters of a piece; keeps the last merge. False if merging does not give the piece."""
        parts = list(text)
        while len(parts) > 1:
            found = [(self.rank[pieces[m]], k) for k in range(len(parts) - 1) if (m := parts[k] + parts[k + 1]) in pieces]
            if not found:
                return False
            k = min(found)[1]
            if len(parts) == 2:
                self.left[i], self.right[i] = pieces[parts[0]], pieces[parts[1]]
                for part in parts:
                    if self.rank[pieces[part]] >= self.rank[i]:
                        raise ValueError("a piece is older than its parts")
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return True

    def find(self, keys: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """The id of the piece of each key, or -1."""
        known, ids, maybe = table
        out = np.full(len(keys), -1)
        at = np.flatnonzero(maybe[mix(keys) >> np.uint64(44)])
        where = np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)
        same = known[where] == keys[at]
        out[at[same]] = ids[where[same]]
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging keeps piece ``a`` before piece ``b`` apart; pairs seen lately are remembered."""
        pair = (a.astype(np.int64) << 24) + b
        slot = (mix(pair.view(np.uint64)) >> np.uint64(44)).astype(np.int64)
        known, answer = self.seen
        out = answer[slot]
        new = np.flatnonzero(known[slot] != pair)
        if len(new):
            pairs, back = np.unique(pair[new], return_inverse=True)
            fresh = self._apart(pairs >> 24, pairs & ((1 << 24) - 1))
            out[new] = fresh[back]
            at = slot[new]
            # the same slot twice: the last one stays, in both arrays alike
            known[at], answer[at] = pair[new], out[new]
        return out

    def _apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Walks back in merge time along the right edge of ``x`` and the left edge of ``y``.

        At each step the two symbols exist together until ``x_end`` or ``y_end``; they would have merged if their piece
        comes before either. Of equal merges the left one comes first.
        """
        x, y = x.copy(), y.copy()
        far = np.iinfo(np.int64).max
        x_end, y_end = np.full(len(x), far), np.full(len(y), far)
        out, todo = np.ones(len(x), bool), np.arange(len(x))
        while len(todo):
            p, q = x[todo], y[todo]
            merged = self.find(self.key[p] * self.power[q] + self.key[q], self.all_keys)
            r = np.where(merged >= 0, self.rank[merged], far)
            meets = (merged >= 0) & (r < x_end[todo]) & (r <= y_end[todo])
            out[todo[meets]] = False
            rp, rq = self.rank[p], self.rank[q]
            go = ~meets & ((rp >= 0) | (rq >= 0))
            step_x = go & (rp > rq)
            step_y = go & ~step_x
            i, j = todo[step_x], todo[step_y]
            x_end[i], x[i] = rp[step_x], self.right[p[step_x]]
            y_end[j], y[j] = rq[step_y], self.left[q[step_y]]
            todo = todo[go]
        return out

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(sizes) - sizes
        room = np.repeat(start + sizes, sizes) - np.arange(len(points))  # characters of the word from here on
        h, at = np.zeros(len(points), np.uint64), np.arange(len(points))
        first, edges = np.zeros(0, np.int64), []
        for n in range(1, self.longest + 1):
            at = at[room[at] >= n]
            h[at] = h[at] * _BASE + (points[at + n - 1] + np.uint64(1))
            piece = self.find(h[at], self.keys)
            if n == 1:
                first = piece = np.where(piece < 0, _UNKNOWN, piece)
            hit = piece != -1
            edges.append((at[hit].astype(np.int32), np.full(hit.sum(), n, np.int16), piece[hit].astype(np.int32)))
        long = np.flatnonzero(sizes > _LONG)
        ids = self._together(points, start, sizes, *(np.concatenate(v) for v in zip(*edges, strict=True)))
        for w in long.tolist():
            ids[w] = self._one(first[start[w] : start[w] + sizes[w]], points[start[w] : start[w] + sizes[w]])
        return ids

    def _together(self, points, start, sizes, at, n, piece) -> list[bytes]:
        """Viterbi over the words that are not long, those of one length together.

        State: the last piece of the prefix that ends at a character. Score: nothing if merging gives that path, else
        minus infinity; as one path at most is possible for a prefix, the maximum is the transition that is allowed.
        """
        to = at + n - 1
        place = (np.arange(len(points)) - np.repeat(start, sizes)).astype(np.int32)
        step = np.repeat(np.where(sizes <= _LONG, sizes * (_LONG + 1), 0), sizes).astype(np.uint16)
        step = np.where(step > 0, step + place.astype(np.uint16), 0).astype(np.uint16)[to]
        order = np.argsort(step, kind="stable")[np.count_nonzero(step == 0) :]
        at, to, n, piece, step = at[order], to[order], n[order], piece[order], step[order]
        opens = place[at] == 0
        last = np.full(len(points), -1, np.int32)
        back = np.zeros(len(points), np.int16)
        cuts = np.flatnonzero(np.diff(step.astype(np.int32), prepend=-1, append=-1))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own, first, before = piece[a:b], opens[a:b], last[at[a:b] - 1]
            allowed = first | (before != -1)
            test = np.flatnonzero(allowed & ~first & (own >= 0) & (before >= 0))
            allowed[test] = self.apart(before[test], own[test])
            reached = to[a:b][allowed]
            last[reached], back[reached] = own[allowed], n[a:b][allowed]
        row = np.flatnonzero((sizes > 0) & (sizes <= _LONG))
        end, out = start[row] + sizes[row] - 1, []
        while len(row):
            out.append((row, end, last[end]))
            end = end - back[end]
            more = end >= start[row]
            row, end = row[more], end[more]
        if not out:
            return [b""] * len(start)
        row, end, piece = (np.concatenate(v) for v in zip(*out, strict=True))
        order = np.argsort(end, kind="stable")
        row, end, piece = row[order], end[order], piece[order]
        if (piece == _UNKNOWN).any():
            parts = [self._bytes(points[e]) if p == _UNKNOWN else [p] for e, p in zip(end.tolist(), piece.tolist(), strict=True)]
            row = np.repeat(row, [len(p) for p in parts])
            piece = np.concatenate(parts)
        data, edge = piece.astype("<u4").tobytes(), (np.searchsorted(row, np.arange(len(start) + 1)) * 4).tolist()
        return [data[x:y] for x, y in zip(edge[:-1], edge[1:], strict=True)]

    def _one(self, first: np.ndarray, points: np.ndarray) -> bytes:
        """The same for a single long word, by merging with a queue: positions in turn would be all overhead."""
        symbols = first.tolist()
        n = len(symbols)
        after, before, alive = [*range(1, n), -1], list(range(-1, n - 1)), [True] * n
        key, power, rank = self.key, self.power, self.rank
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> None:
            pairs = [(i, after[i]) for i in lefts if i >= 0 and after[i] >= 0 and symbols[i] >= 0 and symbols[after[i]] >= 0]
            if not pairs:
                return
            p, q = np.array([symbols[i] for i, _ in pairs]), np.array([symbols[j] for _, j in pairs])
            for (i, j), m in zip(pairs, self.find(key[p] * power[q] + key[q], self.all_keys).tolist(), strict=True):
                if m >= 0:
                    heapq.heappush(queue, (int(rank[m]), i, symbols[i], symbols[j], m))

        offer(list(range(n - 1)))
        while queue:
            _, i, p, q, m = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j < 0 or symbols[i] != p or symbols[j] != q:
                continue
            symbols[i], alive[j], after[i] = m, False, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer([before[i], i])
        out: list[int] = []
        for i in range(n):
            if alive[i]:
                out += self._bytes(points[i]) if symbols[i] == _UNKNOWN else [symbols[i]]
        return np.array(out, "<u4").tobytes()

    def _bytes(self, point: int) -> list[int]:
        return [int(self.byte_ids[b]) for b in chr(int(point)).encode()]


@cache
def model(path: str) -> tuple[Model, PieceCache]:
    return Model(path), PieceCache()


def _words(buf: np.ndarray, offsets: np.ndarray, barrier: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, each with its leading spaces, and the first word of each text (n + 1).

    A character that no piece holds is a word of its own.
    """
    n = len(buf)
    space = buf == 0x20
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    alone = barrier[buf]
    cut |= alone
    cut[1:] |= alone[:-1]
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], n)[: len(starts)], np.searchsorted(starts, offsets)


def encode_texts(path: str, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and their offsets."""
    spm, cache_ = model(path)
    buf, offsets = flat(column)
    if (buf == 0xE2).any() and SPACE.encode() in buf.tobytes():
        buf, offsets = flat(pa.array([(t or "").replace(SPACE, " ") for t in column.to_pylist()]))
    if not len(buf):
        return np.zeros(0, np.uint32), offsets
    starts, ends, first = _words(buf, offsets, spm.barrier)
    key = hashes(buf, starts, ends)
    opening = np.zeros(len(starts), bool)
    opening[first[:-1][first[:-1] < first[1:]]] = True
    key[opening] = mix(key[opening] + np.uint64(1))  # a first word has one more space
    keys, at, where = distinct(key)

    def compute(missing):
        some = where[missing]
        texts = texts_of(buf, starts[some], ends[some])
        return spm.segment([(SPACE if o else "") + t.replace(" ", SPACE) for t, o in zip(texts, opening[some], strict=True)])

    values = cache_.get(keys, compute)
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    counts = sizes[at]
    word, place = expand(counts)
    ids = np.frombuffer(b"".join(values), "<u4")[(np.cumsum(sizes) - sizes)[at][word] + place]
    return ids, np.append(0, np.cumsum(counts))[first]


def decode_ids(path: str, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The texts of id sequences."""
    spm, _ = model(path)
    sizes = spm.surface_size[ids]
    piece, place = expand(sizes)
    data = spm.flat_surface[spm.surface_at[ids][piece] + place].tobytes()
    at = np.append(0, np.cumsum(sizes))[offsets].tolist()
    texts = [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    return [(t[1:] if t[:1] == b" " else t).decode(errors="replace") for t in texts]


def _encoded(path: str, text_column: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_column, _SLICE_BYTES):
            ids, offsets = encode_texts(path, b.column(text_column))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], [*b.schema.names, "ids"])

    return run


def _decoded(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "ids", _SLICE_IDS):
            lists = b.column("ids").fill_null([]) if b.column("ids").null_count else b.column("ids")
            offsets = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
            texts = decode_ids(path, lists.flatten().to_numpy(zero_copy_only=False), offsets.astype(np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``ids``, the piece ids of ``text_column``."""
    if "ids" in docs.columns:
        raise ValueError("the rows have a column named ids already")
    return docs.mapInArrow(_encoded(path, text_column), T.StructType([*docs.schema, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of ``encoded`` and ``decoded``, the text of ``ids``."""
    return encoded.mapInArrow(_decoded(path), T.StructType([*encoded.schema, T.StructField("decoded", T.StringType())]))
