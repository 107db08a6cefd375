"""Flat numpy views of text columns: the bytes of a batch in one array, word spans, word hashes and cached pieces.

All functions work inside Arrow tasks. A batch is cut into slices of bounded bytes (one row at least), so that the
memory of a task follows the slice and not the partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words `[^\x20\x09-\x0D]+`.
PLAIN = np.ones(256, bool)
PLAIN[[0x20, *range(0x09, 0x0E)]] = False

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in slices of about ``size`` bytes of ``column``, or entries where it holds lists."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        length = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
        ends = np.cumsum(pc.fill_null(length, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, n = 0, batch.num_rows
        while at < n:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each text starts (one more entry than texts). Null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(buf: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of member bytes, no run across texts, and the first run of each text (n + 1)."""
    inside = member[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    at, to = offsets[:-1][filled], offsets[1:][filled] - 1
    first[at], last[to] = inside[at], inside[to]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; a bijection."""
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span, eight bytes at a time. A span of a megabyte takes as many rounds as it has words."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    length = (ends - starts).astype(np.int64)
    h = mix(length.astype(np.uint64) * _M1 + np.uint64(seed))
    eight = np.ndarray((len(buf) + 1,), np.uint64, padded, strides=(1,))
    todo, done = np.arange(len(starts)), 0
    while len(todo):
        left = length[todo] - done
        chunk = eight[starts[todo] + done]
        short = left < 8
        chunk[short] &= (np.uint64(1) << (np.maximum(left[short], 0).astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[todo] = mix(h[todo] * _M1 + chunk)
        done += 8
        todo = todo[left > 8]
    return h


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values, the place of each value among them, and where each distinct value stands once."""
    coded = pa.array(values).dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False)
    where = np.zeros(len(coded.dictionary), np.int64)
    where[at] = np.arange(len(at))
    return coded.dictionary.to_numpy(zero_copy_only=False), at, where


def texts_of(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """The spans as strings; they must begin and end between characters."""
    data = buf.tobytes()
    return [data[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of ``counts`` entries: the group of each entry, and its place in the group."""
    group = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return group, np.arange(len(group)) - first[group]


class PieceCache:
    """Values by the hash of a piece, for pieces seen lately in this worker; two generations bound its memory."""

    def __init__(self, limit: int = 1 << 18):
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, keys: np.ndarray, compute: Callable[[np.ndarray], list]) -> list:
        """The value of each of the distinct ``keys``. ``compute`` makes the values of those at the given places."""
        listed = keys.tolist()
        new, old = self.new, self.old
        values = [new.get(k) for k in listed]
        missing = []
        for i, v in enumerate(values):
            if v is None:
                v = old.get(listed[i])
                if v is None:
                    missing.append(i)
                else:
                    values[i] = new[listed[i]] = v
        if missing:
            for i, v in zip(missing, compute(np.array(missing)), strict=True):
                values[i] = new[listed[i]] = v
        if len(new) > self.limit:
            self.old, self.new = new, {}
        return values
