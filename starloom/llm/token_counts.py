"""Token counts: batch encoding inside Arrow tasks that returns lengths only.

Long texts are cut at boundaries no token can cross, so the counts of the parts add up to the count of the whole. A
byte-level BPE whose words carry one leading space cannot join two words over a single space between two characters
that are no white space. Every text is cut at all such places. Equal parts of a slice are encoded once and batches hold
about the same number of bytes, so neither a long text nor a run of long texts makes a long batch.

Edge cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows each give a row; an empty table gives an
empty result; columns other than the two named are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.text import PieceCache, distinct, flat, hashes, slices, texts_of

BATCH_BYTES = 1 << 18

# A character that is no white space, seen from either side: ASCII letters, digits and signs, and characters of two
# bytes that do not begin with C2. White space beyond ASCII begins with C2, E1, E2 or E3 and is never next to a cut.
_INK = np.zeros(256, bool)
_INK[0x21:0x7F] = True
_TWO = np.zeros(256, bool)
_TWO[0xC3:0xE0] = True
_OPENS = _INK | _TWO
_OPENS[0xE4:0xF5] = True


@cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _cache(path: str) -> PieceCache:
    return PieceCache()


def safe_cuts(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the parts of all texts, and the first part of each text (one more entry than texts)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    at = np.flatnonzero(buf == 0x20)
    at = at[(at > 1) & (at < n - 1)]
    before = _INK[buf[at - 1]] | ((buf[at - 1] >= 0x80) & _TWO[buf[at - 2]])
    cut = np.zeros(n + 1, bool)
    cut[at[before & _OPENS[buf[at + 1]]]] = True
    cut[offsets] = True
    filled = offsets[:-1][offsets[:-1] < offsets[1:]]
    near = filled[:, None] + np.arange(2)  # what stands before the first characters of a text is another text
    near = near[near < n]
    cut[np.setdiff1d(near, offsets)] = False
    starts = np.flatnonzero(cut[:n])
    return starts, np.append(starts[1:], n), np.searchsorted(starts, offsets)


def balanced(lengths: np.ndarray, size: int = BATCH_BYTES) -> list[tuple[int, int]]:
    """Ranges of consecutive pieces of about ``size`` bytes each."""
    if not len(lengths):
        return []
    batch = (np.cumsum(lengths) - lengths) // size
    edges = [0, *(np.flatnonzero(np.diff(batch)) + 1).tolist(), len(lengths)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def lengths_only(path: str, texts: list[str], sizes: np.ndarray) -> list[int]:
    out: list[int] = []
    for a, b in balanced(sizes):
        out += [len(e.ids) for e in tokenizer(path).encode_batch_fast(texts[a:b], add_special_tokens=False)]
    return out


def _counts(path: str, id_column: str, text_column: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for b in slices(batches, text_column):
            buf, offsets = flat(b.column(text_column))
            starts, ends, first = safe_cuts(buf, offsets)
            keys, at, where = distinct(hashes(buf, starts, ends))
            s, e = starts[where], ends[where]

            def compute(missing, buf=buf, s=s, e=e):
                return lengths_only(path, texts_of(buf, s[missing], e[missing]), (e - s)[missing])

            values = np.array(_cache(path).get(keys, compute), np.int64)
            total = np.append(0, np.cumsum(values[at])) if len(keys) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(id_column), pa.array(np.diff(offsets)), pa.array(np.diff(total[first]))],
                [id_column, "n_bytes", "n_tokens"],
            )

    return run


def count_tokens(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``n_bytes`` and ``n_tokens`` of every row, for a byte-level BPE file without prefix space."""
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        _counts(path, id_column, text_column), f"`{id_column}` {kind}, n_bytes bigint, n_tokens bigint"
    )


def with_limit(counts: DataFrame, limit: int = 512) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
