"""Quality rules: lines that many documents of a host share are removed, and documents that lose too much are rejected.

A line is compared by its words in lower case (A-Z) with every digit as 0. A line is removed from all documents of a host
(``source``) if more than ``limit`` distinct documents of the host hold it, however often each does. Exact copies count
as one document, in the lines' counts and in the host's size: what they repeat is left to near-duplicate detection. The
limit is a share of the host's distinct documents, but ``MIN_DOCUMENTS`` at least, so that a small host does not lose
chance repetitions, and ``MAX_DOCUMENTS`` at most, so that the rule does not fade as a host grows. A document is depleted
if less than ``LEAST_LEFT`` of its words stay.

Tasks compute text statistics and line hashes in numpy; counting is a two-step aggregate on hashes, first distinct
(host, line, document), then (host, line), so neither a hot host nor a hot line meets in one task.

Edge cases: a null text has no words and fails the base rule; a null source is a host of its own; repeated rows give a
row each; texts without a line break are one line; a very long text is worked on whole, in memory a few times its size;
an empty table gives an empty result; other columns pass through ``clean`` untouched, whatever their names, and are not
read by ``verdicts``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.text import LOWER, PLAIN, expand, flat, hashes, mix, slices, spans
from starloom.session import materialize, work_folder

MIN_DOCUMENTS, MAX_DOCUMENTS, HOST_SHARE, LEAST_LEFT = 10, 100, 0.002, 0.2
MIN_WORDS, WINDOW, MOST_REPEATED = 10, 5, 20
#: Text bytes per slice in ``_described``, whose arrays take about 30 times the slice; two workers of 4 MB slices and a
#: full executor heap went beyond 3000 MB.
DESCRIBE_BYTES = 1 << 20

_LINE = np.ones(256, bool)
_LINE[0x0A] = False
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_FOLD = LOWER.copy()
_FOLD[48:58] = 48
_STEP = np.uint64(0x9E3779B97F4A7C15)

_STATS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
_ROWS = f"uid bigint, doc_id bigint, mark bigint, host bigint, {_STATS}, lines array<bigint>, sizes array<bigint>"


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(flags))[offsets])


def _again(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of entries in document order: which equal another one of their document, and which are the first of their kind."""
    order = np.argsort(keys, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    k, d = keys[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    group = np.cumsum(new) - 1
    many, first = np.zeros(len(k), bool), np.zeros(len(k), bool)
    many[order] = np.bincount(group)[group] > 1 if len(k) else False
    first[order] = new
    return many, first


def _repeated_words(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words of each text that stand in a window found twice or more in it."""
    n = np.diff(first)
    doc, place = expand(np.maximum(n - WINDOW + 1, 0))
    at = first[doc] + place
    key = np.zeros(len(at), np.uint64)
    for k in range(WINDOW):
        key = mix(key * _STEP + h[at + k])
    many, _ = _again(key, doc)
    edge = np.bincount(at[many], minlength=len(h) + WINDOW + 1).astype(np.int64)
    edge[WINDOW:] -= edge[:-WINDOW].copy()
    return _per_text(np.cumsum(edge)[: len(h)] > 0, first)


def _lines(buf, offsets, starts, ends):
    """Of the lines that have a word: start, end, first word (n + 1), and the first line of each text (n + 1)."""
    line_starts, line_ends, _ = spans(buf, offsets, _LINE)
    low, high = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    has = high > low
    line_starts, line_ends, low, high = line_starts[has], line_ends[has], low[has], high[has]
    return line_starts, line_ends, low, high, np.searchsorted(line_starts, offsets)


def line_hashes(buf, starts, ends, low, high) -> np.ndarray:
    """Hash of each line's words, lower case and digits folded."""
    if not len(low):
        return np.zeros(0, np.uint64)
    line, place = expand(high - low)
    words = hashes(_FOLD[buf], starts, ends)[low[line] + place]
    return mix(np.add.reduceat(mix(words + place.astype(np.uint64) * _STEP), np.cumsum(high - low) - (high - low)))


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    uid = TaskContext.get().partitionId() << 33
    for b in slices(batches, size=DESCRIBE_BYTES):
        buf, offsets = flat(b.column("text"))
        starts, ends, first = spans(buf, offsets, PLAIN)
        lead = np.append(0, np.cumsum((buf & 0xC0) != 0x80))
        chars = np.append(0, np.cumsum(lead[ends] - lead[starts]))
        line_starts, line_ends, low, high, first_line = _lines(buf, offsets, starts, ends)
        doc, _ = expand(np.diff(first_line))
        _, once = _again(hashes(buf, line_starts, line_ends), doc)
        key = line_hashes(buf, starts, ends, low, high)
        where = pa.array(first_line.astype(np.int32))
        lists = [pa.ListArray.from_arrays(where, pa.array(v)) for v in (key.view(np.int64), high - low)]
        stats = [
            np.diff(first),
            np.diff(chars[first]),
            _per_text(_SYMBOL[buf], offsets),
            _per_text(~once, first_line),
            _repeated_words(hashes(buf, starts, ends), first),
        ]
        n = len(b)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(uid, uid + n)), *[b.column(c) for c in ("doc_id", "mark", "host")]]
            + [pa.array(s.astype(np.int64)) for s in stats]
            + lists,
            [part.split()[0] for part in _ROWS.split(", ")],
        )
        uid += n


def _marked(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, a hash of the text, and one of the host."""
    host = F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), host.alias("host"), "text")


def frequent_lines(rows: DataFrame) -> DataFrame:
    """``host`` and ``line`` of the lines that more distinct documents hold than the limit of their host."""
    texts = rows.select("host", "mark").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    limits = texts.select("host", F.least(F.greatest(HOST_SHARE * F.col("n"), F.lit(float(MIN_DOCUMENTS))), F.lit(float(MAX_DOCUMENTS))).alias("limit"))
    each = rows.select("host", "mark", F.explode(F.array_distinct("lines")).alias("line")).distinct()
    counts = each.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MIN_DOCUMENTS)
    return counts.join(limits, "host").filter(F.col("n") > F.col("limit")).select("host", "line")


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``source``, ``text``).

    ``doc_id``, ``mark`` (hash of the text), the base statistics, ``base_failed``, ``removed_lines`` (hashes),
    ``left_words`` and ``kept``.
    """
    spark = docs.sparkSession
    rows = materialize(_marked(docs).mapInArrow(_described, _ROWS), work_folder(spark))
    frequent = materialize(frequent_lines(rows), work_folder(spark))
    lines = rows.select("uid", "host", F.explode(F.arrays_zip("lines", "sizes")).alias("x")).select("uid", "host", F.col("x.lines").alias("line"), F.col("x.sizes").alias("size"))
    gone = lines.join(frequent, ["host", "line"]).groupBy("uid").agg(F.sum("size").alias("gone"), F.collect_set("line").alias("removed_lines"))
    out = rows.drop("lines", "sizes").join(gone, "uid", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    stats = [part.split()[0] for part in _STATS.split(", ")]
    return out.select(
        "doc_id", "mark", *stats, failed.alias("base_failed"), "removed_lines", left.alias("left_words"),
        (~failed & (left >= LEAST_LEFT * F.col("n_words"))).alias("kept"),
    )


def _without(name: str):
    """Takes the lines whose hashes column ``name`` lists out of ``text``; the other columns stay as they are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            gone = b.column(name).to_pylist()
            touched = [i for i, g in enumerate(gone) if g and texts[i]]
            if touched:
                buf, offsets = flat(pa.array([texts[i] for i in touched]))
                starts, ends, _ = spans(buf, offsets, PLAIN)
                line_starts, line_ends, low, high, first = _lines(buf, offsets, starts, ends)
                key, data = line_hashes(buf, starts, ends, low, high).view(np.int64), buf.tobytes()
                for j, i in enumerate(touched):
                    drop, out, at = set(gone[i]), [], int(offsets[j])
                    for x in range(first[j], first[j + 1]):
                        if int(key[x]) in drop:
                            out.append(data[at : line_starts[x]])
                            at = min(int(line_ends[x]) + 1, int(offsets[j + 1]))
                    out.append(data[at : offsets[j + 1]])
                    texts[i] = b"".join(out).decode()
            at = b.schema.get_field_index("text")
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type)).drop_columns([name])

    return run


def _unused(name: str, columns: Iterable[str]) -> str:
    """``name``, longer until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def clean(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns, without the lines above the limits.

    ``n_chars``, if there is such a column, is counted again where lines went.
    """
    key, mark, lines = (_unused(n, docs.columns) for n in ("__id", "__mark", "removed_lines"))
    kept = verdicts(docs).filter("kept").groupBy(F.col("doc_id").alias(key), F.col("mark").alias(mark))
    nothing = F.array().cast("array<bigint>")
    kept = kept.agg(F.array_sort(F.flatten(F.collect_set(F.coalesce("removed_lines", nothing)))).alias(lines))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(mark))
    out = docs.join(kept, same).select(*[F.col(f"`{c}`") for c in docs.columns], lines)
    cleaned = out.mapInArrow(_without(lines), docs.schema)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned
