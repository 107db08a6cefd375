"""Near-duplicate documents: MinHash bands find candidates, odd sketches sift them, full shingle sets confirm.

A document is the set of its distinct word shingles. Documents with equal sets form a class; one of them stands for all,
so copies never become pairs. From ``SAMPLES`` MinHash values come ``BANDS`` band keys and an odd sketch: each value
flips one bit of a bitmap, so common values cancel in the XOR of two sketches and its population count estimates the
similarity best where it is high. A second odd sketch folds the whole set: its XOR never has more bits than the sets
have differing shingles. Two documents at the similarity limit share a band with probability 1 - 4e-6.

Candidates are taken in rounds, so that a large group of near copies costs no pairs within itself:
1. Every member of a bucket is compared with its hub, the member whose buckets hold most documents; confirmed links give
   components. Rounds with other members as hubs follow, in buckets that hold several components, while they still
   connect a fair share of what is left.
2. Every member outside the bucket's component of most members is compared with all members of other components. This
   round is complete: each candidate pair is either compared or already connected.
A candidate is dropped early only if sizes or the second sketch rule it out, or if the sketches differ by more bits than
a pair at the limit shows once in a million times. What is left is confirmed on the full sets.

Edge cases: an empty or null text has no shingles and no links; a text shorter than a shingle is one shingle; a null
``doc_id`` has no component, is linked with nothing and kept; a very long text is worked on whole; rows with equal ``doc_id`` count as one document and
share its component; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.graph import components
from starloom.llm.text import LOWER, PLAIN, expand, flat, hashes, mix, slices, spans
from starloom.operators.skew import fits_broadcast
from starloom.session import discard, materialize, work_folder

SHINGLE_WORDS, PERCENT = 5, 80
ROWS, BANDS = 4, 24
SAMPLES = ROWS * BANDS
ODD_WORDS, WHOLE_WORDS = 8, 32  # of 64 bits
FAIR_SHARE = 0.5
BITMAP_WORDS = 1 << 19  # of 64 bits, to look up ids that are too many to broadcast

_RNG = np.random.Generator(np.random.PCG64(20240607))
_FLIP = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_STEP = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def odd_limit(percent: int, bits: int = ODD_WORDS * 64, samples: int = SAMPLES, sigmas: float = 5) -> int:
    """Bits in which the sketches of two sets of that similarity differ at most, but for one case in a million."""
    p = 1 - percent / 100
    unlike = 2 * min(samples, samples * p + sigmas * (samples * p * (1 - p)) ** 0.5)
    share = (1 - (1 - 2 / bits) ** unlike) / 2
    return int(bits * share + sigmas * (bits * share * (1 - share)) ** 0.5) + 1


def shingles(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted within the text, and the first of each text (n + 1)."""
    buf, offsets = flat(column)
    buf = LOWER[buf]
    starts, ends, first = spans(buf, offsets, PLAIN)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    h = hashes(buf, starts, ends)
    n = np.diff(first)
    per = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    doc, place = expand(per)
    at = first[doc] + place
    out = np.zeros(len(at), np.uint64)
    for k in range(words):
        inside = place + k < n[doc]
        out = np.where(inside, mix(out * np.uint64(0x9E3779B97F4A7C15) + h[np.minimum(at + k, len(h) - 1)]), out)
    order = np.argsort(out)
    small = doc[order].astype(np.uint16 if len(n) < 65536 else np.int64)
    order = order[np.argsort(small, kind="stable")]
    out, doc = out[order], doc[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    out, doc = out[new], doc[new]
    return out, np.searchsorted(doc, np.arange(len(n) + 1))


def _fingerprints(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sums = [np.append(np.zeros(1, np.uint64), np.cumsum(mix(sets ^ np.uint64(s)))) for s in (0x5DEECE66D, 0xD1342543DE82EF95)]
    return tuple((s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums)


def _signatures(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and odd sketches of texts that have shingles."""
    filled = np.flatnonzero(np.diff(first))
    low = np.empty((len(filled), SAMPLES), np.uint64)
    for k in range(SAMPLES):
        low[:, k] = np.minimum.reduceat((sets ^ _FLIP[k]) * _STEP[k], first[filled])
    low = mix(low + np.arange(SAMPLES, dtype=np.uint64))
    bands = np.zeros((len(filled), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + low[:, r::ROWS])
    odd = np.zeros((len(filled), ODD_WORDS), np.uint64)
    for k in range(SAMPLES):
        word, bit = low[:, k] % np.uint64(ODD_WORDS), (low[:, k] >> np.uint64(8)) % np.uint64(64)
        odd[np.arange(len(filled)), word.astype(np.int64)] ^= np.uint64(1) << bit
    return bands.view(np.int64), odd.view(np.int64)


def _whole_sketches(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the whole sets of texts that have shingles."""
    filled, bits = np.flatnonzero(np.diff(first)), WHOLE_WORDS * 64
    row, _ = expand(np.diff(first)[filled])
    cell = row * bits + (mix(sets ^ np.uint64(0x51ED270B)) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(cell, minlength=len(filled) * bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(filled), WHOLE_WORDS)


def _signed(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets, first = shingles(b.column("text"), words)
            n = np.diff(first)
            one, two = _fingerprints(sets, first)
            bands, odd = _signatures(sets, first)
            where = np.append(0, np.cumsum(n > 0)).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(where * v.shape[1], pa.array(v.reshape(-1))) for v in (bands, odd, _whole_sketches(sets, first))
            ]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n), pa.array(one), pa.array(two), *lists],
                ["doc_id", "n_shingles", "one", "two", "bands", "odd", "whole"],
            )

    return run


def _full_sets(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets, first = shingles(b.column("text"), words)
            one, _ = _fingerprints(sets, first)
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(b), [None, pa.py_buffer(first * 8), pa.py_buffer(sets)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(one), data.cast(pa.binary())], ["id", "one", "full"])

    return run


def _confirmed(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("full_a"), batch.column("full_b"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([p, q])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _differ(name: str, n: int) -> Column:
    return sum((F.bit_count(F.col(f"{name}_a")[i].bitwiseXOR(F.col(f"{name}_b")[i])) for i in range(n)), F.lit(0))


def _sizes_allow(percent: int) -> Column:
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def _whole_allows(percent: int) -> Column:
    """Whether the sketches of whole sets allow the similarity: for certain, and but for one case in a million."""
    unlike = (F.col("n_a") + F.col("n_b")) * ((100 - percent) / (100 + percent))  # differing shingles at the limit
    bits = WHOLE_WORDS * 64
    likely = bits / 2 * (1 - F.exp(-2 / bits * unlike))
    whole = _differ("whole", WHOLE_WORDS)
    return (whole <= unlike + 1e-6) & (whole <= likely + 6 * F.sqrt(likely) + 2)


def _allowed(percent: int) -> Column:
    """Whether sizes and both sketches allow the similarity."""
    return _sizes_allow(percent) & (_differ("odd", ODD_WORDS) <= odd_limit(percent)) & _whole_allows(percent)


def _sifted(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (``a``, ``n_a``, ``b``, ``n_b``) those that sizes and sketches allow, as ``a``, ``one_a``, ``b``, ``one_b``.

    Pairs of numbers travel first; sketches are fetched for what the sizes leave.
    """
    pairs = pairs.filter(_sizes_allow(percent)).distinct()
    for side in "ab":
        pairs = pairs.join(classes.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("one", "odd", "whole")]), side)
    return pairs.filter(_allowed(percent)).select("a", "one_a", "b", "one_b")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of the written ``ids``. Beyond Spark's broadcast size a bitmap of fixed size is looked
    into first, so that only texts that are wanted, and few others, are shuffled."""
    if fits_broadcast(ids):
        return docs.join(F.broadcast(ids), "doc_id", "left_semi")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_WORDS * 64))
    words = ids.select(F.shiftright(place, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(pmod(xxhash64(doc_id), 64) as int))").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))  # at most BITMAP_WORDS rows of 12 bytes
    near = docs.withColumn("__word", F.shiftright(place, 6).cast("int")).join(F.broadcast(words), F.col("__word") == F.col("word"))
    near = near.filter("(bits & shiftleft(1L, cast(pmod(xxhash64(doc_id), 64) as int))) <> 0").select("doc_id", "text")
    return near.join(ids, "doc_id", "left_semi")


def _confirm(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``one_a``, ``b``, ``one_b``) whose full sets are similar enough, as ``a``, ``b``."""
    spark = docs.sparkSession
    folders = [work_folder(spark) for _ in range(3)]
    pairs = materialize(pairs, folders[0])
    ids = materialize(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), folders[1])
    sets = _texts_of(docs, ids).mapInArrow(_full_sets(words), "id bigint, one bigint, full binary")
    sets = materialize(sets, folders[2])
    for side in "ba":
        own = sets.select(F.col("id").alias(side), F.col("one").alias(f"one_{side}"), F.col("full").alias(f"full_{side}"))
        pairs = pairs.join(own, [side, f"one_{side}"])
    found = pairs.select("a", "b", "full_a", "full_b").mapInArrow(_confirmed(percent), "a bigint, b bigint")
    found = materialize(found.distinct(), work_folder(spark))
    for folder in folders:
        discard(spark, folder)
    return found


def _ordered(second: str) -> list[Column]:
    """``a``, ``b`` and their column ``second`` (``_a``, ``_b``) of the members ``id_a`` and ``id_b``, the smaller id first."""
    low = F.col("id_a") < F.col("id_b")
    sides = (("id", "a", "b", "a"), (second, "a", "b", f"{second}_a"), ("id", "b", "a", "b"), (second, "b", "a", f"{second}_b"))
    return [F.when(low, F.col(f"{c}_{p}")).otherwise(F.col(f"{c}_{q}")).alias(name) for c, p, q, name in sides]


def _side(rows: DataFrame, side: str, *more: str) -> DataFrame:
    return rows.select("bucket", *more, *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c not in ("bucket", "main", "weight", "order")])


def _stars(rows: DataFrame, order: Column) -> DataFrame:
    """Pairs of the members of each bucket with the member that comes first; those of its component are left out."""
    hubs = rows.groupBy("bucket").agg(F.max(F.struct(order.alias("order"), "id", "n", "label")).alias("hub"))
    hubs = materialize(_side(hubs.select("bucket", "hub.*"), "b"), work_folder(rows.sparkSession))
    return _side(rows, "a").join(hubs, "bucket").filter("label_a <> label_b").select(*_ordered("n"))


def _rest(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a bucket, as far as sizes and sketches allow, as ``a``, ``one_a``, ``b``, ``one_b``.

    Members of the bucket's component of most members are compared with the others only. Sketches are compared where the
    members meet, so that a large group of documents that are somewhat alike does not become rows.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("members"))
    main = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("members", "label")).alias("main"))
    inside = rows.select("bucket", "id", "n", "label").join(materialize(main, work_folder(spark)), "bucket")
    inside = materialize(inside.join(classes, "id"), work_folder(spark))
    once = (F.col("label_b") == F.col("main")) | (F.col("id_a") < F.col("id_b"))
    pairs = _side(inside.filter("label <> main"), "a").join(_side(inside, "b", "main"), "bucket")
    return pairs.filter((F.col("label_a") != F.col("label_b")) & once & _allowed(percent)).select(*_ordered("one")).distinct()


def _labels(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """``node`` and ``label`` of all classes that are linked with another one."""
    spark = docs.sparkSession
    members = classes.select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared_at, weight_at = work_folder(spark), work_folder(spark)
    shared = materialize(members.join(materialize(buckets, work_folder(spark)), "bucket"), shared_at)
    weight = materialize(shared.groupBy("id").agg(F.sum("size").alias("weight")), weight_at)
    mixed_at = work_folder(spark)
    mixed = materialize(shared.join(weight, "id").select("bucket", "id", "n", "weight", F.col("id").alias("label")), mixed_at)
    candidates = classes.join(weight.select("id"), "id", "left_semi").select("id", "one", "odd", "whole")
    candidates = materialize(candidates, work_folder(spark))
    order, left, turn = F.col("weight"), weight.count(), 0
    for folder in (shared_at, weight_at):
        discard(spark, folder)
    links = labels = None
    while True:
        found = _confirm(_sifted(_stars(mixed, order), candidates, percent), docs, words, percent)
        if links is not None and found.isEmpty():
            break
        links = found if links is None else links.union(found)
        labels = components(links)
        now_at = work_folder(spark)
        now = mixed.drop("label").join(labels, F.col("id") == F.col("node"), "left")
        now = materialize(now.select("bucket", "id", "n", "weight", F.coalesce("label", "id").alias("label")), now_at)
        several = now.groupBy("bucket").agg((F.min("label") < F.max("label")).alias("several")).filter("several").select("bucket")
        old_at, mixed_at = mixed_at, work_folder(spark)
        mixed = materialize(now.join(materialize(several, work_folder(spark)), "bucket"), mixed_at)
        for folder in (old_at, now_at):
            discard(spark, folder)
        before, left = left, mixed.select("label").distinct().count()
        turn += 1
        order = F.xxhash64("id", F.lit(turn))
        if left > (1 - FAIR_SHARE) * before or not left:
            break
    more = _confirm(_rest(mixed, candidates, percent), docs, words, percent)
    return labels if more.isEmpty() else components(links.union(more))


def link_documents(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs`` (``doc_id``, ``text``)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = docs.mapInArrow(
        _signed(words), "doc_id bigint, n_shingles bigint, one bigint, two bigint, bands array<bigint>, odd array<bigint>, whole array<bigint>"
    )
    signed = materialize(signed, work_folder(spark))
    linkable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("n_shingles", "one", "two").agg(
        F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("bands", "odd", "whole")]
    )
    classes = materialize(classes, work_folder(spark))
    labels = _labels(docs, classes, words, percent)
    classes = classes.select("n_shingles", "one", "two", "id").join(labels, F.col("id") == F.col("node"), "left")
    classes = classes.select("n_shingles", "one", "two", F.coalesce("label", "id").alias("component_id"))
    known = linkable.select("doc_id", "n_shingles", "one", "two").join(classes, ["n_shingles", "one", "two"])
    alone = signed.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = known.select("doc_id", "n_shingles", "component_id").union(alone)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group."""
    gone = link_documents(docs, words, percent).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
