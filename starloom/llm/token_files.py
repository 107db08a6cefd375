"""Token-id files: fixed-width bit packing with offsets, in ascending document order.

Format: a folder of Parquet part files whose rows are blocks. A block holds whole documents: their ids, one more offset
than documents (in token ids, within the block), and the ids of all of them packed with ``width`` bits each, first id in
the lowest bits of the first byte. Any id is found by arithmetic: id ``i`` of a block begins at bit ``i * width``.
Parts are ranges of document ids, ``part`` and ``block`` give their order; as every block states its number of ids, the
place of a document in the whole stream follows from a sum over one number per part.

Packing and unpacking are numpy operations over whole blocks. Executors write through Spark's own committer, so a lost
task leaves nothing behind. Distinct words of a slice are encoded once.

Edge cases: a null text gives only the end id; a null document id comes first; rows that repeat a document id follow one
another, ordered by text; an empty table gives no block and an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.text import PLAIN, PieceCache, distinct, expand, flat, hashes, slices, spans, texts_of
from starloom.llm.token_counts import balanced, tokenizer

BLOCK_SCHEMA = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("offsets", T.ArrayType(T.LongType())),
        T.StructField("packed", T.BinaryType()),
    ]
)


def width_of(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` with ``width`` bits each."""
    if width == 16:  # whole bytes are the same layout
        return ids.astype("<u2").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def unpack(packed: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block; reads only the bytes they stand in."""
    if width == 16:
        return np.frombuffer(packed, "<u2", stop - start, start * 2).astype(np.uint32)
    low, high = start * width // 8, (stop * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(packed, np.uint8, high - low, low), bitorder="little")
    bits = bits[start * width - low * 8 :][: (stop - start) * width].reshape(-1, width)
    return bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


@cache
def _cache(path: str) -> PieceCache:
    return PieceCache()


def _word_ids(path: str, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, and the number of ids of each."""

    def compute(missing):
        texts, out = texts_of(buf, s[missing], e[missing]), []
        for a, b in balanced((e - s)[missing]):
            batch = tokenizer(path).encode_batch_fast(texts[a:b], add_special_tokens=False)
            out += [np.array(x.ids, "<u4").tobytes() for x in batch]
        return out

    keys, at, where = distinct(hashes(buf, starts, ends))
    s, e = starts[where], ends[where]
    values = _cache(path).get(keys, compute)
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    ids = np.frombuffer(b"".join(values), "<u4")
    counts = sizes[at]
    word, place = expand(counts)
    return ids[(np.cumsum(sizes) - sizes)[at][word] + place], counts


def encode_slice(path: str, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each with the end id, and their offsets.

    The tokenizer drops white space and joins nothing over it, so words are encoded by themselves.
    """
    buf, offsets = flat(column)
    starts, ends, first = spans(buf, offsets, PLAIN)
    ids, counts = _word_ids(path, buf, starts, ends) if len(starts) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    per_doc = np.diff(np.append(0, np.cumsum(counts))[first]) + 1
    where = np.append(0, np.cumsum(per_doc))
    out = np.empty(where[-1], np.uint32)
    last = np.zeros(len(out), bool)
    last[where[1:] - 1] = True
    out[last], out[~last] = end_id, ids
    return out, where


def _blocks(path: str, end_id: int, width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part, schema = TaskContext.get().partitionId(), None
        for number, b in enumerate(slices(batches)):
            ids, offsets = encode_slice(path, b.column("text"), end_id)
            schema = schema or pa.schema(
                [("part", pa.int32()), ("block", pa.int32()), ("width", pa.int32()), ("n_ids", pa.int64())]
                + [("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("packed", pa.binary())]
            )
            row = [[part], [number], [width], [len(ids)], [b.column("doc_id").to_pylist()], [offsets], [pack(ids, width)]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(row, schema, strict=True)], schema=schema)

    return run


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int) -> None:
    """Encode ``doc_id`` and ``text`` and write the ids as blocks below ``folder``, in ascending order of ``doc_id``."""
    width = width_of(tokenizer(path).get_vocab_size())
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(max(n, docs.rdd.getNumPartitions()), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_blocks(path, end_id, width), BLOCK_SCHEMA).write.parquet(folder)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            where = np.array(r["offsets"], np.int64)
            ids = memoryview(unpack(r["packed"], r["width"], 0, r["n_ids"]).astype("<u4"))
            check = [zlib.crc32(ids[a:b]) for a, b in zip(where[:-1].tolist(), where[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(r["doc_ids"], pa.int64()),
                    pa.array(np.full(len(check), r["part"], np.int32)),
                    pa.array(np.full(len(check), r["block"], np.int32)),
                    pa.array(where[:-1]),
                    pa.array(np.diff(where)),
                    pa.array(check, pa.int64()),
                ],
                ["doc_id", "part", "block", "at", "n_tokens", "ids_crc32"],
            )


def block_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``part``, ``block`` and the number of ids before each block.

    Blocks are summed within their part; one number per part passes through the driver.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(folder).select("part", "block", "n_ids")
    parts = sorted(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    total, starts = 0, []
    for part, n in parts:
        starts.append((part, total))
        total += n
    starts = spark.createDataFrame(starts, "part int, before bigint")
    within = blocks.withColumn("within", F.expr("sum(n_ids) OVER (PARTITION BY part ORDER BY block) - n_ids"))
    return within.join(F.broadcast(starts), "part").select("part", "block", (F.col("before") + F.col("within")).alias("first"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` from the files."""
    found = spark.read.schema(BLOCK_SCHEMA).parquet(folder).mapInArrow(
        _read, "doc_id bigint, part int, block int, at bigint, n_tokens bigint, ids_crc32 bigint"
    )
    placed = found.join(block_starts(spark, folder), ["part", "block"])
    return placed.select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, folder: str, start: int, stop: int) -> list[int]:
    """Ids ``start`` to ``stop`` of the whole stream: opens only the blocks they stand in."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    wanted = block_starts(spark, folder).join(blocks.select("part", "block", "width", "n_ids", "packed"), ["part", "block"])
    wanted = wanted.filter((F.col("first") < stop) & (F.col("first") + F.col("n_ids") > start))
    out: list[int] = []
    for r in wanted.orderBy("first").toLocalIterator():
        out += unpack(bytes(r["packed"]), r["width"], max(0, start - r["first"]), min(r["n_ids"], stop - r["first"])).tolist()
    return out
