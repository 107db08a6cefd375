"""Benchmark decontamination with a distributed positional inverted index; DataFrame operations only.

The index holds the postings (document, position) of every term that occurs in a benchmark item, one row each, written
once to the shared folder; one more posting per document, of the end mark, gives its length. Windows are matched by
offset-adjusted lists: position in the document minus position in the item is the same for all words of one occurrence.
1. Postings are counted per term, and every window takes its rarest terms as anchors.
2. Postings of anchors meet the item positions of their term; rows of one (document, item, offset) are grouped, and
   those groups stay in which some window has all its anchors.
3. The full postings of these documents are met with the items at that offset. Runs of matching positions as long as a
   window are exact phrase matches.
Common words are never anchors next to rarer ones, so no step pairs frequent terms with each other, and no step groups
by term alone except for counting, which sums before the shuffle.

Edge cases: a null or empty text has no words and no hits; a null or empty item has no window; items that repeat an id
count once; a null item id is the empty text in the digest; repeated documents give a row each; empty tables on either
side give zero hits; columns other than ``doc_id``/``text`` and ``item_id``/``text`` are not read.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import materialize, work_folder

WINDOW_WORDS = 13
ANCHORS = 2
MOST_BROADCAST = 500_000  # rows of one id each: 4 MB
_STRETCH = 64  # positions that are joined together

#: A word before A-Z become a-z.
_RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_END = ""  # no word is empty


def raw_words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_RAW_WORD), F.lit(0))


def lower_ascii(word: Column) -> Column:
    """A-Z become a-z and nothing else does; ``lower`` is the fast way where there is nothing else."""
    slow = F.translate(word, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(slow)


@dataclass
class Index:
    """Tables in the shared folder.

    ``items``: item, item_id, size, need (window length). ``places``: item, place, term. ``postings``: uid, doc_id, pos,
    term. ``end``: the term of the end mark.
    """

    items: DataFrame
    places: DataFrame
    postings: DataFrame
    end: int


def _stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    return materialize(df, work_folder(spark))


def build_index(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> Index:
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.transform(raw_words(F.col("text")), lower_ascii).alias("words"),
    )
    items = items.filter(F.size("words") > 0).distinct().withColumn("item", F.monotonically_increasing_id())
    items = _stored(spark, items.withColumn("size", F.size("words")).withColumn("need", F.least(F.lit(window), F.size("words"))))
    placed = items.select("item", F.posexplode("words").alias("place", "word"))
    end = spark.range(1).select(F.lit(_END).alias("word"))
    terms = _stored(spark, placed.select("word").union(end).distinct().withColumn("term", F.monotonically_increasing_id()))
    places = _stored(spark, placed.join(terms, "word").select("item", "place", "term"))
    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    tokens = numbered.select(
        "uid",
        "doc_id",
        F.posexplode(F.array_append(raw_words(F.col("text")), F.lit(_END))).alias("pos", "word"),
    )
    postings = tokens.select("uid", "doc_id", "pos", lower_ascii(F.col("word")).alias("word")).join(terms, "word")
    postings = _stored(spark, postings.select("uid", "doc_id", "pos", "term"))
    return Index(items.drop("words"), places, postings, terms.filter(F.col("word") == _END).first()["term"])


def anchors(index: Index, n_anchors: int = ANCHORS) -> DataFrame:
    """``item``, ``start`` of the window, and its ``anchors``: the places of its rarest terms.

    Windows with a term that occurs in no document are left out.
    """
    counts = index.postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counted = index.places.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by_item = counted.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("row"))
    starts = index.items.join(by_item, "item").select(
        "item", "need", "row", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("need"))).alias("start")
    )
    inside = F.transform(F.slice("row", F.col("start") + 1, F.col("need")), lambda x: F.struct(x["n"].alias("n"), x["place"].alias("place")))
    starts = starts.withColumn("inside", F.array_sort(inside)).filter(F.col("inside")[0]["n"] > 0)
    return starts.select("item", "start", F.slice("inside", 1, n_anchors)["place"].alias("anchors"))


def _anchored(index: Index, windows: DataFrame) -> DataFrame:
    """``uid``, ``item``, ``shift`` (document minus item position), ``place`` of the postings of anchors."""
    spark = index.postings.sparkSession
    wanted = windows.select("item", F.explode("anchors").alias("place")).distinct().join(index.places, ["item", "place"])
    wanted = _stored(spark, wanted)
    rare = index.postings.join(_stored(spark, wanted.select("term").distinct()), "term", "left_semi")
    return rare.join(wanted, "term").select("uid", "item", (F.col("pos") - F.col("place")).alias("shift"), "place")


def exact_matches(index: Index, n_anchors: int = ANCHORS) -> DataFrame:
    """``uid``, ``item``, ``first`` and ``last`` document position of every longest exact phrase match."""
    spark = index.postings.sparkSession
    windows = _stored(spark, anchors(index, n_anchors))
    met = _anchored(index, windows).groupBy("uid", "item", "shift").agg(F.collect_set("place").alias("met"))
    per_item = windows.groupBy("item").agg(F.collect_set("anchors").alias("sets"), F.min(F.size("anchors")).alias("least"))
    possible = met.join(per_item, "item").filter(
        (F.size("met") >= F.col("least")) & F.exists("sets", lambda s: F.size(F.array_except(s, F.col("met"))) == 0)
    )
    possible = _stored(spark, possible.join(index.items, "item").select("uid", "item", "shift", "size", "need"))

    stretch = F.floor(F.col("pos") / _STRETCH)
    ids = _stored(spark, possible.select("uid").distinct())
    few = ids.count() <= MOST_BROADCAST
    near = index.postings.join(F.broadcast(ids) if few else ids, "uid", "left_semi").withColumn("stretch", stretch)
    low = F.floor(F.greatest(F.col("shift"), F.lit(0)) / _STRETCH)
    asked = possible.withColumn("stretch", F.explode(F.sequence(low, F.floor((F.col("shift") + F.col("size") - 1) / _STRETCH))))
    met = asked.join(near.select("uid", "stretch", "pos", "term"), ["uid", "stretch"]).withColumn("place", F.col("pos") - F.col("shift"))
    met = met.filter((F.col("place") >= 0) & (F.col("place") < F.col("size"))).join(index.places, ["item", "place", "term"])
    order = Window.partitionBy("uid", "item", "shift").orderBy("place")
    runs = met.withColumn("run", F.col("place") - F.row_number().over(order))
    runs = runs.groupBy("uid", "item", "shift", "run").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.first("need").alias("need"))
    return runs.filter(F.col("last") - F.col("first") + 1 >= F.col("need")).select("uid", "item", "first", "last")


def proximity_matches(index: Index, slack: int, n_anchors: int = 3) -> DataFrame:
    """``doc_id``, ``item_id``, ``first``, ``last``: windows whose rarest terms all stand near their places.

    The offsets of the matched terms differ by ``slack`` at most, so words may be missing, added or changed between
    them. ``first`` and ``last`` are the smallest and the greatest offset-adjusted start.
    """
    windows = _stored(index.postings.sparkSession, anchors(index, n_anchors))
    found = _anchored(index, windows)
    # Offsets that differ by slack at most share one of two overlapping bins.
    base = F.floor(F.col("shift") / (slack + 1))
    binned = found.withColumn("bin", F.explode(F.array(base - 1, base)))
    grouped = binned.groupBy("uid", "item", "bin").agg(F.collect_set(F.struct("place", "shift")).alias("met"))
    wide = grouped.join(windows, "item").withColumn("own", F.expr("filter(met, x -> array_contains(anchors, x.place))"))
    start = wide.withColumn("at", F.explode(F.expr("array_distinct(transform(own, x -> x.shift))")))
    start = start.withColumn("near", F.expr(f"filter(own, x -> x.shift BETWEEN at AND at + {slack})"))
    full = start.filter(F.expr("size(array_except(anchors, transform(near, x -> x.place))) = 0"))
    full = full.groupBy("uid", "item").agg(
        F.min(F.col("at") + F.col("start")).alias("first"), F.max(F.expr("array_max(transform(near, x -> x.shift)) + start")).alias("last")
    )
    ids = index.postings.filter(F.col("term") == index.end).select("uid", "doc_id")
    return full.join(ids, "uid").join(index.items, "item").select("doc_id", "item_id", "first", "last").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``item_ids`` and ``contaminated``."""
    index = build_index(docs, benchmark, window)
    found = _stored(docs.sparkSession, exact_matches(index))
    before = Window.partitionBy("uid").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("uid", "first", "last").distinct().withColumn("reach", F.coalesce(F.max("last").over(before), F.lit(-1)))
    hit = F.greatest(F.col("last") - F.greatest(F.col("first") - 1, F.col("reach")), F.lit(0))
    hits = spans.groupBy("uid").agg(F.sum(hit).alias("n_hit"))
    items = found.select("uid", "item").distinct().join(index.items.select("item", "item_id"), "item")
    items = items.groupBy("uid").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    size = index.postings.filter(F.col("term") == index.end).select("uid", "doc_id", F.col("pos").cast("bigint").alias("n_words"))
    out = size.join(hits, "uid", "left").join(items, "uid", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        ids.alias("item_ids"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns; rows that share an id go together."""
    bad = contamination(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti")
