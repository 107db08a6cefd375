"""Licence scans with a positional index of rare template words; DataFrame operations only.

Templates are short notices and opening passages of licences. The index holds the place of every template word that is
no function word. One pass over the texts keeps, per file, the places of indexed words (and the words of files that have
any). Document frequencies of indexed words over all files give their weight: of every mandatory phrase of every template
the ``VOTES`` words of highest inverse document frequency are looked up, at all their places in all files, and vote for
(phrase, position). Where all of them agree, the template is verified: every mandatory phrase must stand in the words
around, up to ``SLACK`` more on either side, and a share of its words. A phrase stands in a notice as it is, so its rare
words agree wherever it stands: frequencies decide what is looked up, never what is found, and no template loses votes
to the words of another. Only vocabulary-sized tables are broadcast: the templates are part of this file.

Edge cases: a null or empty text has no words, no labels and score 0; repeated rows give a row each; an empty table
gives an empty result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.decontaminate import lower_ascii, raw_words
from starloom.session import materialize, work_folder

VOTES, SLACK, LEAST_SHARE = 2, 8, 0.6

# Phrases that always label a file.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Label, words of a notice, and phrases that must stand in it.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files the software to deal in the software without restriction including without limitation the"
     " rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
     ["permission is hereby granted free of charge", "without restriction"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in"
     " compliance with the license you may obtain a copy of the license at", ["apache license", "in compliance with the license"]),
    ("gpl-3", "licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-2", "licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
     " public license as published by the free software foundation", ["gnu general public license", "free software foundation"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl-3", "under the terms of the gnu affero general public license version 3", ["gnu affero general public license"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
     " the following conditions are met", ["redistribution and use in source and binary forms", "are permitted provided"]),
    ("bsd", "released under the bsd license", ["bsd license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
     " granted", ["permission to use copy modify", "is hereby granted"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
     ["creative commons attribution sharealike"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
     ["creative commons attribution noncommercial"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights",
     ["has waived all copyright"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["unencumbered software released into the public domain"]),
]

# Words too common to index.
FUNCTION_WORDS = set("a all and any are as at be by for has in into is it may not of on or that the this to use with you can".split())

VOCABULARY = sorted({w for _, text, _ in TEMPLATES for w in text.split()} - FUNCTION_WORDS)


def _places(words: Column, phrase: str, label: str) -> Column:
    """Label and start (from 0) of every place of the phrase in ``words``."""
    parts = phrase.split()
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(words) - len(parts) + 1, F.lit(1))), lambda i: F.slice(words, i, len(parts)) == F.array(*map(F.lit, parts)))
    return F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), (i - 1).alias("at")))


def _anchors() -> list[tuple[int, int, dict[str, int]]]:
    """Of every mandatory phrase: its template, its place there, and the places of its indexed words in it."""
    out = []
    for n, (_, text, keys) in enumerate(TEMPLATES):
        words = text.split()
        for key in keys:
            parts = key.split()
            at = next(i for i in range(len(words)) if words[i : i + len(parts)] == parts)
            out.append((n, at, {w: parts.index(w) for w in parts if w not in FUNCTION_WORDS}))
    return out


def _templates(spark: SparkSession) -> DataFrame:
    """Template, label, words and keys."""
    rows = [(n, label, sorted(set(text.split())), len(text.split()), keys) for n, (label, text, keys) in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "template int, label string, own array<string>, length int, keys array<string>")


def _files(docs: DataFrame) -> DataFrame:
    """``uid``, ``doc_id``, ``n_words``, ``hits`` (word and place) and the ``words`` of files with hits."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", raw_words(F.col("text")).alias("raw"))
    hits = F.filter(
        F.transform("raw", lambda w, i: F.struct(lower_ascii(w).alias("word"), i.alias("pos"))), lambda x: x["word"].isin(VOCABULARY)
    )
    rows = rows.select("uid", "doc_id", F.size("raw").cast("bigint").alias("n_words"), hits.alias("hits"), "raw")
    words = F.when(F.size("hits") > 0, F.transform("raw", lower_ascii))
    return materialize(rows.select("uid", "doc_id", "n_words", "hits", words.alias("words")), work_folder(docs.sparkSession))


def _postings(files: DataFrame) -> DataFrame:
    """Word, template, anchor (number of the phrase), place in the template and votes needed, of the rarest words of every phrase."""
    each = files.filter(F.size("hits") > 0).select(F.explode(F.array_distinct("hits.word")).alias("word"))
    frequency = dict(each.groupBy("word").agg(F.count(F.lit(1))).collect())  # a row for each word of VOCABULARY at most
    posts = []
    for anchor, (template, at, places) in enumerate(_anchors()):
        rarest = sorted(places, key=lambda w: (frequency.get(w, 0), w))[:VOTES]
        posts += [(w, template, anchor, at + places[w], len(rarest)) for w in rarest]
    return files.sparkSession.createDataFrame(posts, "word string, template int, anchor int, place int, votes_needed int")


def _candidates(files: DataFrame) -> DataFrame:
    """``uid``, ``template`` and ``start`` (of the template in the file) wherever the rare words of a mandatory phrase agree."""
    found = files.filter(F.size("hits") > 0).select("uid", F.explode("hits").alias("hit")).select("uid", "hit.word", "hit.pos")
    met = found.join(F.broadcast(_postings(files)), "word")
    votes = met.groupBy("uid", "template", "anchor", (F.col("pos") - F.col("place")).alias("start"), "votes_needed").agg(F.count(F.lit(1)).alias("votes"))
    return votes.filter(F.col("votes") == F.col("votes_needed")).select("uid", "template", "start").distinct()


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``.

    ``doc_id``, ``n_words``, ``base`` (label and place of each fixed phrase), ``found`` (label, start and share of each
    verified template), ``labels`` and ``score``: the largest share of a template's words, 1 for a fixed phrase.
    """
    spark = docs.sparkSession
    files = _files(docs)
    candidates = _candidates(files).join(F.broadcast(_templates(spark)), "template")
    around = candidates.join(files.filter("words IS NOT NULL").select("uid", "words"), "uid")
    low = F.greatest(F.col("start") - SLACK, F.lit(0))
    near = around.withColumn("near", F.slice("words", low + 1, (F.col("start") + F.col("length") + SLACK - low).cast("int")))
    joined = F.concat(F.lit(" "), F.array_join("near", " "), F.lit(" "))
    near = near.withColumn("joined", joined)
    share = F.size(F.array_intersect("own", "near")) / F.size("own")
    verified = near.filter(
        F.forall("keys", lambda k: F.contains(F.col("joined"), F.concat(F.lit(" "), k, F.lit(" ")))) & (share >= LEAST_SHARE)
    )
    verified = verified.groupBy("uid").agg(F.collect_set(F.struct("label", "start", share.alias("share"))).alias("found"))

    fixed = F.flatten(F.array(*[_places(F.col("words"), phrase, label) for phrase, label in PHRASES.items()]))
    base = files.filter("words IS NOT NULL").select("uid", fixed.alias("base")).filter(F.size("base") > 0)
    out = files.select("uid", "doc_id", "n_words").join(base, "uid", "left").join(verified, "uid", "left")
    out = out.withColumn("base", F.coalesce("base", F.array().cast("array<struct<label:string,at:int>>")))
    out = out.withColumn("found", F.coalesce("found", F.array().cast("array<struct<label:string,start:int,share:double>>")))
    labels = F.array_sort(F.array_union(F.col("base.label"), F.col("found.label")))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("found.share"), F.lit(0.0)))
    return out.select("doc_id", "n_words", "base", "found", labels.alias("labels"), score.alias("score"))
