"""Operator 6, licence scan by a positional rare-token index, in DataFrame
functions only.

Words are runs of ASCII letters and digits and of non-ASCII characters,
after ASCII letters are lowered. Base labels are the places where fixed
phrases stand word by word. The method finds more: the words of the licence
templates get their inverse document frequency from all documents; each
template is indexed by its rarest words with their positions. All of these
words that a document holds look up the postings (template, position); hits
that agree on the relative position (place in the document less place in
the template) add up their weights. A template whose best alignment holds
at least ``MIN_SCORE`` of its indexed weight, and whose mandatory key
phrases all stand in the document, is a label; the best alignment's share, to nine digits, is the score.

Defined results: null text is empty (no words, no labels, score 0);
repeated rows are scanned one by one; ties between words go by the word;
very long texts are scanned whole; an empty table gives an empty result.

At scale: two passes over the text (document frequencies, then scan). What
is shuffled is one row a licence word and task, then the few hits of the
documents that hold rare licence words, partially summed by (row, template,
relative position). The postings are bounded by the fixed templates.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.common import LOWER, UPPER, read_documents, text_of
from pitchline.operators.ranking import materialize

BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Phrases and labels of the base scan.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices as they stand in files, with the phrases that must be found.
TEMPLATES = {
    "agpl": ("licensed under the gnu affero general public license version 3", ["affero general public license"]),
    "apache": ("licensed under the apache license version 2 0 the license you may not use this file except in "
               "compliance with the license", ["apache license"]),
    "artistic": ("this package is distributed under the terms of the artistic license 2 0", ["artistic license"]),
    "boost": ("distributed under the boost software license version 1 0", ["boost software license"]),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ["redistribution and use", "source and binary forms"]),
    "cc-by": ("this work is licensed under a creative commons attribution 4 0 international license",
              ["creative commons attribution"]),
    "cc-by-nc": ("licensed under cc by nc 4 0", ["cc by nc"]),
    "cc0": ("to the extent possible under law the author has waived all copyright and related or neighboring rights "
            "to this work", ["waived all copyright"]),
    "epl": ("this program and the accompanying materials are made available under the terms of the eclipse public "
            "license", ["eclipse public license"]),
    "gpl": ("this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ["permission to use copy modify", "hereby granted"]),
    "lgpl": ("licensed under the gnu lesser general public license version 3", ["lesser general public license"]),
    "mit": ("released under the mit license permission is hereby granted free of charge to any person obtaining a "
            "copy of this software", ["mit license"]),
    "mit-text": ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files", ["permission is hereby granted free of charge"]),
    "mpl": ("this source code form is subject to the terms of the mozilla public license v 2 0",
            ["mozilla public license"]),
    "unlicense": ("this is free and unencumbered software released into the public domain",
                  ["unencumbered software", "public domain"]),
}
#: Rarest words by which a template is indexed.
INDEXED = 6
MIN_SCORE = 0.5


def words_of(text: Column) -> Column:
    lowered = F.translate(text, UPPER, LOWER)
    return F.filter(F.split(lowered, BREAKS), lambda w: w != "")


def document_frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """The number of documents, and of those that hold each template word.
    The driver gets one row a template word at most."""
    vocabulary = sorted({w for text, _ in TEMPLATES.values() for w in text.split()})
    found = docs.select(F.explode(F.concat(
        F.array(F.lit("")), F.array_intersect(words_of(text_of()), F.array(*map(F.lit, vocabulary))))).alias("w"))
    df = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return df.pop("", 0), df


def build_index(n_docs: int, df: dict[str, int]) -> tuple[list[tuple[str, str, int, float]], list[str]]:
    """Postings (word, template, position, share of the template's weight),
    and the indexed words from the highest IDF down."""
    idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) + 1e-6 for text, _ in TEMPLATES.values() for w in text.split()}
    postings, used = [], set()
    for name, (text, _) in sorted(TEMPLATES.items()):
        words = text.split()
        rare = sorted(set(words), key=lambda w: (-idf[w], w))[:INDEXED]
        places = [(w, i) for i, w in enumerate(words) if w in rare]
        total = sum(idf[w] for w, _ in places)
        postings += [(w, name, i, idf[w] / total) for w, i in places]
        used |= set(rare)
    return postings, sorted(used, key=lambda w: (-idf[w], w))


def _starts(words: str, phrase: str) -> Column:
    """Where the phrase's words stand consecutively in the array column."""
    parts = phrase.split()
    return F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), lambda i: reduce(
        lambda a, b: a & b, [F.get(words, i + k) == p for k, p in enumerate(parts)]))


def scan(docs: DataFrame) -> DataFrame:
    n_docs, df = document_frequencies(docs)
    postings, used = build_index(n_docs, df)
    rows = docs.select("doc_id", words_of(text_of()).alias("words"))
    rows = rows.withColumn("spaced", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    none = F.array().cast("array<int>")
    rows = rows.select(
        "*", *(F.when(F.contains("spaced", F.lit(f" {p} ")), _starts("words", p)).otherwise(none).alias(f"at_{k}")
               for k, p in enumerate(BASE)),
        F.array_intersect(F.array(*map(F.lit, used)), "words").alias("rare"))
    places = F.concat(*(f"at_{k}" for k in range(len(BASE))))
    verified = F.array_compact(F.array(*(
        F.when(reduce(lambda a, b: a & b, [F.contains("spaced", F.lit(f" {p} ")) for p in phrases]), F.lit(name))
        for name, (_, phrases) in sorted(TEMPLATES.items()))))
    nothing = F.array().cast("array<string>")
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"), F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_compact(F.array(*(F.when(F.size(f"at_{k}") > 0, F.lit(label))
                                  for k, label in enumerate(BASE.values())))).alias("base"),
        F.when(F.size("rare") > 0, verified).otherwise(nothing).alias("verified"),
        F.when(F.size("rare") > 0, F.filter(F.transform("words", lambda w, i: F.struct(
            i.alias("pos"), w.alias("word"))), lambda h: F.array_contains("rare", h["word"]))).alias("hits"))
    rows = materialize(rows, "licences")
    index = rows.sparkSession.createDataFrame(postings, "word string, template string, tpos int, share double")
    hits = (rows.where(F.size("verified") > 0)
            .select("row", "verified", F.explode("hits").alias("h")).select("row", "verified", "h.*")
            .join(F.broadcast(index), "word").where(F.expr("array_contains(verified, template)")))
    aligned = (hits.groupBy("row", "template", (F.col("pos") - F.col("tpos")).alias("shift"))
               .agg(F.sum("share").alias("score"))
               .groupBy("row", "template").agg(F.max("score").alias("score")).where(F.col("score") >= MIN_SCORE)
               .groupBy("row").agg(F.collect_set("template").alias("found"), F.max("score").alias("score")))
    joined = rows.drop("hits", "verified").join(aligned, "row", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("found", nothing)))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.round(F.least(F.coalesce("score", F.lit(0.0)), F.lit(1.0)), 9).alias("score"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_documents(spark, sf_dir))
