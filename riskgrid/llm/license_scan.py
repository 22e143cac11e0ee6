"""License scans by diagonal voting (operator 3).

Texts and templates become rolling word 2-grams, hashed from word hashes.  One
Spark join matches every text gram, a position and a hash, with every template
position of the same hash; a match votes for the diagonal text position - template
position.  Votes are summed by (row, template, diagonal); neighbouring diagonals
merge, which bridges inserted or missing words; a merged span counts when enough
of the template's positions voted inside a span of about the template's length.

Words are compared where they are, as the grams are made: a gram that has the hash
of a template's gram but other words gets another hash, so a vote means equal words
and a span's votes are verified words.

A phrase template (``exact``) accepts only full votes on a single diagonal,
which is the phrase standing there word by word.

The template side is a parameter; its rows are counted before it is broadcast,
and past ``BROADCAST_GRAMS`` the join is left to the planner.  Every text's first
gram is a mark that matches an extra template row, so texts without a match keep
their row without a second pass.  The work is linear in a text's words and votes.

Null text counts as empty.  Repeated rows each get their row.  Empty tables give
empty results.  Only the id and text columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_or_empty

WORD = rb"[0-9a-z\x80-\xff]+"  # of lower-cased UTF-8: digits, letters and whole non-ASCII characters
MARK = 0
GAP = 2  # diagonals this close belong to one span
BROADCAST_GRAMS = 200_000


def words_of(text: bytes) -> list[bytes]:
    return re.findall(WORD, text.lower())  # bytes.lower folds A-Z only


class WordHashes(dict):
    """word -> 64-bit hash, kept for the words of a task up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def gram_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    """The rolling 2-grams' hashes, from the hashes of their words."""
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        return (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + (h[1:] ^ (h[1:] >> np.uint64(29)))).view(np.int64)


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    exact: bool = False

    @property
    def words(self) -> list[bytes]:
        return words_of(self.text.encode())


# fixed values: the base phrases
BASE = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
# common license notices, shortened to the sentence that names the license
NOTICES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("mit", "Released under the MIT License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
                    " and associated documentation files, to deal in the Software without restriction"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification,"
                    " are permitted provided that the following conditions are met"),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of"
                    " the GNU General Public License as published by the Free Software Foundation"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)


def template_table(spark, templates: tuple[Template, ...]) -> DataFrame:
    """(tid, tpos, h, need, exact), and the row of the mark (tid -1)."""
    known = WordHashes()
    rows = [(-1, 0, MARK, 0, True)]
    for tid, t in enumerate(templates):
        rows += [(tid, p, int(h), len(t.words) - 1, t.exact) for p, h in enumerate(gram_hashes(t.words, known))]
    table = spark.createDataFrame(rows, "tid int, tpos int, h long, need int, exact boolean")
    return F.broadcast(table) if len(rows) <= BROADCAST_GRAMS else table


def text_grams(docs: DataFrame, id_col: str, text_col: str, templates: tuple[Template, ...]) -> DataFrame:
    """(id, th, n_words, g): the text's hash, its words' number, and its gram hashes after the mark."""
    known = WordHashes()
    meant: dict[int, set[tuple[bytes, bytes]]] = {}
    for t in templates:
        for p, h in enumerate(gram_hashes(t.words, known)):
            meant.setdefault(int(h), set()).add((t.words[p], t.words[p + 1]))
    wanted = np.sort(np.fromiter(meant, np.int64, len(meant)))

    def rows(batches):
        hashes = WordHashes()
        for b in batches:
            counts, grams = [], []
            for text in b.column(2).to_pylist():
                words = words_of(text)
                g = gram_hashes(words, hashes) if len(words) > 1 else np.zeros(0, np.int64)
                if len(wanted):
                    at = np.minimum(np.searchsorted(wanted, g), len(wanted) - 1)
                    for i in np.nonzero(wanted[at] == g)[0]:
                        if (words[i], words[i + 1]) not in meant[int(g[i])]:
                            g[i] = MARK  # other words with this hash; the mark counts in first place only
                counts.append(len(words))
                grams.append(np.concatenate([[MARK], g]))
            offsets = np.concatenate([[0], np.cumsum([len(g) for g in grams])]).astype(np.int32)
            flat = np.concatenate(grams) if grams else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counts, pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))], ["id", "th", "n_words", "g"])

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("th", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("g", T.ArrayType(T.LongType()))])
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("text")).mapInArrow(rows, schema)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: tuple[Template, ...] = BASE + NOTICES, share: float = 0.75) -> DataFrame:
    """One row per document: id, n_words, spans (template, first and last word,
    share of the template's grams that voted)."""
    key = ["id", "th", "n_words"]
    votes = (text_grams(docs, id_col, text_col, templates).select(*key, F.posexplode("g").alias("at", "h"))
             .join(template_table(docs.sparkSession, templates), "h").filter((F.col("tid") < 0) == (F.col("at") == 0))
             .select(*key, "tid", "tpos", "need", "exact", (F.col("at") - 1 - F.col("tpos")).alias("diag"))
             .groupBy(*key, "tid", "diag")
             # copies of a row repeat each vote: count positions, and rows by the mark
             .agg(F.count("*").alias("votes"), F.collect_set("tpos").alias("at"), F.first("need").alias("need"),
                  F.first("exact").alias("exact")))
    # diagonals close together are one span; those of a phrase stand alone
    order = Window.partitionBy(*key, "tid").orderBy("diag")
    starts = F.when(F.col("exact") | (F.coalesce(F.col("diag") - F.lag("diag").over(order), F.lit(GAP + 1)) > GAP), 1).otherwise(0)
    spans = (votes.withColumn("starts", starts).withColumn("span", F.sum("starts").over(order))
             .groupBy(*key, "tid", "span")
             .agg(F.sum("votes").alias("votes"), F.array_distinct(F.flatten(F.collect_set("at"))).alias("at"),
                  F.min(F.col("diag") + F.array_min("at")).alias("first"), F.max(F.col("diag") + F.array_max("at") + 1).alias("last"),
                  F.first("need").alias("need"), F.first("exact").alias("exact")))
    voted = F.size("at") / F.col("need")
    good = F.when(F.col("exact"), voted == 1).otherwise((voted >= share) & (F.col("last") - F.col("first") <= 1.5 * F.col("need") + GAP))
    labels = F.array(*[F.lit(t.label) for t in templates])
    span = F.struct("tid", F.get(labels, F.col("tid")).alias("label"), "first", "last", voted.alias("share"))
    found = spans.groupBy(*key).agg(F.sum(F.when(F.col("tid") < 0, F.col("votes"))).alias("copies"),
                                    F.collect_list(F.when((F.col("tid") >= 0) & good, span)).alias("spans"))
    return (found.withColumn("spans", F.array_sort("spans"))
            .select("id", "n_words", "spans", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("col"))


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   templates: tuple[Template, ...] = BASE + NOTICES) -> DataFrame:
    """The digest of ``scan``: places, first and last word and labels of the
    base phrases, all labels, and the best share of a template found."""
    base = F.filter("spans", lambda s: s["tid"] < len(BASE))
    names = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.transform(xs, lambda s: s["label"]))), ",")
    return scan(docs, id_col, text_col, templates).select(
        F.col("id").alias(id_col), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["first"])).cast("long").alias("last_word"),
        names(base).alias("base_labels"), names(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"))
