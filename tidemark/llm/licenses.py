"""License scan by diagonal voting.

Every run of `GRAM` words of a document (and of two words, for names as short as
that) is hashed, and the hashes are joined to the places of the templates that
have the same run. A match votes for a diagonal, the document place less the
template place: words in the order of a template vote alike, and a word put in
or left out moves the vote to a neighbouring diagonal. Neighbours within `SLACK`
are merged; a merged diagonal is a span, verified by the share of the
template's words that its matches cover.

A base phrase is a template with one run, found at each place where its words
stand one after another. A notice of fewer than `SHORT` words has to be covered
wholly, since a single word may tell it from another; a longer one to `COVERED`. The
templates are a fixed table, so the join sends them to the executors.

The score is the largest share of a template that a span covers, 1 with a base
phrase. A null text has no words. Rows that repeat are answered row by row. The
matches of one document meet in one task, other keys have no part in that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W

GRAM = 4
SLACK = 3
COVERED = 0.75
SHORT = 20

# Phrases and labels of the base scan.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices as their licenses publish them, and the labels for them.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
               "except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("gpl-2", "under the GNU General Public License, version 2"),
    ("gpl-3", "under the GNU General Public License, version 3"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced"),
]


def _rolled(text: str, k: int) -> list[int]:
    found = W.Words(pa.array([text], pa.large_string()))
    return _salted(W.windows(found.hashes(), found.first, k)[1], k).view(np.int64).tolist()


def _salted(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes that differ between run lengths, and from the mark of a document."""
    return W.mix(hashes + np.uint64(k)) | np.uint64(1)


#: The hash that stands first in each document and matches the template -1.
MARK = 0


def templates() -> list[tuple[int, int, int, int, str, bool]]:
    """(hash, template, place, words, label, base) of each run of each template."""
    rows = [(MARK, -1, 0, 1, None, False)]
    named = [(label, text, True) for text, label in PHRASES.items()]
    named += [(label, text, False) for label, text in NOTICES]
    for number, (label, text, base) in enumerate(named):
        size = len(W.Words(pa.array([text], pa.large_string())))
        k = size if base else GRAM
        rows += [(h, number, place, size, label, base) for place, h in enumerate(_rolled(text, k))]
    return rows


def _gram_sizes() -> list[int]:
    return sorted({GRAM} | {len(p.split()) for p in PHRASES})


def _rolling(sizes: list[int]):
    """For each document the mark and then all its runs, of each size in turn."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = W.Words(batch.column("text"))
        hashes, first, counts = found.hashes(), found.first, found.counts
        lengths = [np.maximum(counts - k + 1, 0) for k in sizes]
        begins = np.r_[0, np.cumsum(1 + sum(lengths))]
        out = np.full(begins[-1], MARK, np.uint64)
        at = begins[:-1] + 1
        for k, length in zip(sizes, lengths):
            places, values = W.windows(hashes, first, k)
            rows = np.repeat(np.arange(len(counts)), length)
            out[at[rows] + places - first[rows]] = _salted(values, k)
            at = at + length
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "row": batch.column("row"), "n_words": pa.array(counts),
            "runs": W.list_column(out.view(np.int64), begins)})
    return W.per_slice("text", work, 1_000_000)


def matches(docs: DataFrame) -> DataFrame:
    """A row for each run of a document and each template place with the same words, and one for the document."""
    spark = docs.sparkSession
    sizes = _gram_sizes()
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = (docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
            .mapInArrow(_rolling(sizes), f"doc_id {kind}, row long, n_words long, runs array<long>")
            .select("doc_id", "row", "n_words", F.posexplode("runs").alias("at", "run")))
    places = spark.createDataFrame(
        templates(), "run long, template int, place int, size int, label string, base boolean")
    # Where a run starts: its number less the mark and the runs of smaller sizes.
    start, before = F.col("at") - 1, F.lit(0)
    for smaller, k in zip(sizes, sizes[1:]):
        before = before + F.greatest(F.col("n_words") - smaller + 1, F.lit(0))
        start = F.when(F.col("at") - 1 >= before, F.col("at") - 1 - before).otherwise(start)
    # The templates are fixed: some hundred rows.
    return runs.join(F.broadcast(places), "run").select(
        "doc_id", "row", "n_words", "template", "place", "size", "label", "base",
        start.cast("long").alias("start"))


def scan(docs: DataFrame) -> DataFrame:
    """Words, base places, labels and score of each document."""
    found = matches(docs).repartition("row")
    whole = ["row", "doc_id", "n_words"]
    gram = F.when(F.col("base"), F.col("size")).otherwise(GRAM)
    diagonals = (found.withColumn("diagonal", F.col("start") - F.col("place"))
                 .groupBy(*whole, "template", "size", "label", "base", "diagonal")
                 .agg(F.array_distinct(F.flatten(F.collect_list(
                     F.sequence(F.col("place"), F.col("place") + gram - 1)))).alias("covered")))
    within = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(within)
    spans = (diagonals.withColumn("new", F.when(F.col("base") | F.isnull(apart) | (apart > SLACK), 1).otherwise(0))
             .withColumn("span", F.sum("new").over(within))
             .groupBy(*whole, "template", "size", "label", "base", "span")
             .agg(F.min("diagonal").alias("start"),
                  F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("covered"))
             .withColumn("share", F.least(F.col("covered") / F.col("size"), F.lit(1.0))))
    base = F.col("base") & (F.col("template") >= 0)
    verified = (F.col("template") >= 0) & (
        F.col("share") >= F.when(F.col("size") < SHORT, 1.0).otherwise(COVERED))
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return spans.groupBy(*whole).agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(verified, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("template") >= 0, F.col("share"))), F.lit(0.0)).alias("score")
    ).drop("row")
