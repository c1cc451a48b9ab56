"""License notices by diagonal voting.

Every word pair of every document is joined by its hash to the places where license templates have the pair. A match
votes for a diagonal, the difference of both places. Neighbouring diagonals are merged into a band, and a band counts
as a span if enough of the template's pairs lie in it and enough of the pairs between its first and last are matched.
Phrases that must stand word for word are templates whose bands are single diagonals with every vote.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.arrow import lists, slices, texts_of
from tandem.llm.words import PLAIN, cut, grams

# Phrases that label a document wherever they stand, and their labels.
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
# Wording of public license notices.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]
PAIR = 2
SLACK = 3
COVERAGE = 0.75


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    exact: bool


TEMPLATES = [Template(label, text, True) for label, text in PHRASES] + [
    Template(label, text, False) for label, text in NOTICES]


def _pairs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word counts, the pair hashes of all texts one behind another, and the number of pairs of each text."""
    words = cut(texts, PLAIN)
    counts = words.counts
    hashes = words.hashes()
    runs = grams(hashes, PAIR)
    if len(runs):
        inside = np.repeat(np.arange(len(counts)), counts)
        runs = runs[inside[: len(runs)] == inside[PAIR - 1:]]
    return counts, runs, np.maximum(counts - PAIR + 1, 0)


def _template_places(spark, templates: list[Template]) -> DataFrame:
    counts, runs, sizes = _pairs(pa.array([template.text for template in templates]))
    owner = np.repeat(np.arange(len(templates)), sizes)
    place = np.arange(len(runs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rows = [(int(h), int(t), int(p), int(sizes[t]), templates[t].label, templates[t].exact)
            for h, t, p in zip(runs.view(np.int64), owner, place)]
    rows.append((0, -1, 0, 0, None, False))  # the mark that each document has at its start
    return spark.createDataFrame(rows, "hash bigint, template int, place int, pairs int, label string, exact boolean")


def license_spans(
    documents: DataFrame, id: str = "doc_id", text: str = "text", templates: list[Template] | None = None,
    slack: int = SLACK, coverage: float = COVERAGE,
) -> DataFrame:
    """Per row of ``documents``: id, n_words and spans, each with label, exact, first_word, last_word and coverage.

    Places count words from 0, the last word belongs to the span. An exact template has a span wherever its words stand one behind another; another
    template where a band of diagonals at most ``slack`` apart holds ``coverage`` of its pairs of words, and matched
    pairs make up as much of the span. A template needs two words. A null text has no words; every row gives a row,
    repeated rows repeated ones, a null id stays null; other columns are not read. The join is with a fixed list.
    """
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts, runs, sizes = _pairs(texts_of(part.column("text")))
                # 0 is every document's own mark; it stands before its pairs
                marked = np.insert(runs, np.cumsum(sizes) - sizes, 0).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("key"), pa.array(counts.astype(np.int64)),
                     lists(marked, sizes + 1, pa.int64())], names=["id", "key", "n_words", "pairs"])

    rows = documents.select(
        F.col(id).alias("id"), F.xxhash64(F.col(text)).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, key bigint, n_words bigint, pairs array<bigint>").select(
        "id", "key", "n_words", F.posexplode("pairs").alias("word", "hash")).withColumn("word", F.col("word") - 1)
    places = _template_places(documents.sparkSession, templates)
    document = ["id", "key", "n_words"]
    votes = found.join(F.broadcast(places), "hash").select(
        *document, "template", "label", "exact", "pairs", "word", "place",
        (F.col("word") - F.col("place")).alias("diagonal")).repartition("id", "key")
    # rows that repeat a document vote alike: counted once, while the mark counts the rows
    votes = votes.groupBy(*document, "template", "label", "exact", "pairs", "word", "place", "diagonal").agg(
        F.count("*").alias("rows"))
    along = Window.partitionBy(*document, "template").orderBy("diagonal", "place")
    allowed = F.when(F.col("exact"), 0).otherwise(slack)
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > allowed, F.lit(True)).cast("int")
    bands = votes.withColumn("opens", opens).withColumn("band", F.sum("opens").over(along)).groupBy(
        *document, "template", "label", "exact", "pairs", "band"
    ).agg(
        F.size(F.collect_set("place")).alias("n_places"), F.size(F.collect_set("word")).alias("n_matched"),
        F.min("word").alias("first"), F.max("word").alias("last"), F.max("rows").alias("rows"))
    within = F.col("n_matched") / (F.col("last") - F.col("first") + 1)
    enough = F.when(F.col("exact"), F.col("n_places") == F.col("pairs")).otherwise(
        (F.col("pairs") > 0) & (F.least(F.try_divide("n_places", "pairs"), within) >= coverage))
    span = F.struct(
        F.col("first").cast("bigint").alias("first_word"), (F.col("last") + 1).cast("bigint").alias("last_word"),
        "label", "exact", F.try_divide("n_places", "pairs").alias("coverage"))
    merged = bands.groupBy(*document).agg(
        F.array_sort(F.collect_list(F.when((F.col("template") >= 0) & enough, span))).alias("spans"),
        F.max(F.when(F.col("template") < 0, F.col("rows"))).alias("rows"))
    return merged.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("rows")))).select(
        F.col("id").alias(id), "n_words", "spans")
