"""Licences of files: notices by TF-IDF cosine to templates, inherited along directories."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import bounded, stored

#: Notices as files state them (fixed values): a code and a text. A code may have several.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("proprietary", "All rights reserved."),
)
#: Names of files that hold the licence of their directory.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|copyright|notice|unlicense)([.-].*)?$"
_NOT_WORD = "[^a-z0-9]+"


def _words(text: str) -> list[str]:
    return [w for w in re.split(_NOT_WORD, text.lower()) if w]


def _all_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _NOT_WORD), "")


def document_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n): the rows that hold each word; the empty word stands for every row."""
    words_ = F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), _NOT_WORD)))
    return docs.select(F.explode(words_).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _windows(lines: DataFrame, needed: Column, longest: int) -> DataFrame:
    """(row, line, size, words) of the windows of adjacent lines, each once, from its first line.

    No line of a window is without words, and without its last line it has fewer than
    ``longest`` words. Only windows with a needed word are listed. A line sees as
    many lines ahead as a window can have, so the work for a line is bounded.
    """
    ahead = Window.partitionBy("row").orderBy("line").rowsBetween(0, longest)
    seen = lines.withColumns({
        "ahead": F.collect_list("words").over(ahead), "near": F.max(F.arrays_overlap("words", needed)).over(ahead)
    }).filter(F.col("near") & (F.size("words") > 0))

    def grow(so_far: Column, own: Column) -> Column:
        fits = so_far["open"] & (F.size(own) > 0) & (so_far["words"] < longest)
        return F.struct(
            F.when(fits, so_far["size"] + 1).otherwise(so_far["size"]).alias("size"),
            F.when(fits, so_far["words"] + F.size(own)).otherwise(so_far["words"]).alias("words"), fits.alias("open"),
        )

    start = F.struct(F.lit(0).alias("size"), F.lit(0).alias("words"), F.lit(True).alias("open"))
    sizes = F.sequence(F.lit(1), F.aggregate("ahead", start, grow)["size"])
    windows = seen.select("row", "line", "ahead", F.explode(sizes).alias("size"))
    words_ = F.flatten(F.slice("ahead", 1, F.col("size")))
    return windows.select("row", "line", "size", words_.alias("words")).filter(F.arrays_overlap("words", needed))


def strong_words(vector: dict[str, float], least: float) -> set[str]:
    """The words without which no text reaches the cosine ``least`` to a template of unit length.

    The lightest words are weak as long as their part of the vector is shorter than
    ``least``: by the inequality of Cauchy and Schwarz they alone cannot reach it.
    """
    length = 0.0
    strong = set(vector)
    for word, weight in sorted(vector.items(), key=lambda item: (item[1], item[0])):
        length += weight * weight
        if math.sqrt(length) >= least * (1 - 1e-9):
            break
        strong.discard(word)
    return strong


def notices(
    docs: DataFrame, least: float = 0.6, id_col: str = "doc_id", text_col: str = "text", path: Column | None = None,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
) -> DataFrame:
    """doc_id, path, and code, score and line of the best notice of each row (NULL if none reaches ``least``).

    Every line of a text, every window of adjacent lines that are not blank, and the
    whole text of a file named like a licence, is compared with each template by the
    cosine of their words' weights: occurrences times ln((1 + rows) / (1 + rows with the
    word)) + 1, for all words, so that a line scores the same in a larger table of like
    texts. A window takes lines until it has as many words as the longest template, so a
    notice wrapped over lines is seen whole. Ties go to the fewest lines, the first line,
    then the smallest code. Texts without a word that some template needs to reach
    ``least`` are left unsplit; that loses nothing.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(path, F.lit("")) if path is not None else F.coalesce(F.col("path"), F.lit(""))).alias("path"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    counts = stored(document_counts(texts, "text"))
    sets = [(code, Counter(_words(text))) for code, text in templates]
    vocabulary = sorted({w for _, own in sets for w in own})
    found = {r.word: r.n for r in counts.filter(F.col("word").isin("", *vocabulary)).collect()}
    rows = found.get("", 0)
    idf = {w: math.log((1 + rows) / (1 + found.get(w, 0))) + 1 for w in vocabulary}
    unit = []
    for code, own in sets:
        norm = math.sqrt(sum((n * idf[w]) ** 2 for w, n in own.items()))
        unit.append((code, {w: n * idf[w] / norm for w, n in own.items()}))
    strong = sorted(set().union(*(strong_words(v, least) for _, v in unit)))
    needed = F.array(*[F.lit(w) for w in strong]) if strong else F.array().cast("array<string>")
    longest = max((sum(own.values()) for _, own in sets), default=0)

    # Only texts with a needed word go on; the other rows keep no text.
    own = stored(texts.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "text", F.when(F.arrays_overlap(_all_words(F.col("text")), needed), F.col("text"))
    ))
    lines = own.filter("text is not null").select("row", F.posexplode(F.split("text", "\n")).alias("line", "said"))
    windows = _windows(lines.select("row", "line", _all_words(F.col("said")).alias("words")), needed, longest).withColumn("whole", F.lit(False))
    named = own.filter(F.col("text").isNotNull() & F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE))
    files = named.select("row", F.lit(0).alias("line"), F.lit(1).alias("size"), _all_words(F.col("text")).alias("words"), F.lit(True).alias("whole"))
    key = ["row", "line", "size", "whole"]
    held = windows.unionByName(files).select(*key, F.explode("words").alias("word")).groupBy(*key, "word").agg(F.count(F.lit(1)).alias("times"))
    weight = F.col("times") * (F.log(F.lit(1.0 + rows) / (1 + F.col("n"))) + 1)
    weighed = stored(held.join(counts, "word").select(*key, "word", weight.alias("weight")))
    norms = weighed.groupBy(*key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    table = spark.createDataFrame(
        [(w, k, code, v) for k, (code, vector) in enumerate(unit) for w, v in vector.items()], "word string, template int, code string, part double"
    )
    dots = weighed.join(F.broadcast(table), "word").groupBy(*key, "template", "code").agg(F.sum(F.col("weight") * F.col("part")).alias("dot"))
    scored = dots.join(norms, key).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).filter(F.col("score") >= least)
    best = scored.groupBy(F.col("row").alias("b_row")).agg(F.min(F.struct((-F.col("score")).alias("minus"), "size", "line", "code")).alias("best"))
    return own.join(best, F.col("row") == F.col("b_row"), "left").select(
        "doc_id", "path", F.col("best.code").alias("code"), (-F.col("best.minus")).alias("score"), F.col("best.line").cast("int").alias("line"),
    )


def scan(
    docs: DataFrame, least: float = 0.6, id_col: str = "doc_id", text_col: str = "text", path: Column | None = None,
    declares: Column | None = None, templates: tuple[tuple[str, str], ...] = TEMPLATES,
) -> DataFrame:
    """doc_id, path, licence, score, line and inherited_from of every row.

    A row with a notice of its own has that licence. Another row takes the licence
    of its nearest ancestor directory that has one (inherited_from; '' is the root);
    without any, its licence is NULL. A directory has the licence that most of its
    declaring rows state, the smallest code if several are as frequent; rows declare
    where ``declares`` (over path, code, line) holds, by default files named like a
    licence. NULL texts and paths count as empty; rows that repeat an id are scanned
    each. An empty table gives an empty result.

    Scale: texts are read twice, once to count words and once to find those that can hold
    a notice; only lines of these are shuffled. Whole texts count, however long: windows
    are listed line by line, not in one array. Columns other than those named are not
    read. Directories are reduced to one row each before they
    meet their ancestors, and files meet directories in an equi-join.
    """
    own = stored(notices(docs, least, id_col, text_col, path, templates).withColumn("parts", F.split("path", "/")))
    depth = F.greatest(F.size("parts") - 1, F.lit(0))
    own = own.withColumn("directory", F.array_join(F.slice("parts", 1, depth), "/"))
    spoken = F.element_at("parts", -1).rlike(LICENCE_FILE) if declares is None else declares
    votes = own.filter(F.col("code").isNotNull() & spoken).groupBy("directory", "code").agg(F.count(F.lit(1)).alias("n"))
    first = Window.partitionBy("directory").orderBy(F.desc("n"), "code")
    stated = votes.withColumn("rank", F.row_number().over(first)).filter("rank = 1").select(
        F.col("directory").alias("ancestor"), F.col("code").alias("licence")
    )
    directories = own.select("directory").distinct()
    parts = F.split("directory", "/")
    above = F.when(F.col("directory") == "", F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    )
    nearest = stored(
        directories.withColumn("ancestor", F.explode(above)).join(stated, "ancestor")
        .groupBy(F.col("directory").alias("n_directory"))
        .agg(F.max_by(F.struct("licence", "ancestor"), F.length("ancestor")).alias("near"))
    )
    files = own.join(bounded(nearest, nearest.count()), F.col("directory") == F.col("n_directory"), "left")
    return files.select(
        "doc_id", "path", F.coalesce("code", "near.licence").alias("licence"), "score", "line",
        F.when(F.col("code").isNull(), F.col("near.ancestor")).alias("inherited_from"),
    )
