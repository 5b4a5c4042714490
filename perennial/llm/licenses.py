"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

A file is told by two things: a line or a window of its words that matches a
template, and the licence files of the nearest directory above it. Lines,
windows and templates are TF-IDF vectors over their words.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.llm import arrow
from perennial.llm.license_texts import TEXTS
from perennial.session import stage

# Lowest cosine of a match.
THRESHOLD = 0.8

# The wording by which licences are named in headers, and openings of their texts.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("proprietary", "All rights reserved."),
]
# Fixed value: words that most English texts have.
COMMON = frozenset("a and are as by for from in is it may not of or that the this to with work you".split())
# Fixed value: templates of so many words are header blocks or licence texts, which come before a licence's mere name.
TEXT_WORDS = 20
# Names without a version, and the one that stands only where a file grants no licence.
UNVERSIONED = frozenset(("GPL", "LGPL", "AGPL"))
RESERVED = "proprietary"
_PYTHON_WORD = re.compile(r"[^\W_]+")

Templates = list[tuple[str, str]]


def template_words(templates: Templates, threshold: float = THRESHOLD) -> tuple[list[tuple], float, list[str]]:
    """The templates' vectors as ``(word, idf, template, license, weight)``, the IDF of other words, key words.

    Weights are TF-IDF over the templates, normed to one. A line that reaches
    the threshold with a template shares one of its key words: without them
    the template's vector is shorter than the threshold. Any choice of words
    will do for that; the most common ones are taken last and long ones first,
    which other lines seldom have.
    """
    counts = [Counter(_PYTHON_WORD.findall(text.lower())) for _, text in templates]
    frequency = Counter(word for c in counts for word in c)
    idf = {word: math.log((len(templates) + 1) / (n + 1)) + 1 for word, n in frequency.items()}
    rows, keys = [], set()
    for number, ((name, _), count) in enumerate(zip(templates, counts, strict=True)):
        raw = {word: n * idf[word] for word, n in count.items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        rows += [(word, idf[word], number, name, w / norm) for word, w in raw.items()]
        left = 1.0
        for word, w in sorted(raw.items(), key=lambda x: (x[0] not in COMMON, len(x[0]), x[0]), reverse=True):
            if left < (threshold - 1e-6) ** 2:
                break
            keys.add(word)
            left -= (w / norm) ** 2
    return rows, math.log(len(templates) + 1) + 1, sorted(keys)


class Book:
    """Templates as vectors, and the search for them in the words of a file."""

    def __init__(self, templates: Templates, threshold: float):
        rows, self.other, keys = template_words(templates, threshold)
        self.names = [name for name, _ in templates]
        self.lengths = [len(_PYTHON_WORD.findall(text.lower())) for _, text in templates]
        self.threshold, self.keys = threshold, frozenset(keys)
        self.idf = {word: idf for word, idf, *_ in rows}
        self.place = {word: i for i, word in enumerate(self.idf)}
        self.weights = np.zeros((len(self.place), len(templates)))
        for word, _, number, _, w in rows:
            self.weights[self.place[word], number] = w
        self.sizes = (self.weights > 0).sum(axis=0)
        self.words = [{word for word, i in self.place.items() if self.weights[i, t] > 0} for t in range(len(templates))]
        self.ranks = [
            3 if name == RESERVED else 2 if name in UNVERSIONED else int(size < TEXT_WORDS)
            for name, size in zip(self.names, self.lengths, strict=True)
        ]

    def near(self, words: set[str]) -> np.ndarray:
        """Templates that some of these words can reach: the cosine is at most the length of what they share."""
        shared = self.weights[[self.place[word] for word in self.place.keys() & words]]
        return np.flatnonzero((shared**2).sum(axis=0) >= (self.threshold - 1e-6) ** 2)

    def line(self, words: list[str]) -> list[tuple[int, float]]:
        """Templates that the words as one vector match, with the score."""
        count = Counter(words)
        x = {word: n * self.idf.get(word, self.other) for word, n in count.items()}
        known = [word for word in x if word in self.place]
        dots = np.array([x[w] for w in known]) @ self.weights[[self.place[w] for w in known]]
        scores = np.round(dots / math.sqrt(sum(v * v for v in x.values())), 6)
        return [(int(t), float(scores[t])) for t in np.flatnonzero(scores >= self.threshold)]

    def windows(self, words: list[str], templates: np.ndarray) -> list[tuple[int, int, int, float]]:
        """``(template, start, end, score)`` of the windows of a template's length that match it.

        Of matching windows that start side by side only the best one is told.
        A file shorter than the template is one window. A window has more than
        half of the template's distinct words: one rare word said again and
        again is no match.
        """
        n = len(words)
        local: dict[str, int] = {}
        ids = np.fromiter((local.setdefault(word, len(local)) for word in words), np.int64, n)
        idf = np.array([self.idf.get(word, self.other) for word in local])
        squares = idf[ids] ** 2
        at = np.arange(n)
        keys = np.sort(ids * (n + 1) + at)

        def count(of, low, high):
            """How often words stand from ``low`` on and before ``high``."""
            return np.searchsorted(keys, of * (n + 1) + high) - np.searchsorted(keys, of * (n + 1) + low)

        norms: dict[int, np.ndarray] = {}
        found = []
        for t in templates:
            size = min(self.lengths[t], n)
            if size not in norms:
                first = (squares[:size] * (2 * count(ids[:size], 0, at[:size]) + 1)).sum()
                p = at[: n - size]
                left = squares[p] * (2 * count(ids[p], p, p + size) - 1)
                come = squares[p + size] * (2 * count(ids[p + size], p + 1, p + size) + 1)
                norms[size] = np.sqrt(first + np.concatenate([[0.0], np.cumsum(come - left)]))
            gain = np.array([self.weights[self.place[w], t] if w in self.place else 0.0 for w in local]) * idf
            total = np.concatenate([[0.0], np.cumsum(gain[ids])])
            scores = np.round(np.minimum((total[size:] - total[: n - size + 1]) / norms[size], 1.0), 6)
            hits = np.flatnonzero(scores >= self.threshold)
            own, least = self.words[t], self.sizes[t] / 2
            hits = hits[[len(own.intersection(words[s : s + size])) > least for s in hits.tolist()]] if len(hits) else hits
            if not len(hits):
                continue
            for run in np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1):
                start = int(run[scores[run].argmax()])
                found.append((int(t), start, start + size, float(scores[start])))
        return found


def find(text: str, lines: Book, texts: Book) -> tuple[str, float, int] | None:
    """License, score and rank of a text's best match, None without one.

    A match of which half lies in that of a template half again as long is
    part of the longer one: a sentence of a whole licence text tells no
    licence of its own. Header blocks and licence texts come first, then
    names, names without a version, and reservations of rights; then the
    highest score stands, of equal ones the first by name.
    """
    words = _PYTHON_WORD.findall(text.lower())
    distinct = set(words)
    near = texts.near(distinct)
    # (words of the template, start, end, score, name, rank)
    matches = []
    if len(near):
        matches = [(texts.lengths[t], s, e, score, texts.names[t], texts.ranks[t]) for t, s, e, score in texts.windows(words, near)]
    if len(lines.near(distinct)):
        start = 0
        for line in text.lower().split("\n"):
            own = _PYTHON_WORD.findall(line)
            if not lines.keys.isdisjoint(own):
                end = start + len(own)
                matches += [(lines.lengths[t], start, end, score, lines.names[t], lines.ranks[t]) for t, score in lines.line(own)]
            start += len(own)
    # the longest template over each word so far
    over = np.zeros(len(words), np.int64)
    left = []
    for size, start, end, score, name, rank in sorted(matches, reverse=True):
        if 2 * np.count_nonzero(2 * over[start:end] >= 3 * size) < end - start:
            left.append((rank, -score, name))
            over[start:end] = np.maximum(over[start:end], size)
    if not left:
        return None
    rank, score, name = min(left)
    return name, -score, rank


def detect(
    files: DataFrame, id_col: str = "path", text: str = "text", templates: Templates | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """``(id, license, score)`` of the files with a line or window that matches a template.

    Every line of the whole text is a vector, and so is every window of a
    template's length over its words, across lines: text around a licence
    makes no difference, and a header block or licence file is matched as one.
    Lines are compared with the one-sentence templates, windows with these and
    with whole texts, headers, titles and tags; given templates serve for
    both. Files that lack the words a match needs are left at once, the rest
    are read where they lie. Null and empty texts, and an empty table, give no
    rows; rows that repeat an id are one file.
    """
    return _detect(files, id_col, text, templates, threshold).select("id", "license", "score")


def _detect(files: DataFrame, id_col: str, text: str, templates: Templates | None, threshold: float = THRESHOLD) -> DataFrame:
    """``detect`` with the ``rank`` of each match."""
    if threshold < THRESHOLD:
        raise ValueError(f"key words hold from a threshold of {THRESHOLD} on")
    lines = Book(templates or TEMPLATES, threshold)
    texts = Book(templates or TEMPLATES + TEXTS, threshold)
    rows = files.where(F.col(text).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    fields = [
        T.StructField("id", rows.schema["id"].dataType),
        T.StructField("license", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
    ]

    def run(batch: pa.RecordBatch) -> dict | None:
        found = [(i, *best) for i, one in enumerate(batch.column(1).to_pylist()) if (best := find(one, lines, texts))]
        if not found:
            return None
        places, names, scores, ranks = (list(values) for values in zip(*found, strict=True))
        return {"id": batch.column(0).take(pa.array(places)), "license": names, "score": scores, "rank": ranks}

    return (
        arrow.flat_map(rows, run, T.StructType(fields))
        .groupBy("id")
        .agg(_best().alias("best"))
        .select("id", "best.license", "best.score", "best.rank")
    )


def _best() -> Column:
    """The match of the lowest rank, then of the highest score, of equal ones the first license by name."""
    low = F.min(F.struct("rank", (-F.col("score")).alias("s"), F.col("license").alias("license")))
    return F.struct(low["license"].alias("license"), (-low["s"]).alias("score"), low["rank"].alias("rank"))


def parent(path: Column) -> Column:
    """The directory of a path, the empty string at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherit(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """``(directory, license, origin)``: each directory's nearest licensed one, itself or above it.

    Works on distinct directories, so one that holds a third of all files is
    one row; a directory gives one row for each level above it. A null directory
    has none above it and gives no row; an empty table gives none either.
    """
    distinct = directories.select("directory").distinct()
    parts = F.split("directory", "/")
    above = distinct.select(
        "directory", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")
    ).select("directory", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("origin"))
    return (
        above.join(licensed.select(F.col("directory").alias("origin"), "license"), "origin")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "origin", "license")).alias("near"))
        .select("directory", "near.license", "near.origin")
    )


def scan(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    license_file: str = r"(?i)^(licen[cs]e|copying|notice)\b",
    templates: Templates | None = None,
) -> DataFrame:
    """``(path, header_license, score, inherited_license, inherited_from, license)`` of each file.

    A file's own header comes before what it inherits. A directory's licence is
    the best match among its licence files, told by their name. Paths part by
    ``/``; a null path is the top directory's nameless file. Rows that repeat a
    path are one file with the best of their matches; each row comes back. Other
    columns are left out.
    """
    rows = files.select(F.coalesce(F.col(path), F.lit("")).alias("path"), F.col(text).alias("text"))
    # read twice, so the files are scored once
    found = stage(_detect(rows, "path", "text", templates), "found-licenses")
    directory = parent(F.col("path"))
    name = F.regexp_extract("path", "[^/]*$", 0)
    licensed = (
        found.select(F.col("id").alias("path"), "license", "score", "rank")
        .where(name.rlike(license_file))
        .select(directory.alias("directory"), "license", "score", "rank")
        .groupBy("directory")
        .agg(_best().alias("best"))
        .select("directory", "best.license")
    )
    paths = rows.select("path", directory.alias("directory"))
    inherited = inherit(paths, licensed).select(
        "directory", F.col("license").alias("inherited_license"), F.col("origin").alias("inherited_from")
    )
    own = found.select(F.col("id").alias("path"), F.col("license").alias("header_license"), "score")
    return (
        paths.join(own, "path", "left")
        .join(inherited, "directory", "left")
        .select(
            "path",
            "header_license",
            "score",
            "inherited_license",
            "inherited_from",
            F.coalesce("header_license", "inherited_license").alias("license"),
        )
    )
