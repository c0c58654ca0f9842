"""Licence scan: sparse TF-IDF cosine to templates, then inheritance down the directories.

A file's headers are its lines and its windows of several lines, a licence
file is one whose whole text is close to a template or is made of such lines
for its greater part. Document frequencies are counted over all lines of all
files, for every word. Two passes keep the words' table off the driver: spans
(lines, windows, whole texts) that could reach the threshold if each rare word
had the least weight a rare word can have are written with their rare words,
and these get their true weights by a join. A file without a licence of its
own takes the one of its nearest ancestor directory that holds a licence file.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from importlib.resources import files as resources
from json import loads
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyprep.llm.common import Scratch, sized

#: Notices by which works state their licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]
#: Full texts and standard headers of the usual licences.
TEMPLATES += [(name, text) for name, text in loads((resources("surveyprep.llm") / "licences.json").read_text("utf-8"))["templates"]]
#: Lines of a window; lines without a word don't count.
WINDOWS = (2, 3, 4, 6, 8, 12, 16, 24, 32)
#: Words in at least one of so many lines have their frequencies on the driver: at most RARE times the words of an average line.
RARE = 1000
EDGES = ".,;:!?\"'()[]{}<>*#/"


def tokens(line: str) -> list[str]:
    return [t for w in line.split() if (t := w.strip(EDGES))]


class Matcher:
    """Cosines of texts to templates under given line frequencies of the templates' words."""

    def __init__(self, templates: list[tuple[str, str]], df: dict[str, int], n: int, threshold: float):
        self.threshold, self.other = threshold, log((1 + n) / 1) + 1
        self.idf = {w: log((1 + n) / (1 + df.get(w, 0))) + 1 for _, t in templates for w in tokens(t.lower())}
        self.templates = []
        for name, text in templates:
            v = {w: c * self.idf[w] for w, c in Counter(tokens(text.lower())).items()}
            norm = sqrt(sum(x * x for x in v.values()))
            self.templates.append((name, {w: x / norm for w, x in v.items()}))

    def best(self, words: list[str]) -> tuple[float, str | None]:
        """(cosine, licence) of the closest template, (0, None) if below the threshold; ties go to the first template."""
        dot, name, inside, rest = self.parts(words)
        score = dot / sqrt(inside + sum(c * c for c in rest.values()) * self.other ** 2) if dot else 0.0
        return (score, name) if score >= self.threshold else (0.0, None)

    def parts(self, words: list[str], common: dict[str, float] | None = None) -> tuple[float, str | None, float, dict[str, int]]:
        """(product with the closest template, its licence, squared weights of the known words, counts of the others)."""
        common = common or {}
        counts = Counter(words)
        v = {w: c * self.idf[w] for w, c in counts.items() if w in self.idf}
        inside = sum(x * x for x in v.values()) + sum((c * common[w]) ** 2 for w, c in counts.items() if w in common and w not in self.idf)
        dot, name = max(((sum(x * t.get(w, 0.0) for w, x in v.items()), name) for name, t in self.templates), key=lambda s: s[0])
        return dot, name, inside, {w: c for w, c in counts.items() if w not in self.idf and w not in common}


class Spans:
    """Spans of texts that may reach the threshold; a rare word weighs at least ``low``."""

    def __init__(self, m: Matcher, common: dict[str, float], low: float):
        self.m, self.common, self.low = m, common, low
        self.at = {w: i for i, w in enumerate([*m.idf, *(w for w in common if w not in m.idf)], 1)}
        self.weight = np.array([low, *m.idf.values(), *(x for w, x in common.items() if w not in m.idf)])
        self.rows = [np.array([0.0, *(m.idf[w] * t.get(w, 0.0) for w in m.idf)] + [0.0] * (len(self.at) - len(m.idf))) for _, t in m.templates]

    def span(self, lines: list[list[str]], first: int, last: int, whole: bool) -> tuple | None:
        dot, name, inside, rest = self.m.parts([w for line in lines[first:last] for w in line], self.common)
        if dot < (self.m.threshold - 1e-9) * sqrt(inside + self.low ** 2 * sum(c * c for c in rest.values())) or not dot:
            return None
        return whole, first, [] if whole else [len(x) for x in lines[first:last]], name, dot, inside, list(rest), list(rest.values())

    def of(self, texts: list[str | None]) -> list[tuple[int, list[tuple]]]:
        """(words, spans) of every text. Bounds of all spans are differences of running sums; a word's repeats count as words of their own."""
        lines = [[t for line in (text or "").lower().split("\n") if (t := tokens(line))] for text in texts]
        out = [(sum(map(len, x)), []) for x in lines]
        flat = [line for x in lines for line in x]
        if not flat:
            return out
        ids = np.fromiter((self.at.get(w, 0) for line in flat for w in line), np.int64)
        starts = np.cumsum([0, *map(len, flat)])[:-1]
        norm = np.concatenate([[0.0], np.cumsum(np.add.reduceat(self.weight[ids] ** 2, starts))])
        dots = np.stack([np.concatenate([[0.0], np.cumsum(np.add.reduceat(r[ids], starts))]) for r in self.rows])
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in lines])
        begin = np.cumsum([0, *(len(x) for x in lines)])
        near = lambda a, b: (dots[:, b] - dots[:, a]).max(axis=0) + 1e-6 >= self.m.threshold * np.sqrt(norm[b] - norm[a])
        for size in (1, *WINDOWS):
            a = np.arange(len(flat) - size + 1)
            a = a[owner[a] == owner[a + size - 1]]
            for i in a[near(a, a + size)]:
                d = owner[i]
                if span := self.span(lines[d], int(i - begin[d]), int(i - begin[d]) + size, False):
                    out[d][1].append(span)
        d = np.flatnonzero(begin[1:] > begin[:-1])
        for d in d[near(begin[d], begin[d + 1])]:
            if span := self.span(lines[d], 0, len(lines[d]), True):
                out[d][1].append(span)
        return out


def scan_files(files: DataFrame, scratch: Scratch, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(key, path, licence, score, is_licence_file) from (key, path, text)."""
    vocabulary = sorted({w for _, t in templates for w in tokens(t.lower())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(seen: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        seen = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for line in (text or "").lower().split("\n"):
                    if words := set(tokens(line)):
                        seen[""] += 1
                        seen.update(words)
                if len(seen) > 300_000:
                    yield rows(seen)
                    seen = Counter()
        yield rows(seen)

    words = scratch.cut(files.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    n = next((r["n"] for r in words.where("word = ''").collect()), 0)
    # rows are bounded by the templates and by RARE, whatever the corpus
    own = files.sparkSession.createDataFrame([(w,) for w in vocabulary], "template_word string")
    df = {r["word"]: r["n"] for r in words.join(F.broadcast(own), F.col("word") == F.col("template_word")).select("word", "n").collect()}
    idf = lambda k: log((1 + n) / (1 + k)) + 1
    common = {r["word"]: idf(r["n"]) for r in words.where((F.col("word") != "") & (F.col("n") * RARE >= n)).collect()}
    low = idf(n / RARE)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = Spans(Matcher(templates, df, n, threshold), common, low)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                got = spans.of(part.column(3).to_pylist())
                found = [[dict(zip(fields, x)) for x in f] for _, f in got]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array([k for k, _ in got], pa.int64()), pa.array(found, kinds)],
                                                 names=["row", "key", "path", "n_words", "spans"])

    fields = ["whole", "first", "lens", "name", "dot", "inside", "rest", "counts"]
    kinds = pa.list_(pa.struct(list(zip(fields, [pa.bool_(), pa.int32(), pa.list_(pa.int32()), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.int64())]))))
    kind = files.schema["key"].dataType.simpleString()
    shape = "array<struct<whole:boolean,first:int,lens:array<int>,name:string,dot:double,inside:double,rest:array<string>,counts:array<bigint>>>"
    f = files.select(F.monotonically_increasing_id().alias("row"), "key", "path", "text").mapInArrow(find, f"row long, key {kind}, path string, n_words long, spans {shape}")
    f = scratch.cut(f, "spans")
    spans = f.select("row", F.posexplode("spans").alias("i", "s")).select("row", "i", "s.*")
    rest = spans.select("row", "i", F.explode(F.arrays_zip("rest", "counts")).alias("r")).select("row", "i", F.col("r.rest").alias("rest_word"), F.col("r.counts").alias("c"))
    asked = scratch.cut(rest.select("rest_word").distinct(), "asked")
    weights = words.join(sized(asked, 48), F.col("word") == F.col("rest_word")).select("word", (F.log((1 + F.lit(n)) / (1 + F.col("n"))) + 1).alias("w"))
    weights = scratch.cut(weights, "weights")
    outside = rest.join(sized(weights, 64), F.col("rest_word") == F.col("word")).groupBy("row", "i").agg(F.sum(F.pow(F.col("c") * F.col("w"), 2)).alias("outside")) \
        .withColumnsRenamed({"row": "orow", "i": "oi"})
    score = F.col("dot") / F.sqrt(F.col("inside") + F.coalesce("outside", F.lit(0.0)))
    good = spans.join(outside, (F.col("row") == F.col("orow")) & (F.col("i") == F.col("oi")), "left").withColumn("score", score).where(F.col("score") >= threshold)
    good = scratch.cut(good.select("row", "whole", "first", "lens", "name", "dot", "score"), "good")
    # the licence that most of a text speaks for: short notices also occur inside the texts of other licences
    named = good.groupBy("row", "name").agg(F.max("dot").alias("dot"), F.max("score").alias("score"), F.max("whole").alias("whole"))
    best = named.groupBy("row").agg(F.max(F.struct("dot", "score", F.col("name").alias("licence"))).alias("best"), F.max("whole").alias("whole"))
    cover = good.select("row", "first", F.posexplode("lens").alias("j", "len")).select("row", (F.col("first") + F.col("j")).alias("line"), "len").distinct() \
        .groupBy("row").agg(F.sum("len").alias("covered")).withColumnRenamed("row", "crow")
    verdict = best.join(cover, F.col("row") == F.col("crow"), "left").select(F.col("row").alias("vrow"), "best", "whole", "covered")
    verdict = scratch.cut(verdict, "verdict")
    out = f.drop("spans").join(sized(verdict, 96), F.col("row") == F.col("vrow"), "left")
    full = (F.col("n_words") > 0) & (F.coalesce("whole", F.lit(False)) | (2 * F.coalesce("covered", F.lit(0)) > F.col("n_words")))
    return scratch.cut(out.select("key", "path", F.col("best.licence").alias("licence"), F.coalesce("best.score", F.lit(0.0)).alias("score"), full.alias("is_licence_file")), "files")


def licences(files: DataFrame, id_col: str, path_col: str, text_col: str, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.6) -> DataFrame:
    """<id_col as doc_id>, path, own_licence, score, is_licence_file, licence, inherited_from of every row.

    Directories are the proper prefixes of a path at its slashes, the empty
    one (the root) included; several licence files of a directory give it the
    licence of the highest score, ties by name. A null path lies in no
    directory. Null and empty texts state no licence. Repeated rows are
    judged alike; other columns are not read; an empty table gives an empty
    result.
    """
    scratch = Scratch(files.sparkSession, "licence")
    f = scan_files(files.select(F.col(id_col).alias("key"), F.col(path_col).alias("path"), F.col(text_col).alias("text")), scratch, templates, threshold)
    parent = F.regexp_replace("path", "/?[^/]*$", "")
    dirs = f.where("is_licence_file and path is not null").groupBy(parent.alias("dir")).agg(F.max(F.struct(F.col("score"), F.col("licence"))).alias("m"))
    dirs = scratch.cut(dirs.select("dir", F.col("m.licence").alias("dir_licence")), "dirs")
    # ancestors of the directories that hold files without licence: a row per directory, not per file
    bare = f.where("licence is null and path is not null").select(parent.alias("at")).distinct()
    up = bare.select("at", F.explode(F.expr("transform(sequence(0, size(split(at, '/'))), i -> array_join(slice(split(at, '/'), 1, i), '/'))")).alias("dir_up"))
    near = up.join(sized(dirs, 128), F.col("dir_up") == F.col("dir")).groupBy("at").agg(F.max(F.struct(F.length("dir"), "dir", "dir_licence")).alias("m"))
    near = scratch.cut(near.select("at", F.col("m.dir").alias("from_dir"), F.col("m.dir_licence").alias("near_licence")), "near")
    out = f.join(sized(near, 160), F.col("licence").isNull() & (parent == F.col("at")), "left")
    return out.select(F.col("key").alias("doc_id"), "path", F.col("licence").alias("own_licence"), "score", "is_licence_file",
                      F.coalesce("licence", "near_licence").alias("licence"), F.col("from_dir").alias("inherited_from"))
