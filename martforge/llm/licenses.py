"""Licence scan: a trained paragraph classifier confirmed by template comparison, DataFrame functions only.

*Training.*  Paragraph templates of every family and changed versions of them (words
dropped, in several ways) are the positive rows; a bounded sample of lines of the
corpus (``negatives`` of them, labelled unknown unless they hold most of a template or
are a part of one) are the negative ones.  Features are word 1-grams and 2-grams of the templates that
hold at least one word that is rare among the negatives.  A multinomial logistic
regression with an L1 share keeps the weights sparse.  Half of the rows calibrate it:
a temperature is chosen by their log-loss.  The model and its vocabulary have a fixed
size at most; they do not grow with the corpus.

*Scan.*  Every paragraph (line) of every whole text is split into words.  A paragraph
with none of the rare words has no feature at all and is unknown.  For the others the
weights of their n-grams are added up by a join with the weight table, and the softmax
at the calibrated temperature gives the family, or unknown.

*Confirmation.*  A predicted family stands if the paragraph holds at least ``contained``
of the words of one of its templates.

*Wrapped paragraphs.*  Runs of neighbouring non-blank lines, without comment marks, are
scanned as well, in overlapping word windows of several sizes: however the lines are
broken, a template's words lie within one window of about its size.  Of a window's
template the neighbouring words must agree, too (``paired``), so that words scattered
over prose do not count.  A run counts once for every family that none of its lines has
by itself.

Null texts have no paragraph; rows that agree in ``doc_id`` and text give the same
result each; an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm.common import written

UNKNOWN = "unknown"

# fixed values: how licences announce themselves, by family
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "This project is released under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL v3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
}
CLASSES = [UNKNOWN, *sorted(TEMPLATES)]
# fixed values: words that say nothing about a licence, whatever the sample holds
STOP_WORDS = ("a an and any are as at be but by can for form found from in including is it its later may name names not of on or "
              "person project provided that the these this to use used with without work you 0 2 3 4").split()


MARKS = r"(?m)^[ \t]*(?://+!?|/?\*+/?|#+|--+|;+|%+|<!--|>+)?[ \t\r]*"  # what a comment puts before its lines
# windows overlap by half: one of them holds a statement of up to half its size whole
SIZES = [16 << i for i in range(max(len(t.split()) for texts in TEMPLATES.values() for t in texts).bit_length() - 2)]


def words(text: Column) -> Column:
    """Lower-case words of ASCII letters, digits and inner hyphens."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9-]+", " "), " "), "")


def pairs(own: Column) -> Column:
    """The 2-grams of a list of words."""
    return F.transform(F.slice(own, F.lit(1), F.greatest(F.size(own) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, F.get(own, i + 1)))


def with_grams(df: DataFrame) -> DataFrame:
    """Adds ``grams``: the distinct 1-grams and 2-grams of ``words``."""
    return df.withColumn("grams", F.array_distinct(F.concat("words", pairs(F.col("words")))))


def paragraphs(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, at, text)``: every non-blank line of every whole text."""
    body = F.coalesce(docs["text"].cast("string"), F.lit(""))
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(body).alias("version"), body.alias("body"))
    return base.select("doc_id", "version", F.posexplode(F.split("body", "\n")).alias("at", "text")).where("trim(text) <> ''")


def runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, run, text)``: every run of two or more non-blank lines, without comment marks."""
    body = F.coalesce(docs["text"].cast("string"), F.lit(""))
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(body).alias("version"), F.regexp_replace(body, MARKS, "").alias("body"))
    cut = base.select("doc_id", "version", F.posexplode(F.split("body", r"\n(?:\s*\n)+")).alias("run", "text"))
    return cut.withColumn("text", F.trim(F.col("text"), F.lit(" \t\r\n"))).where(F.contains("text", F.lit("\n")))


def _template_rows(spark: SparkSession) -> DataFrame:
    """``(label, text)`` of the templates; text is reduced to what ``words`` keeps."""
    values = ", ".join(f"({CLASSES.index(family)}, '{text}')" for family, texts in sorted(TEMPLATES.items()) for text in texts)
    return spark.sql(f"SELECT CAST(col1 AS INT) AS label, col2 AS text FROM VALUES {values}")


def training_rows(spark: SparkSession, docs: DataFrame, negatives: int, versions: int, seed: int) -> DataFrame:
    """``(label, words, fold)``: templates, their changed versions, and a bounded sample of corpus lines."""
    templates = _template_rows(spark).withColumn("words", words(F.col("text")))
    changed = templates.withColumn("version", F.explode(F.sequence(F.lit(0), F.lit(versions)))).withColumn(
        # version 0 is the template itself; in the others about a word in eight is missing
        "words", F.filter("words", lambda w, i: (F.col("version") == 0) | (F.pmod(F.xxhash64(w, i, F.col("version"), F.col("text")), F.lit(8)) > 0)))
    positive = changed.select("label", "words", (F.col("version") % 2).alias("fold"))
    known = [r["words"] for r in templates.select("words").collect()]
    sample = paragraphs(docs.limit(negatives)).limit(negatives).select(words(F.col("text")).alias("words"), F.xxhash64("text", F.lit(seed)).alias("h"))
    clean = sample.where(" AND ".join(f"size(array_intersect(words, array({', '.join(map(repr, t))}))) * 2 < {len(set(t))}" for t in known))
    # nor is a line of a wrapped template unknown: most of its 2-grams, or its only word, are a template's
    parts = F.array(*[F.lit(g) for g in sorted({g for t in known for g in [*t, *map(" ".join, zip(t, t[1:]))]})])
    own = F.array_distinct(F.when(F.size("words") > 1, pairs(F.col("words"))).otherwise(F.col("words")))
    clean = clean.where((F.size(own) == 0) | (F.size(F.array_intersect(own, parts)) * 2 < F.size(own)))
    return positive.unionByName(clean.select(F.lit(0).alias("label"), "words", F.pmod("h", F.lit(2)).cast("int").alias("fold")))


class Model:
    """Sparse weights per n-gram, intercepts and the calibrated temperature."""

    def __init__(self, weights: dict[str, list[float]], intercepts: list[float], temperature: float, rare: list[str]):
        self.weights, self.intercepts, self.temperature, self.rare = weights, intercepts, temperature, rare


def train(spark: SparkSession, docs: DataFrame, negatives: int = 2000, versions: int = 24, seed: int = 42) -> Model:
    rows = written(with_grams(training_rows(spark, docs, negatives, versions, seed)), "licence-rows")
    total = max(1, rows.where("label = 0").count())
    count = rows.select("label", F.explode("words").alias("w")).groupBy("w").agg(
        F.sum(F.expr("int(label = 0)")).alias("bad"), F.max(F.expr("int(label > 0)")).alias("good"))
    rare = sorted(r["w"] for r in count.where((F.col("good") == 1) & (F.col("bad") * 100 <= total)).collect() if r["w"] not in STOP_WORDS)
    grams = rows.where("label > 0").select(F.explode("grams").alias("g")).distinct().collect()
    vocabulary = sorted(r["g"] for r in grams if set(r["g"].split(" ")) & set(rare))
    to_vector = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features")
    frame = to_vector.transform(rows).select(F.col("label").cast("double").alias("label"), "features", "fold").coalesce(1)
    fitted = LogisticRegression(family="multinomial", regParam=1e-3, elasticNetParam=0.5, maxIter=60).fit(frame.where("fold = 0"))
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray().tolist()
    intercepts += [float("-inf")] * (len(CLASSES) - len(intercepts))
    weights = {g: [float(x) for x in matrix[:, i]] for i, g in enumerate(vocabulary) if matrix[:, i].any()}
    model = Model(weights, intercepts, 1.0, rare)
    # temperature scaling: the held-out half decides how much the scores are to be trusted
    raw = scores(spark, rows.where("fold = 1").select(F.monotonically_increasing_id().alias("key"), "label", "grams"), ["key", "label"], model)
    grid = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]
    losses = raw.agg(*[F.avg(_log_sum(t) - F.expr("element_at(score, label + 1)") / t).alias(f"t{i}") for i, t in enumerate(grid)]).first()
    best = min((losses[f"t{i}"] if losses[f"t{i}"] is not None else math.inf, t) for i, t in enumerate(grid))
    model.temperature = best[1]
    return model


def _log_sum(t: float) -> Column:
    top = F.array_max("score")
    return F.log(F.aggregate("score", F.lit(0.0), lambda a, s: a + F.exp((s - top) / t))) + top / t


def scores(spark: SparkSession, keyed: DataFrame, keys: list[str], model: Model) -> DataFrame:
    """``(*keys, score)``: the linear scores of every row with ``grams``, one per class."""
    n = len(model.intercepts)
    values = ", ".join(f"('{g}', array({', '.join(f'{x!r}D' for x in w)}))" for g, w in model.weights.items()) or "('', array(0D))"
    table = spark.sql(f"SELECT col1 AS g, col2 AS w FROM VALUES {values}")  # at most the template n-grams
    hits = keyed.select(*keys, F.explode_outer("grams").alias("g")).join(F.broadcast(table), "g", "left")
    sums = hits.groupBy(*keys).agg(*[F.sum(F.get("w", F.lit(i))).alias(f"s{i}") for i in range(n)])
    return sums.select(*keys, F.array(*[F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + F.lit(b) for i, b in enumerate(model.intercepts)]).alias("score"))


def _confirmed(texts: DataFrame, keys: list[str], model: Model, contained: float, least: float, paired: float = 0.0) -> DataFrame:
    """``(*keys, words, family, probability)`` of the texts, given by ``words``, whose predicted family stands."""
    scored = scores(texts.sparkSession, with_grams(texts.select(*keys, "words").distinct()), [*keys, "words"], model)
    total = _log_sum(model.temperature)
    top = F.array_max("score")
    predicted = scored.select(*keys, "words", (F.array_position("score", top) - 1).cast("int").alias("label"),
                              F.exp(top / model.temperature - total).alias("probability")).where((F.col("label") > 0) & (F.col("probability") >= least))

    def holds(have: Column, own: Column, share: float) -> Column:
        return F.size(F.array_intersect(have, F.array_distinct(own))) >= share * F.size(F.array_distinct(own))

    same = F.lit(False)
    for family, templates in TEMPLATES.items():
        for template in templates:
            own = words(F.lit(template))
            stands = (F.col("label") == CLASSES.index(family)) & holds(F.col("words"), own, contained)
            same = same | (stands & holds(pairs(F.col("words")), pairs(own), paired) if paired else stands)
    names = F.array(*[F.lit(c) for c in CLASSES])
    return predicted.where(same).select(*keys, "words", F.get(names, F.col("label")).alias("family"), "probability")


def _rare(model: Model) -> Column:
    return F.arrays_overlap("words", F.array(*[F.lit(w) for w in model.rare]))


def _line_hits(docs: DataFrame, model: Model, contained: float, least: float) -> DataFrame:
    keys = ["doc_id", "version", "at"]
    lines = paragraphs(docs).select(*keys, words(F.col("text")).alias("words"))
    return _confirmed(written(lines.where(_rare(model)), "licence-lines"), keys, model, contained, least)


def found(docs: DataFrame, model: Model, contained: float = 0.8, least: float = 0.5) -> DataFrame:
    """``(doc_id, version, at, family, probability)`` of every line that is a confirmed licence paragraph by itself."""
    return _line_hits(docs, model, contained, least).drop("words")


def _same_line(own: Column) -> Column:
    """A line's words without what only a comment mark can leave."""
    return F.array_join(F.filter(own, lambda w: w.rlike("[a-z0-9]")), " ")


def wrapped(docs: DataFrame, hits: DataFrame, model: Model, contained: float = 0.8, least: float = 0.5, paired: float = 0.6) -> DataFrame:
    """``(doc_id, version, run, family)`` of the licences that stand in a run of lines and in none of them alone; ``hits``: the lines' own."""
    keys = ["doc_id", "version", "run"]
    whole = F.regexp_replace("text", r"(?<=[A-Za-z])-\n", "-")  # a word broken at its hyphen
    kept = written(runs(docs).withColumn("words", words(whole)).where(_rare(model)), "licence-runs")
    def windows(size: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size("words") - 1, F.lit(size // 2)), lambda i: F.slice("words", i + 1, F.lit(size)))

    cut = written(kept.select(*keys, F.explode(F.concat(*map(windows, SIZES))).alias("words")).where(_rare(model)), "licence-windows")
    stands = written(_confirmed(cut, keys, model, contained, least, paired).select(*keys, "family").distinct(), "licence-wrapped")
    # lines that tell the family by themselves are counted already
    lines = stands.alias("s").join(kept.select(*keys, "text").distinct().alias("k"), _equal("s", "k", keys)).select(
        "s.*", F.explode(F.split("k.text", "\n")).alias("line")).select(*keys, "family", _same_line(words(F.col("line"))).alias("line"))
    own = hits.select("doc_id", "version", "family", _same_line(F.col("words")).alias("line")).distinct()
    told = lines.alias("l").join(own.alias("o"), _equal("l", "o", ["doc_id", "version", "family", "line"]), "left_semi")
    return stands.alias("s").join(told.alias("t"), _equal("s", "t", [*keys, "family"]), "left_anti")


def _equal(a: str, b: str, columns: list[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return same


def report(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``(doc_id, n_paragraphs, n_license_paragraphs, families)`` per row; families in alphabetical order, comma-separated.

    Paragraphs are non-blank lines; licence paragraphs are such lines, and runs of lines that hold a wrapped licence.
    """
    model = model or train(docs.sparkSession, docs)
    single = written(_line_hits(docs, model, 0.8, 0.5), "licence-hits")
    both = single.select("doc_id", "version", "family").union(wrapped(docs, single, model).select("doc_id", "version", "family"))
    hits = both.groupBy(F.col("doc_id").alias("__d"), F.col("version").alias("__v")).agg(
        F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("family")), ",").alias("families"))
    body = F.coalesce(docs["text"].cast("string"), F.lit(""))
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(body).alias("__version"),
                       F.size(F.filter(F.split(body, "\n"), lambda line: F.trim(line) != "")).cast("long").alias("n_paragraphs"))
    return base.join(hits, base["doc_id"].eqNullSafe(hits["__d"]) & (base["__version"] == hits["__v"]), "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n", F.lit(0)).cast("long").alias("n_license_paragraphs"), F.coalesce("families", F.lit("")).alias("families"))
