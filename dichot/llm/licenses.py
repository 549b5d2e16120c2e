"""Licence scans: a trained paragraph classifier with template confirmation.

A paragraph is a line of a text; its features are its distinct word unigrams
and bigrams (lower case, cut at everything but letters and digits).  A sparse
multinomial logistic regression tells the licence families and ``none`` apart.
It is trained on the template notices, each also with one word left out, and
on a bounded sample of paragraphs that share no three words in a row with any
template.  N-grams that ordinary paragraphs use are no features, so a
paragraph without any feature word is ``none`` and is not scored.

A paragraph whose best class is a family is given that family only if the
family's probability reaches a threshold calibrated on held-out notices (the
``miss`` quantile of their probability), and if the paragraph holds enough of
one of the family's templates; otherwise it is ``unknown``.

Scoring is DataFrame functions only: the weights are a table of at most the
number of template n-grams, broadcast and summed per paragraph.

Defined results: null or empty texts have no paragraphs; a null ``doc_id`` is
kept as null; rows that repeat a ``doc_id`` are scanned one by one (``row``
tells them apart by content hash, equal rows give one result); an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dichot.llm.spark import ready, written

NEGATIVES = 4000
COMMON = 0.02
MISS = 0.02
CONFIRM = 0.6

# fixed values: notices by which files and pages state their licence
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "SPDX-License-Identifier: MIT"],
    "BSD": ["Released under the BSD License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "SPDX-License-Identifier: BSD-3-Clause"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "This work is licensed under the GNU General Public License, version 2.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "You should have received a copy of the GNU General Public License along with this program.",
            "SPDX-License-Identifier: GPL-3.0-or-later"],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "Text is available under the Creative Commons Attribution-ShareAlike License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
            "Dedicated to the public domain under CC0 1.0."],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited.",
                    "Proprietary and confidential."],
}
NONE, UNKNOWN = "none", "unknown"


def _words(text: F.Column) -> F.Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _run(w: F.Column, n: int) -> F.Column:
    """Runs of ``n`` words of the array ``w``."""
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.concat_ws(
        " ", *(F.get(w, i + k) for k in range(n))))).otherwise(F.array().cast("array<string>"))


def _bound(value: F.Column, use) -> F.Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def features(text: F.Column) -> F.Column:
    """Distinct unigrams and bigrams."""
    return _bound(_words(text), lambda w: F.array_distinct(F.concat(w, _run(w, 2))))


def paragraphs(docs: DataFrame) -> DataFrame:
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"),
                        F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    return lines.where(F.trim("line") != "")


class LicenceModel:
    """Families, per n-gram weights (a small table), intercepts, threshold."""

    def __init__(self, classes: list[str], weights: DataFrame, intercepts: list[float], cues: list[str], least: float) -> None:
        self.classes, self.weights, self.intercepts, self.cues, self.least = classes, weights, intercepts, cues, least


def train(docs: DataFrame, negatives: int = NEGATIVES, miss: float = MISS) -> LicenceModel:
    """Fit the classifier; ``negatives`` bounds the sample of ordinary paragraphs."""
    spark = ready(docs)
    classes = [NONE, *TEMPLATES]
    notices = []
    for label, family in enumerate(classes):
        for t, text in enumerate(TEMPLATES.get(family, [])):
            words = text.split()
            cut = [words] + [words[:i] + words[i + 1:] for i in range(len(words)) if len(words) > 4]
            notices += [(float(label), t, i, " ".join(w)) for i, w in enumerate(cut)]
    notices = spark.createDataFrame(notices, "label double, t int, i int, line string")
    threes = F.array_distinct(F.flatten(F.collect_list(_bound(_words(F.col("line")), lambda w: _run(w, 3)))))
    known = notices.agg(threes.alias("k")).first()["k"]
    lines = paragraphs(docs)
    # the least hash values of (document, paragraph): a fixed sample, whatever the partitioning
    sample = lines.orderBy(F.xxhash64("row", "paragraph"), "doc_id", "paragraph").limit(2 * negatives)
    sample = written(sample.select("line"), "licence-sample").where(
        ~F.arrays_overlap(_bound(_words(F.col("line")), lambda w: _run(w, 3)), F.array(*map(F.lit, known)))).limit(negatives)
    plain = sample.select(F.lit(0.0).alias("label"), F.lit(-1).alias("t"), F.lit(0).alias("i"), "line")
    # at most the notices and ``negatives`` rows: one partition, so that an iteration is one short task
    rows = written(notices.unionByName(plain).select("label", "t", "i", features(F.col("line")).alias("grams")).coalesce(1), "licence-rows")
    ordinary = max(1, rows.where("label = 0").count())
    common = [r["g"] for r in rows.where("label = 0").select(F.explode("grams").alias("g")).groupBy("g").count()
              .where(F.col("count") > COMMON * ordinary).collect()]
    cues = [r["g"] for r in rows.where("label > 0").select(F.explode("grams").alias("g")).distinct().collect()
            if " " not in r["g"] and r["g"] not in set(common)]
    cue = set(cues)
    vocabulary = sorted({r["g"] for r in rows.where("label > 0").select(F.explode("grams").alias("g")).distinct().collect()
                         if cue.intersection(r["g"].split(" "))})
    held = F.pmod(F.xxhash64("t", "i"), F.lit(4)) == 0
    vector = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="x", binary=True)
    data = vector.transform(rows)
    fit = LogisticRegression(featuresCol="x", labelCol="label", family="multinomial", regParam=0.002, elasticNetParam=0.0, maxIter=60)
    trial = fit.fit(data.where((F.col("label") == 0) | ~held | (F.col("i") == 0)))
    told = trial.transform(data.where((F.col("label") > 0) & held & (F.col("i") > 0)))
    least = told.agg(F.percentile(F.get(vector_to_array("probability"), F.col("label").cast("int")), miss)).first()[0]
    model = fit.fit(data)
    matrix = model.coefficientMatrix.toArray()
    weights = spark.createDataFrame([(g, [float(x) for x in matrix[:, i]]) for i, g in enumerate(vocabulary)], "gram string, w array<double>")
    return LicenceModel(classes, weights, [float(x) for x in model.interceptVector], cues, min(0.9, max(0.5, float(least or 0.5))))


def scan(docs: DataFrame, model: LicenceModel, confirm: float = CONFIRM) -> DataFrame:
    """``doc_id, row, paragraph, family, probability, similarity, confirmed`` for
    every paragraph that states a licence; ``family`` is ``unknown`` where it is
    not told apart or not confirmed by a template."""
    spark = ready(docs)
    cue = r"(?<![\p{L}\p{N}])(?:" + "|".join(sorted(model.cues)) + r")(?![\p{L}\p{N}])"
    told = docs.where(F.lower("text").rlike(cue))
    lines = paragraphs(told).where(F.lower("line").rlike(cue)).select("doc_id", "row", "paragraph", "line")
    grams = lines.select("doc_id", "row", "paragraph", features(F.col("line")).alias("grams"),
                         _bound(_words(F.col("line")), lambda w: F.array_distinct(_run(w, 2))).alias("pairs"))
    key = ["doc_id", "row", "paragraph"]
    hits = grams.select(*key, F.explode_outer("grams").alias("gram")).join(F.broadcast(model.weights), "gram")
    sums = hits.groupBy(*key).agg(*(F.sum(F.get("w", F.lit(i))).alias(f"s{i}") for i in range(len(model.classes))))
    odds = [F.exp(F.col(f"s{i}") + F.lit(b)) for i, b in enumerate(model.intercepts)]
    whole = sum(odds[1:], odds[0])
    best = F.greatest(*(F.struct((o / whole).alias("p"), F.lit(c).alias("family")) for c, o in zip(model.classes, odds)))
    judged = sums.select(*key, best.alias("best")).where(F.col("best.family") != NONE)
    templates = spark.createDataFrame([(f, t) for f, x in TEMPLATES.items() for t in x], "of string, line string").select(
        "of", _bound(_words(F.col("line")), lambda w: F.array_distinct(_run(w, 2))).alias("t"))
    templates = templates.groupBy("of").agg(F.collect_list("t").alias("templates"))
    same = [F.col(f"g.{c}").eqNullSafe(F.col(f"j.{c}")) for c in key]
    joined = (judged.alias("j").join(grams.alias("g"), same[0] & same[1] & same[2])
              .join(F.broadcast(templates), F.col("j.best.family") == F.col("of")))
    similarity = F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect("g.pairs", t)) / F.size(t)))
    out = joined.select(*(F.col(f"j.{c}").alias(c) for c in key), F.col("j.best").alias("best"), similarity.alias("similarity"))
    good = F.col("similarity") >= confirm
    return (out.select(*key, F.when(good & (F.col("best.p") >= model.least), F.col("best.family")).otherwise(UNKNOWN).alias("family"),
                       F.col("best.p").alias("probability"), "similarity", good.alias("confirmed")).dropDuplicates(key))
