"""Licence scan of paragraphs (operator 10); the scan uses DataFrame and SQL functions only.

A multinomial logistic regression over word one- and two-grams is trained on licence notices that are
made from the rules below, on parts of licence texts, on notices of licences outside the known families
(class ``unknown``), and on sentences of other kinds and all lines of documents without a licence hint
(class ``none``). Its probabilities are
tempered on notices held back, and the bound from which a known family is believed is chosen there too,
against licences that training never saw. Neighbouring lines of one predicted family are one paragraph,
whose word order is compared with the family's templates; what isn't confirmed is ``unknown``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged

PENALTY, ROUNDS = 1e-3, 100
#: Temperatures to choose from.
TEMPERATURES = [0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0]
#: A template is found if so large a share of its neighbouring words is in the paragraph.
CONFIRMED = 0.75
#: Words of a licence text in a training example, and the fewest of a paragraph that may be found inside a template.
PARTS, LEAST_PART = (7, 10, 14), 7
#: A word that so large a share of other lines has doesn't make a line a candidate.
COMMON = 0.01

# Names of licences by family, the frames notices put them in, and openings of full texts.
NAMES = {
    "apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license", "Apache 2.0 license"],
    "mit": ["MIT License", "MIT license terms", "Expat MIT License", "terms of the MIT license"],
    "bsd": ["BSD License", "3-Clause BSD License", "2-Clause BSD License", "BSD-3-Clause license", "New BSD License"],
    "gpl": ["GNU General Public License, version 3", "GNU General Public License, version 2", "GNU General Public License", "GPL v3", "GPL-3.0 license", "GNU GPL version 3 or later"],
    "lgpl": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License", "LGPL v3", "LGPL-2.1 license"],
    "agpl": ["GNU Affero General Public License, version 3", "GNU Affero General Public License", "AGPL v3"],
    "mpl": ["Mozilla Public License, version 2.0", "Mozilla Public License", "MPL 2.0"],
    "cc-by": ["CC BY 4.0", "CC BY 3.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike License"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial License"],
    "cc0": ["CC0 1.0 Universal", "CC0 public domain dedication", "the Unlicense"],
}
FRAMES = ["Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This work is licensed under {}.", "Distributed under the {}.", "This software is made available under the {}.", "See the {} for details.", "License: {}", "SPDX: {}", "Lizenziert unter der {}.", "Unter der {} veröffentlicht.", "Sous licence {}.", "Publicado bajo la licencia {}."]
IDENTIFIERS = {"apache-2.0": ["Apache-2.0", "Apache-Lizenz 2.0"], "mit": ["MIT"], "bsd": ["BSD-3-Clause", "BSD-2-Clause"], "gpl": ["GPL-3.0-only", "GPL-2.0-or-later"], "lgpl": ["LGPL-2.1-only"], "agpl": ["AGPL-3.0-only"], "mpl": ["MPL-2.0"], "cc-by": ["CC-BY-4.0"], "cc-by-sa": ["CC-BY-SA-4.0"], "cc-by-nc": ["CC-BY-NC-4.0"], "cc0": ["CC0-1.0"]}
IDENTIFIER_FRAMES = ["SPDX-License-Identifier: {}", "SPDX: {}", "License: {}", "{} license", "Unter der {}."]
OPENINGS = {
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "apache-2.0": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"],
}
UNKNOWN_NAMES = ["Acme Public License", "Commercial License", "Eclipse Public License", "custom license agreement", "Artistic License", "proprietary license", "Sample Source License 1.1", "Zlib License", "end user license agreement", "Open Data License"]
UNKNOWN = ["All rights reserved.", "Copyright. All rights reserved. No part may be reproduced without permission of the publisher.", "No license is granted.", "Use is subject to license terms."]
#: Licence words in other senses.
OTHER = ["The {} team holds a driver license.", "I have a license to drive and a copy of version 2.", "A fishing license is required by law.", "He was granted permission to leave.", "The public library is free of charge.", "Copyright law was debated.", "The general public was invited to the creative commons room.", "The {} office issues a license plate.", "Poetic license lets the author redistribute the parts.", "A software company in {} sold its license.", "Sie hat einen Führerschein und eine Lizenz zum Fliegen.", "Il a perdu sa licence de pêche.", "Tiene licencia de conducir.", "{} is great and free."]
OTHER_NAMES = ["MIT", "Apache", "Mozilla", "GNU", "BSD", "Berkeley", "Kafka", "city"]
#: Documents with a match of this are no source of lines of class ``none``; the scan itself has no such filter.
HINT = r"(?i)licen[sc]|lizenz|copyright|all rights reserved|\bcc[ -]?(?:by|0)|creative commons|hereby granted|redistribut|public domain|\b[al]?gpl\b|warranty|spdx"

_PLAIN = r"[^\p{L}\p{N}]+"


def parts(text: str) -> list[str]:
    """Overlapping parts of a licence text, as lines would hold them."""
    words = text.split()
    return [text] + [" ".join(words[i : i + n]) for n in PARTS for i in range(0, max(1, len(words) - LEAST_PART + 1), n // 2)]


def notices() -> list[tuple[str, str, bool]]:
    """(family, text, held back) of all examples that the rules make. Of unknown licences, whole names are held
    back; of the others every fifth notice."""
    out = [(k, f.format(n)) for k, names in NAMES.items() for n in names for f in FRAMES]
    out += [(k, f.format(n)) for k, names in IDENTIFIERS.items() for n in names for f in IDENTIFIER_FRAMES]
    out += [(k, p) for k, texts in OPENINGS.items() for t in texts for p in parts(t)]
    out += [("none", f.format(n)) for f in OTHER for n in (OTHER_NAMES if "{}" in f else [""])]
    known = [(k, t, i % 5 == 4) for i, (k, t) in enumerate(out)]
    known += [("unknown", t, False) for t in UNKNOWN] * len(FRAMES)  # as often as a name
    return known + [("unknown", f.format(n), i % 4 == 3) for i, n in enumerate(UNKNOWN_NAMES) for f in FRAMES]


def templates() -> list[tuple[str, str]]:
    """(family, template): names, identifiers with what stands before them, and openings."""
    out = [(k, t) for k, names in NAMES.items() for t in names] + [(k, t) for k, texts in OPENINGS.items() for t in texts]
    return out + [(k, f.format(n)) for k, names in IDENTIFIERS.items() for n in names for f in IDENTIFIER_FRAMES[:3]]


def words_of(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(text), _PLAIN), lambda w: w != "")


def pairs_of(words: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    n = F.size(words)
    two = F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.concat_ws(" ", words[i], words[i + 1]))
    return F.array_distinct(F.when(n > 1, two).otherwise(F.array().cast("array<string>")))


def grams_of(words: Column) -> Column:
    """Distinct one- and two-grams."""
    return F.array_distinct(F.concat(words, pairs_of(words)))


@dataclass
class Model:
    classes: list[str]
    features: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    bound: float
    #: Words one of which a line must have to be a candidate: those that speak for a licence and are rare elsewhere.
    triggers: list[str]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1)[:, None])
    return e / e.sum(1)[:, None]


def train(spark: SparkSession, docs: DataFrame) -> Model:
    """Fit on the made notices and on every line of all documents without a licence hint.

    On what is held back (every fifth notice, whole names of unknown licences, the lines of a fifth of the documents)
    the temperature is chosen, and on the notices the bound that best parts known families from unknown licences.
    In both steps each class weighs the same, and made sentences of class none as much as all lines of documents.
    Features are bounded by the notices. Lines stay in Spark: the driver gets counts and sums by feature and class.
    """
    made = notices()
    rows = spark.createDataFrame([(i, k, t, h) for i, (k, t, h) in enumerate(made)], "i int, family string, text string, held boolean")
    grams = grams_of(F.col("words")).alias("grams")
    rows = rows.select("i", "family", "held", words_of(F.col("text")).alias("words")).select("i", "family", "held", grams)
    got = rows.orderBy("i").collect()
    features = sorted({g for r in got for g in r["grams"]})
    place = {g: i for i, g in enumerate(features)}
    classes = ["none", "unknown", *NAMES]
    truth = np.array([classes.index(r["family"]) for r in got])
    held = np.array([r["held"] for r in got])
    x = np.zeros((len(got), len(features)))
    for i, r in enumerate(got):
        x[i, [place[g] for g in r["grams"]]] = 1

    vectors = CountVectorizerModel.from_vocabulary(features, "grams", "features").setBinary(True)
    back = F.coalesce(F.pmod(F.crc32(F.concat(F.lit("none"), F.col("doc_id").cast("string")).cast("binary")), F.lit(5)) == 4, F.lit(False))
    other = docs.where(F.col("text").isNotNull() & ~F.col("text").rlike(HINT)).select(back.alias("held"), F.explode(F.split("text", "\n")).alias("line"))
    other = other.select("held", words_of(F.col("line")).alias("words")).select("held", grams)
    other = staged(vectors.transform(other).select("held", "features"))
    n_lines, seen = 0, np.zeros(len(features))
    counts = {False: 0, True: 0}
    for r in other.groupBy("held").agg(F.count("*").alias("n"), Summarizer.numNonZeros(F.col("features")).alias("seen")).collect():
        counts[r["held"]] = r["n"]
        n_lines, seen = n_lines + r["n"], seen + r["seen"].toArray()

    # made sentences of class none are a kind of their own
    kind = np.where(truth == 0, len(classes), truth)
    size = np.bincount(kind[~held], minlength=len(classes) + 1)
    weights = spark.createDataFrame([(i, float(truth[i]), 1 / float(size[kind[i]])) for i in np.flatnonzero(~held).tolist()], "i int, label double, weight double")
    fitted = vectors.transform(rows.join(F.broadcast(weights), "i")).select("features", "label", "weight")
    fitted = fitted.union(other.where("not held").select("features", F.lit(0.0), F.lit(1 / max(1, counts[False]))))
    regression = LogisticRegression(family="multinomial", regParam=PENALTY, standardization=False, maxIter=ROUNDS, tol=1e-6, weightCol="weight")
    learned = regression.fit(fitted)
    w, b = learned.coefficientMatrix.toArray().T, learned.interceptVector.toArray()

    z, own, kind = x[held] @ w + b, truth[held], kind[held]
    loss = []  # of each temperature, by kind
    for t in TEMPERATURES:
        each = -np.log(np.maximum(_softmax(z / t)[np.arange(len(own)), own], 1e-12))
        loss.append([each[kind == k].mean() for k in np.unique(kind)])
    if counts[True]:
        raw = learned.transform(other.where("held")).select(vector_to_array("rawPrediction").alias("z")).select("z", F.array_max("z").alias("top"))
        scaled = lambda t: F.aggregate("z", F.lit(0.0), lambda a, v: a + F.exp((v - F.col("top")) / t))
        means = raw.agg(*[F.avg(F.least(F.log(scaled(t)) + (F.col("top") - F.col("z")[0]) / t, F.lit(float(-np.log(1e-12))))) for t in TEMPERATURES]).first()
        loss = [v + [m] for v, m in zip(loss, means)]
    temperature = TEMPERATURES[int(np.argmin([np.mean(v) for v in loss]))]
    p = _softmax(z / temperature)
    guess, sure = p.argmax(1), p.max(1)
    known, strange = own > 1, own == 1

    def worth(bound: float) -> float:
        """Known families found, and unknown licences not taken for one, each as a share."""
        believed = (guess > 1) & (sure >= bound)
        return (believed & (guess == own))[known].mean() + 1 - believed[strange].mean()

    bounds = np.linspace(0.3, 0.95, 66)
    worths = np.array([worth(v) for v in bounds])
    bound = np.median(bounds[worths >= worths.max() - 1e-9])
    rare = seen <= COMMON * n_lines
    speaks = (w[:, 1:].max(1) > w[:, 0]) & rare
    triggers = [g for i, g in enumerate(features) if speaks[i] and " " not in g and any(c.isalpha() for c in g)]
    return Model(classes, features, w, b, temperature, float(bound), triggers)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, paragraph, n_lines, family, probability, similarity, confirmed: a row for each paragraph that
    isn't of class ``none``.

    Every line of every text is looked at; one without any of the model's trigger words is of class ``none``.
    A paragraph is a run of lines of one predicted family, named by its first line, from 0. Null and empty
    texts have none; repeated rows are scanned each; other columns are ignored; an empty table gives no rows;
    a line may be as long as a text. Ties go to the first class. The weights have a row for each feature of
    the notices and the templates some dozens, whatever the input, so both are broadcast.
    """
    spark = docs.sparkSession
    n = len(model.classes)
    table = [(f, *map(float, model.weights[i])) for i, f in enumerate(model.features)]
    columns = [f"w{k}" for k in range(n)]
    weights = F.broadcast(spark.createDataFrame(table, "gram string, " + ", ".join(f"{c} double" for c in columns)))
    lines = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    lines = lines.select("doc_id", "row", "paragraph", words_of(F.col("line")).alias("words"))
    lines = staged(lines.where(F.arrays_overlap("words", F.array(*map(F.lit, model.triggers or [""])))))
    grams = lines.select("row", "paragraph", F.explode(grams_of(F.col("words"))).alias("gram"))
    sums = grams.join(weights, "gram").groupBy("row", "paragraph").agg(*[F.sum(c).alias(c) for c in columns])
    z = F.array(*[(F.col(c) + float(model.bias[k])) / model.temperature for k, c in enumerate(columns)])
    scored = sums.withColumn("z", z).withColumn("top", F.array_max("z"))
    scored = scored.withColumn("probability", 1 / F.aggregate("z", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("top"))))
    scored = scored.withColumn("family", F.element_at(F.array(*map(F.lit, model.classes)), F.array_position("z", F.col("top")).cast("int")))
    scored = scored.where("family <> 'none'").select("row", "paragraph", "family", "probability")
    island = F.col("paragraph") - F.row_number().over(W.partitionBy("row", "family").orderBy("paragraph"))
    both = scored.join(lines, ["row", "paragraph"]).withColumn("island", island)
    words = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("paragraph", "words"))), lambda s: s["words"]))
    found = both.groupBy("row", "family", "island").agg(
        F.first("doc_id").alias("doc_id"), F.min("paragraph").alias("paragraph"), F.count("*").cast("int").alias("n_lines"), F.max("probability").alias("probability"), words.alias("words")
    )
    made = spark.createDataFrame(templates(), "family string, text string").select("family", pairs_of(words_of(F.col("text"))).alias("template"))
    made = F.broadcast(made.groupBy("family").agg(F.collect_list("template").alias("templates")))
    found = found.withColumn("pairs", pairs_of(F.col("words")))
    shared = lambda t: F.size(F.array_intersect(t, F.col("pairs")))
    inside = lambda t: F.when(F.size("pairs") >= LEAST_PART - 1, shared(t) / F.size("pairs")).otherwise(F.lit(0.0))
    alike = F.array_max(F.transform("templates", lambda t: F.greatest(shared(t) / F.greatest(F.size(t), F.lit(1)), inside(t))))
    out = found.join(made, "family", "left").withColumn("similarity", F.coalesce(alike, F.lit(0.0)))
    sure = (F.col("similarity") >= CONFIRMED) & (F.col("probability") >= model.bound) & (F.col("family") != "unknown")
    return out.select("doc_id", "paragraph", "n_lines", F.when(sure, F.col("family")).otherwise("unknown").alias("family"), "probability", "similarity", sure.alias("confirmed"))
