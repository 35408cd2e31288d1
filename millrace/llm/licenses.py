"""Licence notices by a trained paragraph classifier, with DataFrame functions only.

A paragraph is a line with a word, or a run of several such lines between blank ones; a notice may be either.
All paragraphs of all texts are classified by a multinomial logistic regression over word n-grams. It is trained
on variants of the templates (words left out, words of other texts before and after) against paragraphs
of the corpus and misleading sentences. The chance from which a family is believed is set on further variants. A
prediction counts as confirmed if the paragraph holds enough word pairs of a template of that family.

Most paragraphs need no scoring, by an exact bound from the model (`telling_words`): the n-grams it knows and
gives any weight for a family are each put down to one of their words, and what the words outside a list could
give together, were they all in one paragraph, stays below the believed chance. A paragraph without any word
of that list is unknown for certain. It has no row in the result; all others have, unknown or not.

Defined cases: null and empty texts have no paragraphs; a null id is carried; repeated rows give
repeated rows; equal chances go to the family first in the alphabet; an empty table gives an empty
result. Only id and text are read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.tables import hashed_sample, written

_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
_GPL_HOPE = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
)

#: Notices of public licences, paragraph by paragraph, and the short forms in use.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "agpl-3.0": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the AGPL-3.0.",
        "This file is AGPLv3",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Code is available under Apache 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Except where otherwise noted, content on this site is licensed under a Creative Commons Attribution 4.0 International license.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ),
    "cc0": (
        "Released under CC0 1.0 Universal.",
        "This work is dedicated to the public domain under CC0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "gpl-2.0": (
        "This program is free software; you can redistribute it under the terms of the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "Licensed under the GPL, version 2.",
        "This file is GPLv2",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        _GPL_HOPE,
        "You should have received a copy of the GNU General Public License along with this program, version 3.",
        "This file is GPLv3",
        "Licensed under the GPL-3.0.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the LGPL.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        _AS_IS,
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
        "Distributed under MPL 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved.",
        "Copyright (c) 2020 Example Corporation",
        "(c) 2020 Example Ltd.",
        "No part of this publication may be reproduced without permission.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "Alle Rechte vorbehalten",
        "Tous droits réservés",
        "Todos los derechos reservados",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "This text is in the public domain.",
    ),
}
UNKNOWN = "unknown"
#: Sentences that hold words of notices and are none.
MISLEADING = (
    "He lost his driver's license on the way home.",
    "The dealer asked for a fishing license and a passport.",
    "She took poetic license with the story of the village.",
    "The license plate of the car was covered with mud.",
    "You need permission from your parents to go on the trip.",
    "Nobody asked for permission to open the gate.",
    "The warranty of the washing machine ended last year.",
    "Copyright law was the subject of the lecture.",
    "The office of copyright was moved to another street.",
    "The committee discussed the rights of workers in the factory.",
    "Public libraries are open to the general public on Sundays.",
    "The new version of the song was released in March.",
    "The ministry may redistribute land among the farmers.",
    "A software engineer wrote the program under pressure.",
    "The source of the river lies in the public park.",
    "Food was distributed to all persons in the hall.",
    "Die Rechte der Kinder wurden besprochen.",
    "The table was reserved for the guests.",
    "In 2020 the company moved to the coast.",
)


@dataclass(frozen=True)
class Scan:
    """Variants of a template, about how many paragraphs of the corpus are negatives (at
    most twice as many), the share of a template's word pairs that such a paragraph may hold, the share
    that confirms a prediction, words of a wrapped notice's line, and the share of the sampled paragraphs from
    which a word is common: n-grams of common words alone are no features."""

    variants: int = 24
    negatives: int = 600
    strange_pairs: float = 0.3
    least_pairs: float = 0.6
    wrapped: int = 10
    common: float = 0.01


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\d]+)"), F.lit(1))


def _runs(words: Column, size: int) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - (size - 1))),
        lambda i: F.array_join(F.slice(words, i, size), " "),
    )


def _grams(words: Column) -> Column:
    grams = F.concat(_runs(words, 1), F.when(F.size(words) > 1, _runs(words, 2)).otherwise(F.array().cast("array<string>")))
    return F.concat(grams, F.when(F.size(words) > 2, _runs(words, 3)).otherwise(F.array().cast("array<string>")))


def _pairs(words: Column) -> Column:
    return F.array_distinct(_runs(words, 2))


def _lines(text: Column) -> Column:
    """The lines with a word, as (at, n, text): their number from 0, one line each."""
    lines = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(i.alias("at"), F.lit(1).alias("n"), line.alias("text")))
    return F.filter(lines, lambda line: line["text"].rlike(r"[\p{L}\d]"))


def _runs_of_lines(text: Column) -> Column:
    """Runs of two lines and more between blank ones, as (at, n, text)."""
    # Lines carry their numbers while the text is cut at blank ones.
    numbered = F.transform(F.split(text, "\n", -1), lambda line, i: F.concat(F.lit("\n"), i.cast("string"), F.lit("\t"), line))
    pieces = F.split(F.array_join(numbered, ""), r"\n\d+\t[^\S\n]*(?=\n|\z)", -1)

    def run(piece: Column) -> Column:
        at = F.regexp_extract(piece, r"^\n(\d+)\t", 1).try_cast("int")
        plain = F.regexp_replace(piece, r"\n\d+\t", "\n")
        n = F.length(plain) - F.length(F.replace(plain, F.lit("\n"), F.lit("")))
        return F.struct(at.alias("at"), n.cast("int").alias("n"), plain.alias("text"))

    return F.filter(F.transform(pieces, run), lambda r: (r["n"] > 1) & r["text"].rlike(r"[\p{L}\d]"))


def paragraphs(docs: DataFrame, telling: list[str] | None = None) -> DataFrame:
    """`doc_id`, `paragraph` (its first line's number, from 0), `lines` and `words` of every paragraph; with
    `telling` only of those that hold one of these words, found text by text first."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).where("text IS NOT NULL")
    held = (lambda words: F.arrays_overlap(words, F.split(F.lit(" ".join(telling)), " "))) if telling is not None else lambda words: F.lit(True)
    if telling is not None:
        rows = rows.where(held(_words(F.col("text"))))
    each = rows.select("doc_id", F.explode(F.concat(_lines(F.col("text")), _runs_of_lines(F.col("text")))).alias("p"))
    found = each.select("doc_id", F.col("p.at").alias("paragraph"), F.col("p.n").alias("lines"), _words(F.col("p.text")).alias("words"))
    return found.where((F.size("words") > 0) & held(F.col("words")))


def negatives(docs: DataFrame, scan: Scan) -> DataFrame:
    """`salt` (fit or calibrate) and `words` of paragraphs of the whole corpus, chosen by hash, that are no notice."""
    lines = docs.select(F.col("doc_id"), F.posexplode(_lines(F.col("text").cast("string"))).alias("i", "line"))
    count = docs.agg(F.sum(F.size(_lines(F.col("text").cast("string"))))).first()[0] or 0
    key = F.struct(F.col("doc_id"), F.col("i"), F.col("line.text"))
    few = hashed_sample(lines, key, 2 * scan.negatives, count, "negatives")
    salt = F.when(F.pmod(F.xxhash64(F.lit("side"), key), F.lit(2)) == 0, "fit").otherwise("calibrate")
    worded = few.select(salt.alias("salt"), _words(F.col("line.text")).alias("words")).where(F.size("words") > 2)
    own = _pairs(F.col("words"))
    near = [F.size(F.array_intersect(_pairs(_words(F.lit(t))), own)) >= scan.strange_pairs * F.size(_pairs(_words(F.lit(t)))) for texts in TEMPLATES.values() for t in texts]
    return worded.where(~F.exists(F.array(*near), lambda x: x))


def training_rows(spark: SparkSession, strange: DataFrame, scan: Scan, salt: str) -> DataFrame:
    """`family`, `words`: variants of the templates, corpus paragraphs (`strange`) and misleading sentences."""
    notices = [(family, t) for family, texts in TEMPLATES.items() for t in texts] + [(UNKNOWN, t) for t in MISLEADING]
    base = spark.createDataFrame(notices, "family string, text string").withColumn("words", _words(F.col("text")))
    lines = strange.where(F.col("salt") == salt)
    fillers = written(spark, lines.orderBy(F.xxhash64("words"), "words").limit(64).select(F.slice("words", 1, 12).alias("filler")), "fillers")
    many = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(scan.variants - 1))).alias("variant"))
    # Variant 0 is the notice itself; others miss about one word in ten, half of them stand among words.
    left = F.filter(F.col("words"), lambda w, i: F.pmod(F.xxhash64(F.lit(salt), F.col("variant"), w, i), F.lit(10)) != 0)
    many = many.withColumn("left", F.when(F.col("variant") == 0, F.col("words")).otherwise(left)).where(F.size("left") > 1)
    numbered = fillers.select("filler", F.pmod(F.xxhash64("filler"), F.lit(scan.variants)).alias("_slot"))
    numbered = numbered.groupBy("_slot").agg(F.min("filler").alias("filler"))  # one per variant at most
    many = many.join(F.broadcast(numbered), F.col("variant") == F.col("_slot"), "left")
    filler = F.coalesce("filler", F.array().cast("array<string>"))
    words = F.when(F.col("variant") % 4 == 1, F.concat(filler, "left")).when(F.col("variant") % 4 == 3, F.concat("left", filler)).otherwise(F.col("left"))
    # Long notices are often wrapped: from half of the variants on, one of their lines stands for them.
    at = F.pmod(F.xxhash64(F.lit(salt), F.col("variant"), F.col("text")), F.greatest(F.size("words") - scan.wrapped, F.lit(0)) + 1) + 1
    wrapped = (F.size("words") > 2 * scan.wrapped) & (F.col("variant") >= scan.variants // 2)
    words = F.when(wrapped, F.slice("words", at.cast("int"), scan.wrapped)).otherwise(words)
    return many.select("family", words.alias("words")).unionByName(lines.select(F.lit(UNKNOWN).alias("family"), "words"))


def vocabulary(common: set[str]) -> list[str]:
    """The n-grams of the templates and misleading sentences with a word that is not common: the model's features."""
    out: set[str] = set()
    for text in (*(t for texts in TEMPLATES.values() for t in texts), *MISLEADING):
        words = re.findall(r"[^\W_]+", text.lower())
        for size in (1, 2, 3):
            runs = (words[i : i + size] for i in range(len(words) - size + 1))
            out.update(" ".join(run) for run in runs if not common.issuperset(run))
    return sorted(out)


class Classifier:
    """A fitted model with the chance from which it is believed."""

    def __init__(self, spark: SparkSession, docs: DataFrame, scan: Scan = Scan()):
        self.spark, self.scan = spark, scan
        self.families = [UNKNOWN, *sorted(TEMPLATES)]
        strange = written(spark, negatives(docs, scan), "negatives")
        # Words of the sample, which is bounded.
        counts = {r["word"]: r["count"] for r in strange.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").count().collect()}
        least = max(2.0, scan.common * max(strange.count(), 1))
        self.common = sorted(word for word, n in counts.items() if n >= least)
        self.counter = CountVectorizerModel.from_vocabulary(vocabulary(set(self.common)), inputCol="grams", outputCol="features")
        self.counter.setBinary(True)
        rows = written(spark, self.labelled(training_rows(spark, strange, scan, "fit")), "training")
        regression = LogisticRegression(family="multinomial", maxIter=50, regParam=1e-4, standardization=False)
        self.model: LogisticRegressionModel = regression.fit(self.counter.transform(rows).select("features", "label"))
        self.least = self.calibrated(training_rows(spark, strange, scan, "calibrate"))
        self.telling = self.telling_words(counts)

    def labelled(self, rows: DataFrame) -> DataFrame:
        place = F.array_position(F.array(*map(F.lit, self.families)), F.col("family")) - 1
        return rows.select(place.cast("double").alias("label"), _grams(F.col("words")).alias("grams"))

    def telling_words(self, common: dict[str, int]) -> list[str] | None:
        """Words of which a paragraph holds one if any family's chance may reach `least`; None if a paragraph
        without words could (a model of hardly any negatives), so that all are scored.

        A family is believed only if its margin over unknown is at least log(least / (1 - least)). Whatever
        n-grams a paragraph has, its margin is at most the intercept's and the positive weights of what it
        holds. `common` says in how many sampled paragraphs a word stands, so that frequent words are left out
        of the list first; it decides about time only.
        """
        weights, intercepts = self.model.coefficientMatrix.toArray(), np.array(self.model.interceptVector.toArray())
        gain = np.maximum(weights[1:] - weights[0], 0).max(axis=0)
        room = math.log(self.least / (1 - self.least)) - (intercepts[1:] - intercepts[0]).max() - 1e-6
        worth: dict[str, float] = {}
        for gram, more in zip(self.counter.vocabulary, gain, strict=True):
            if more > 0:
                word = min(gram.split(" "), key=lambda w: (common.get(w, 0), -len(w), w))
                worth[word] = worth.get(word, 0.0) + float(more)
        if room <= 0:
            return None
        telling = []
        for word in sorted(worth, key=lambda w: (worth[w] / (1 + common.get(w, 0)) ** 2, w)):
            room -= worth[word]
            if room <= 0:
                telling.append(word)
                room += worth[word]
        return sorted(telling)

    def chances(self, rows: DataFrame) -> DataFrame:
        """`best` family but unknown and its `chance`, for rows with `grams`."""
        scored = self.model.transform(self.counter.transform(rows))
        every = vector_to_array("probability")
        known = F.slice(every, 2, len(self.families) - 1)
        chance = F.array_max(known)
        best = F.element_at(F.array(*map(F.lit, self.families[1:])), F.array_position(known, chance).cast("int"))
        columns = [c for c in rows.columns if c != "grams"]
        return scored.select(*columns, best.alias("best"), chance.alias("chance"))

    def calibrated(self, rows: DataFrame) -> float:
        """Between what other paragraphs reach and what variants of notices reach."""
        found = self.chances(self.labelled(rows))
        right = F.when((F.col("label") > 0), F.col("chance"))
        wrong = F.when(F.col("label") == 0, F.col("chance"))
        low, high = found.agg(F.percentile_approx(right, 0.02, 10_000), F.percentile_approx(wrong, 0.995, 10_000)).first()
        return min(0.9, max(0.3, ((low or 0.0) + (high or 1.0)) / 2))

    def classify(self, lines: DataFrame) -> DataFrame:
        """`doc_id`, `paragraph`, `lines`, `family`, `probability`, `template_similarity`, `confirmed`."""
        held = lines.withColumn("grams", _grams(F.col("words")))
        found = self.chances(held)
        pairs = [(f, t) for f, texts in TEMPLATES.items() for t in texts]
        templates = self.spark.createDataFrame(pairs, "best string, template string")
        templates = templates.select("best", _pairs(_words(F.col("template"))).alias("pairs"))
        templates = templates.groupBy("best").agg(F.collect_list("pairs").alias("templates"))
        found = found.join(F.broadcast(templates), "best")  # one row per family
        own = _pairs(F.col("words"))
        shares = F.transform("templates", lambda t: F.size(F.array_intersect(t, own)) / F.size(t))
        found = found.withColumn("template_similarity", F.array_max(shares))
        confirmed = (F.col("chance") >= self.least) & (F.col("template_similarity") >= self.scan.least_pairs)
        family = F.when(F.col("chance") >= self.least, F.col("best")).otherwise(F.lit(UNKNOWN))
        return found.select(
            "doc_id", "paragraph", "lines", family.alias("family"), F.col("chance").alias("probability"), "template_similarity", confirmed.alias("confirmed")
        )


def scan_licenses(spark: SparkSession, docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """All paragraphs that may be notices, and what the classifier makes of them; all others are unknown."""
    classifier = Classifier(spark, docs, scan)
    return classifier.classify(paragraphs(docs, classifier.telling))
