"""Licence scan: a trained paragraph classifier over word n-grams.

Native: DataFrame and SQL functions and pyspark.ml. A paragraph is a line; short
lines (WRAPPED code points at most) are read together with the next one and two
as well, as notices are often wrapped. A multinomial logistic regression over
sparse words and word pairs is fitted on notices of each licence family (whole,
and in parts) against the class `unknown`: sentences that only speak of licences,
notices of other licences, and paragraphs sampled from the corpus - distinct ones,
drawn by their number of copies, those with a licence word included where no
notice is like them. n-grams common in the corpus can't tell licences and are left
out, so that nearly all paragraphs meet no feature at all; their frequency is
counted over all paragraphs of all documents.

One notice in four (by its place in the list), and one unknown example in three,
is held out of the fit with all its parts. On these a temperature for the logits
is chosen by likelihood, which calibrates the probabilities, those of `unknown`
included. The corpus sample is bounded (`sample` rows, by a cutoff in Spark before
anything reaches the driver).

One pass over the texts writes each paragraph's n-grams that a notice holds too
(a fixed vocabulary); frequencies, sample and scores are taken from those.

Scoring explodes a paragraph's distinct n-grams, meets the weights (a broadcast
table of MAX_FEATURES rows at most) and adds them up by paragraph, combined
before the shuffle. A predicted family is confirmed where one of its notices
shares at least `share` of its word pairs with the paragraph.

The result has a row per line with any feature, and one per group of short lines
that is confirmed while nothing inside it is: doc_id, paragraph (its first line,
from 0), n_lines, family, probability, similarity, confirmed.

Defined cases. Null, empty or blank texts and texts without features: no rows.
Null doc_id: its paragraphs are reported with a null id. Rows of one doc_id
are read as one document: a paragraph number is reported once. Extra columns are
ignored. Empty table: empty result.
"""

from __future__ import annotations

from math import exp, log

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize
from .line_dedup import let

UNKNOWN = "unknown"
#: Usual notices of each family. Every fourth is held out of the fit.
NOTICES = {
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3",
        "Released under the AGPL-3.0 license",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Affero General Public License along with this program",
        "Distributed under the terms of the AGPL version 3 or later",
    ],
    "all-rights-reserved": [
        "All rights reserved.",
        "Copyright 2020 the authors. All rights reserved.",
        "No part of this publication may be reproduced, stored or transmitted in any form without the prior written permission of the publisher",
        "Copyright reserved by the publisher, all rights reserved worldwide",
        "This material is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited",
        "No part of this book may be reproduced without written permission",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org licenses LICENSE-2.0",
        "Released under the Apache 2.0 license",
        "This project is licensed under the terms of the Apache License 2.0",
        "Licensed to the Apache Software Foundation under one or more contributor license agreements",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD license",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This is an open access article distributed under the terms of the Creative Commons Attribution License, which permits unrestricted use, distribution and reproduction in any medium, provided the original work is properly cited",
        "Content is available under the Creative Commons Attribution 4.0 license",
        "Text available under CC BY 4.0 unless otherwise noted",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Released under CC BY-NC for noncommercial use only",
        "Content is available under the Creative Commons Attribution-NonCommercial 4.0 license",
        "You may not use the material for commercial purposes under the CC BY-NC license",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply",
        "Content is available under the Creative Commons Attribution-ShareAlike 4.0 license",
        "Released under CC BY-SA; share alike under the same license",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Licensed under GPL v3",
        "Released under the GPL version 2 or any later version",
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "You should have received a copy of the GNU General Public License along with this program",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
        "Distributed under the terms of the GNU General Public License v2",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1",
        "Released under the LGPL license",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "You should have received a copy of the GNU Lesser General Public License along with this library",
        "Distributed under the LGPL version 3",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        "This project is licensed under the terms of the MIT license",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Released under the MPL 2.0 license",
        "If a copy of the MPL was not distributed with this file, You can obtain one at mozilla.org MPL 2.0",
        "Licensed under the Mozilla Public License version 2.0",
        "Distributed under the terms of the Mozilla Public License",
    ],
    "public-domain": [
        "This work is in the public domain.",
        "Released into the public domain under CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "Dedicated to the public domain under CC0",
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software for any purpose",
    ],
}
#: What speaks of licences and isn't a notice of a family above. Every third is held out of the fit.
OTHERS = [
    "You need a driving license to rent a car in this country.",
    "The driver was stopped because the license had expired.",
    "Her medical license was renewed by the board last year.",
    "The bar lost its license to sell alcohol after the complaint.",
    "Copyright law protects original works of authorship.",
    "He wrote a long essay about copyright and the public library.",
    "The copyright on the photograph was disputed in court.",
    "All seats in the front row are reserved for the family.",
    "The table is reserved for eight people at seven.",
    "She is a reserved and quiet person who rarely speaks in public.",
    "The general public is invited to the free concert in the park.",
    "Free entry for any person with a ticket to the exhibition.",
    "Permission was granted to build a new school on the site.",
    "The domain of the function is the set of all real numbers.",
    "The work was published in the spring and sold many copies.",
    "The museum keeps a copy of the original file and its documents.",
    "Poetic licence lets a writer bend the rules of grammar.",
    "The software is useful for any work with source files.",
    "Commercial use of the hall needs the consent of the council.",
    "The company was licensed to operate the railway for ten years.",
    "Version 2.0 of the report was distributed to the members.",
    "The terms of the agreement were read out to the public.",
    "Licensed under the Eclipse Public License 2.0",
    "Distributed under the Boost Software License, Version 1.0",
    "Licensed under the European Union Public Licence 1.2",
    "This software is provided as-is under the zlib license",
    "Licensed under the ISC license",
    "By clicking accept you agree to the end user license agreement",
    "Licensed under the Artistic License 2.0",
    "This product includes software under a commercial license from the vendor",
]
FAMILIES = [*sorted(NOTICES), UNKNOWN]
MAX_FEATURES = 4_000
SAMPLE = 1_500
COMMON = 0.02
WRAPPED, SPANS = 120, 3
HEAD = 16
MARKS = ["license", "licensed", "licence", "licenced", "copyright", "reserved"]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def pairs(w: Column) -> Column:
    return F.when(F.size(w) > 1, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))


def grams_of(words: list[str]) -> set[str]:
    """Distinct words and word pairs."""
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


def lines(docs: DataFrame, grams: list[str]) -> DataFrame:
    """doc_id, paragraph, n_lines, h (hash of its words), marked (a licence word in it), met (which of grams it holds).

    A row per line with a word, and per 2 to SPANS short lines in a row.
    """
    single = sorted({w for g in grams for w in g.split(" ")})

    def units(x: Column) -> Column:
        unit = lambda i, n, w: F.struct(i.alias("paragraph"), F.lit(n).alias("n_lines"), w.alias("w"))

        def together(n: int) -> Column:
            wrapped = lambda i: F.forall(F.slice(x, i + 1, n), lambda y: y["short"]) & (i + n <= F.size(x))
            return F.filter(F.transform(x, lambda y, i: F.when(wrapped(i), unit(i, n, F.flatten(F.transform(F.slice(x, i + 1, n), lambda z: z["w"]))))), lambda u: u.isNotNull())

        return F.concat(F.transform(x, lambda y, i: unit(i, 1, y["w"])), *map(together, range(2, SPANS + 1)))

    split = F.transform(F.split("text", "\n", -1), lambda y: F.struct(words(y).alias("w"), F.length(y).between(1, WRAPPED).alias("short")))
    rows = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long"), F.explode(let(split, units)).alias("u")).select("doc_id", "u.*").where(F.size("w") > 0)
    # words outside of any gram become null, and so do pairs with them
    rows = rows.select("doc_id", "paragraph", "n_lines", F.xxhash64("w").alias("h"), F.arrays_overlap("w", F.array(*map(F.lit, MARKS))).alias("marked"), F.transform("w", lambda x: F.when(x.isin(single), x)).alias("v"))
    both = F.zip_with("v", F.slice("v", 2, F.size("v")), lambda a, b: F.concat(a, F.lit(" "), b))
    met = F.filter(F.array_distinct(F.concat("v", both)), lambda g: g.isin(grams))
    return rows.select("doc_id", "paragraph", "n_lines", "h", "marked", met.alias("met")).where("n_lines = 1 OR size(met) > 0")


def _notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f, n) for f in sorted(NOTICES) for n in NOTICES[f]], "family string, notice string")


def _plain(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def _parts(text: str) -> list[list[str]]:
    """A text's words, and its halves and most of it where it is long."""
    w = _plain(text)
    return [w, *([w[: len(w) // 2], w[len(w) // 2 :], w[len(w) // 3 :], w[: 2 * len(w) // 3]] if len(w) >= 9 else [])]


def _licences() -> list[tuple[str, list[str], bool]]:
    """Family, words and whether held out of the fit: the notices, whole and in parts, never on both sides."""
    notices = [(family, n, k % 4 == 3) for family in sorted(NOTICES) for k, n in enumerate(NOTICES[family])]
    fitted = {tuple(w) for _, n, held in notices if not held for w in _parts(n)}
    parts = [(family, w, held) for family, n, held in notices for w in _parts(n)]
    return [(family, w, held) for family, w, held in parts if not held or tuple(w) not in fitted]


def licence_grams() -> list[str]:
    """The n-grams of all notices: a vocabulary that doesn't grow with the corpus."""
    return sorted({g for _, w, _ in _licences() for g in grams_of(w)})


def common_grams(rows: DataFrame) -> set[str]:
    """The n-grams in over COMMON of all paragraphs but those with a licence word, every copy counted."""
    clean = rows.where("NOT marked AND n_lines = 1")
    n = clean.count()
    seen = clean.select(F.explode("met").alias("g")).groupBy("g").count().where(F.col("count") > COMMON * max(n, 50))
    return {r.g for r in seen.collect()}  # of licence_grams()


def _drawn(rows: DataFrame, sample: int) -> list[list[str]]:
    """n-grams of `sample` distinct paragraphs, drawn without replacement by their number of copies (least of exponential times).

    Times over HEAD times the expected last one are cut off first, so that tasks
    return about HEAD * sample rows together, whatever the input.
    """
    n = rows.count()
    distinct = rows.groupBy("h").agg(F.count("*").alias("n"), F.first("met").alias("met"))
    uniform = (F.pmod(F.xxhash64("h", F.lit(5)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    timed = distinct.select("h", "met", (-F.log(uniform) / F.col("n")).alias("time")).where(F.col("time") < HEAD * sample / max(n, 1))
    return [list(r.met) for r in timed.orderBy("time", "h").limit(sample).collect()]


def _unknown(rows: DataFrame, sample: int) -> list[list[str]]:
    """n-grams of sampled paragraphs: `sample` without a licence word, and a fourth of that with one that no notice is like."""
    single = rows.where("n_lines = 1")
    notices = [set(zip(w, w[1:], strict=False)) for _, w, _ in _licences() if len(w) > 2]

    def like(met: list[str]) -> float:
        have = {tuple(g.split(" ")) for g in met if " " in g}
        return max(len(have & n) / len(n) for n in notices)

    return _drawn(single.where("NOT marked"), sample) + [m for m in _drawn(single.where("marked"), sample // 4) if like(m) < 0.25]


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[tuple[str, list[float]]], list[float]]:
    """Weights (n-gram, one number a family) and intercepts, divided by the temperature."""
    return fit_lines(materialize(lines(docs, licence_grams()), "license-lines"), sample)


def fit_lines(rows: DataFrame, sample: int = SAMPLE) -> tuple[list[tuple[str, list[float]]], list[float]]:
    """fit() on lines() of all licence_grams()."""
    spark = rows.sparkSession
    common = common_grams(rows)
    vocabulary = [g for g in licence_grams() if g not in common]
    if len(vocabulary) > MAX_FEATURES:
        raise ValueError(f"the notices have {len(vocabulary)} n-grams; {MAX_FEATURES} may be broadcast")
    # n-grams outside of the vocabulary are no features, so the licence n-grams of a paragraph are enough
    parts = [(f, sorted(grams_of(w)), held) for f, w, held in _licences()]
    others = [[sorted(grams_of(w)) for w in _parts(o)[:1]] for o in OTHERS] + [[g] for g in _unknown(rows, sample)]
    parts += [(UNKNOWN, g, k % 3 == 2) for k, gs in enumerate(others) for g in gs]
    parts += [(UNKNOWN, ["\u0000"], False)] * 5  # a paragraph without features
    rows = spark.createDataFrame([(float(FAMILIES.index(f)), g, held) for f, g, held in parts], "label double, grams array<string>, held boolean")
    vectorizer = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features").setBinary(True)
    data = vectorizer.transform(rows).select("label", "features", "held")
    model = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60).fit(data.where("NOT held"))
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    held = [(int(r.label), intercepts + matrix @ r.features.toArray()) for r in data.where("held").collect()]

    def loss(t: float) -> float:
        out = 0.0
        for y, z in held:
            top = max(z) / t
            out += log(sum(exp(v / t - top) for v in z)) + top - z[y] / t
        return out

    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    weights = [(g, [float(v) for v in matrix[:, k] / temperature]) for k, g in enumerate(vocabulary)]
    return weights, [float(v) for v in intercepts / temperature]


def scan(docs: DataFrame, weights: list[tuple[str, list[float]]], intercepts: list[float], share: float = 0.6) -> DataFrame:
    return scan_lines(lines(docs, [g for g, _ in weights]), weights, intercepts, share)


def scan_lines(rows: DataFrame, weights: list[tuple[str, list[float]]], intercepts: list[float], share: float = 0.6) -> DataFrame:
    """scan() on lines() of the weights' n-grams at least."""
    spark = rows.sparkSession
    table = F.broadcast(spark.createDataFrame(weights, "gram string, w array<double>"))
    unit = ["doc_id", "paragraph", "n_lines"]
    grams = rows.select(*unit, F.explode("met").alias("gram"))
    sums = grams.join(table, "gram").groupBy(*unit).agg(F.sort_array(F.collect_set(F.struct("gram", "w"))).alias("met"))
    logits = F.aggregate("met", F.array(*map(F.lit, intercepts)), lambda z, m: F.zip_with(z, m["w"], lambda a, b: a + b))
    sums = sums.select(*unit, F.col("met.gram").alias("grams"), logits.alias("z"))
    scored = sums.withColumn("top", F.array_max("z"))
    total = F.aggregate("z", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("top")))
    best = F.element_at(F.array(*map(F.lit, FAMILIES)), F.array_position("z", F.col("top")).cast("int"))
    scored = scored.select(*unit, "grams", best.alias("family"), (1 / total).alias("probability"))
    known = {g for g, _ in weights}
    notices = _notices(spark).select("family", F.array_distinct(F.concat(pairs(words(F.col("notice"))))).alias("pairs"))
    notices = notices.select("family", F.filter("pairs", lambda p: p.isin(*sorted(g for g in known if " " in g))).alias("pairs")).where(F.size("pairs") > 0)
    notices = F.broadcast(notices.groupBy("family").agg(F.collect_list("pairs").alias("notices")))
    similar = F.array_max(F.transform("notices", lambda p: F.size(F.array_intersect("grams", p)) / F.size(p)))
    out = scored.join(notices, "family", "left").withColumn("similarity", F.coalesce(similar, F.lit(0.0)))
    confirmed = (F.col("family") != UNKNOWN) & (F.col("probability") >= 0.5) & (F.col("similarity") >= share)
    out = out.select(*unit, "family", "probability", "similarity", confirmed.alias("confirmed")).where("n_lines = 1 OR confirmed")
    return _least(materialize(out, "license-units"))


def _least(units: DataFrame) -> DataFrame:
    """units without groups of lines that hold a confirmed unit of their own family."""
    groups = units.where("n_lines > 1")
    inside = F.filter(
        F.flatten(F.transform(F.sequence(F.lit(1), F.col("n_lines") - 1), lambda n: F.transform(F.sequence(F.lit(0), F.col("n_lines") - n), lambda k: F.struct((F.col("paragraph") + k).alias("p"), n.alias("n"))))),
        lambda s: s.isNotNull(),
    )
    parts = groups.select("doc_id", "family", "paragraph", "n_lines", F.explode(inside).alias("s"))
    held = units.where("confirmed").select(F.col("doc_id").alias("d"), F.col("family").alias("f"), F.col("paragraph").alias("p"), F.col("n_lines").alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("family") == F.col("f"))
    larger = parts.join(held, same & (F.col("s.p") == F.col("p")) & (F.col("s.n") == F.col("n")), "left_semi")
    larger = larger.select(F.col("doc_id").alias("d"), F.col("family").alias("f"), F.col("paragraph").alias("p"), F.col("n_lines").alias("n")).distinct()
    left = groups.join(larger, same & (F.col("paragraph") == F.col("p")) & (F.col("n_lines") == F.col("n")), "left_anti")
    return units.where("n_lines = 1").unionByName(left)


def op5_license_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = materialize(lines(docs, licence_grams()), "license-lines")
    return scan_lines(rows, *fit_lines(rows))
