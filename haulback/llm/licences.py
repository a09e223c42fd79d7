"""Licence scans by a trained paragraph classifier, in DataFrame operations only.

A paragraph (line) is the set of its word bigrams and trigrams, as hashes. A sparse multinomial logistic regression
over the n-grams of licence wording scores the licence families against ordinary text; the margin of the best family
is calibrated into a probability, below which a paragraph that isn't ordinary is ``unknown``; and a family is
confirmed by comparing the paragraph's n-grams with the family's templates.

Scoring joins the n-grams of all paragraphs with the weights, a table bounded by the templates.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulback.session import materialize

#: Documents whose lines stand for ordinary text in training, about, and lines that each gives at most.
ORDINARY_DOCS, ORDINARY_LINES = 400, 12
#: Words of the excerpts that templates are cut into, beside the whole.
EXCERPTS = (8, 16, 32)
#: A calibrated probability below this makes a family unknown.
LEAST_CONFIDENCE = 0.5
#: Share of the shorter one's n-grams that paragraph and template must have in common.
LEAST_OVERLAP = 0.4
REGULARISATION, SPARSITY = 0.0005, 0.3
ORDINARY, UNKNOWN = "", "unknown"

# Names of licences, by family, as notices call them.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license", "Apache Software License"],
    "MIT": ["MIT License", "MIT license terms", "Expat MIT License", "X11 MIT License"],
    "BSD": ["BSD License", "3-Clause BSD License", "2-Clause BSD License", "New BSD License", "BSD-style license", "BSD-3-Clause license"],
    "ISC": ["ISC License", "Internet Systems Consortium License"],
    "GPL": ["GNU General Public License", "GNU GPL, version 2 or later", "GNU General Public License, version 2", "GNU General Public License v3.0", "GPLv3 license", "GNU General Public License, version 3"],
    "LGPL": ["GNU Lesser General Public License", "GNU LGPL, version 2.1", "GNU Lesser General Public License, version 3", "LGPLv3 license"],
    "AGPL": ["GNU Affero General Public License", "GNU AGPL, version 3", "Affero General Public License, version 3", "AGPLv3 license"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0 license"],
    "EPL": ["Eclipse Public License 2.0", "Eclipse Public License, version 1.0", "EPL 2.0 license"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "zlib": ["zlib License", "zlib/libpng License"],
    "Unlicense": ["Unlicense", "Unlicense public domain dedication"],
    "CC0": ["CC0 1.0 Universal public domain dedication", "Creative Commons CC0 1.0 Universal License", "CC0 1.0 license"],
    "CC-BY": ["Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License", "CC BY 4.0 license", "CC BY 3.0", "Creative Commons Attribution 3.0 Unported License"],
    "CC-BY-SA": ["Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike License", "CC BY-SA 4.0 license", "CC BY-SA 3.0"],
    "CC-BY-NC": ["Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial License", "CC BY-NC 4.0 license", "CC BY-NC 3.0"],
}
# Ways in which notices name a licence.
NOTICES = [
    "Distributed under the terms of the {}.", "This software is made available under the {}, see the file COPYING.", "The code is covered by the {}.",
    "You may use, copy and modify it under the {}.", "Its source is provided under the {} as found in the repository.", "Subject to the {}.",
    "This package is free under the {}.", "{}", "Terms: {}.", "Published under {}.",
]
# Wording of the licences' own texts and standard headers.
WORDING = [
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL", "You should have received a copy of the GNU General Public License along with this program. If not, see http://www.gnu.org/licenses/."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("AGPL", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("EPL", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. The origin of this software must not be misrepresented; altered source versions must be plainly marked as such"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose"),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY", "You are free to share and adapt the material for any purpose, even commercially, as long as you give appropriate credit, provide a link to the license, and indicate if changes were made."),
    ("CC-BY-SA", "If you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original."),
    ("CC-BY-NC", "You may not use the material for commercial purposes without permission of the licensor."),
    ("proprietary", "All rights reserved"),
    ("proprietary", "Copyright by the publisher, all rights reserved worldwide."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means, without the prior written permission of the publisher."),
    ("proprietary", "This document is confidential and proprietary and may not be copied or disclosed without written consent. Unauthorized copying of this file, via any medium, is strictly prohibited."),
]
# Sentences that use the words of notices for other things.
EVERYDAY = [
    "He had to renew his driving license at the office before the trip, and the fishing license for the summer.",
    "The council granted a license to the restaurant, and the public hearing was open to any person.",
    "Members of the general public were free to use the room without charge under the terms of the lease.",
    "The rights of the tenants are covered by the law of the land, and their copy of the contract was found in the drawer.",
    "Seats are reserved for all members, who have rights to vote under the terms of the agreement.",
    "The leaflet was distributed under the bridge, and published under another name in the spring.",
    "You may use, copy and modify it under the guidance of the teacher, subject to the weather.",
    "The water is made available under the counter, see the file in the cabinet; it is free under the terms of the offer.",
    "Its source is provided under the rock as found in the valley, and the code is known to the guard.",
    "The software version was old, the commons were green, and the foundation of the house is clear and open to the world.",
]
_NOTICES = [(family, notice.format(name)) for family, names in NAMES.items() for name in names for notice in NOTICES]
TEMPLATES = [*_NOTICES, *WORDING, *((ORDINARY, text) for text in EVERYDAY)]
FAMILIES = sorted({f for f, _ in TEMPLATES} - {ORDINARY})


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+", -1), lambda w: w != "")


def _grams(frame: DataFrame, words: str) -> DataFrame:
    """``frame`` with ``grams``, the distinct hashes of bigrams and trigrams of the column ``words``, in its place."""
    rest = [c for c in frame.columns if c != words]
    shifted = lambda name, by: F.slice(name, by + 1, F.greatest(F.size(name) - by, F.lit(0)))
    cut = lambda name, by: F.slice(name, 1, F.greatest(F.size(name) - by, F.lit(0)))
    hashed = frame.select(*rest, F.transform(words, lambda w: F.xxhash64(w)).alias("one"))
    paired = hashed.select(*rest, "one", F.zip_with(cut("one", 1), shifted("one", 1), lambda a, b: F.xxhash64(a, b)).alias("two"))
    three = F.zip_with(cut("two", 1), shifted("one", 2), lambda a, b: F.xxhash64(a, b))
    return paired.select(*rest, F.array_distinct(F.concat("two", three)).alias("grams"))


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from values of the driver, as a literal of the plan."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def paragraphs(docs: DataFrame) -> DataFrame:
    """row (hash of doc_id and text), pos and words of every line."""
    lines = docs.select(F.xxhash64("doc_id", "text").alias("row"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return lines.select("row", "pos", _words(F.col("line")).alias("words"))


class LicenceModel:
    """Weights and templates as small tables, the templates' n-grams with their weights, and the two numbers of the calibration."""

    def __init__(self, weights: DataFrame, templates: DataFrame, intercepts: dict[str, float], scale: float, shift: float):
        self.weights, self.templates, self.intercepts, self.scale, self.shift = weights, templates, intercepts, scale, shift
        # all n-grams of the templates; those of the model are some of them, the others have no weights
        self.wording = materialize(templates.select("gram").distinct().join(weights, "gram", "left"), "licence-wording")


def train(docs: DataFrame) -> LicenceModel:
    """Fit the classifier on the templates and on lines of ``ORDINARY_DOCS`` documents, chosen by hash.

    Lines that share a trigram or bigram pair with licence wording aren't taken for ordinary. N-grams that ordinary
    text has too are no features. A fifth of the notices, chosen by hash, and of the ordinary lines calibrate the margin.
    """
    spark = docs.sparkSession
    given = _table(spark, [{"id": k, "family": f, "text": t} for k, (f, t) in enumerate(TEMPLATES)], "id:int,family:string,text:string")
    worded = given.select("id", "family", _words(F.col("text")).alias("words"))
    cuts = [F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - n + 1), F.lit(max(1, n // 3))), lambda i, n=n: F.slice("words", i, n)) for n in EXCERPTS]
    # a fifth of the notices, not of their excerpts, calibrate; what any other one says too doesn't
    held = ((F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(5)) == 0) & (F.col("id") < len(_NOTICES))).alias("held")
    excerpts = worded.select("family", held, F.explode(F.concat(F.array("words"), *cuts)).alias("words"))
    excerpts = _grams(excerpts.distinct(), "words").filter(F.size("grams") > 0).withColumn("grams", F.array_sort("grams"))
    positive = materialize(excerpts.groupBy("family", "grams").agg(F.bool_and("held").alias("held")), "licence-excerpts")
    wording = _grams(worded.filter(F.col("family") != ORDINARY), "words")
    templates = materialize(wording.select("id", "family", F.size("grams").alias("n_template"), F.explode("grams").alias("gram")), "licence-templates")

    share = min(1.0, ORDINARY_DOCS / max(1, docs.count()))
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("ordinary")), F.lit(1_000_000)) < F.lit(round(share * 1_000_000)))
    lines = paragraphs(chosen.select("doc_id", "text")).filter((F.col("pos") < ORDINARY_LINES) & (F.size("words") > 1))
    lines = materialize(_grams(lines, "words"), "licence-lines")
    exploded = lines.select("row", "pos", F.explode("grams").alias("gram"))
    met = exploded.join(templates.select("gram").distinct(), "gram").groupBy("row", "pos").agg(F.count_distinct("gram").alias("shared"))
    ordinary = lines.join(met.filter("shared > 2"), ["row", "pos"], "left_anti").select(F.lit(ORDINARY).alias("family"), F.array_sort("grams").alias("grams")).distinct()
    ordinary = ordinary.withColumn("held", F.pmod(F.xxhash64("grams", F.lit("fold")), F.lit(5)) == 0)

    rows = positive.unionByName(ordinary)
    common = rows.filter(F.col("family") == ORDINARY).select(F.explode("grams").alias("gram")).distinct()
    usable = positive.filter(F.col("family") != ORDINARY).select(F.explode("grams").alias("gram")).distinct().join(common, "gram", "left_anti")
    keyed = rows.withColumn("key", F.xxhash64("family", "grams"))
    kept = keyed.select("key", "family", F.explode("grams").alias("gram")).join(usable, "gram")
    kept = keyed.select("key", "family", "held").join(kept.groupBy("key").agg(F.sort_array(F.collect_set(F.col("gram").cast("string"))).alias("terms")), "key", "left")
    kept = kept.select("key", "family", "held", F.coalesce("terms", F.array().cast("array<string>")).alias("terms"))
    kept = materialize(kept.withColumn("label", F.array_position(F.lit([ORDINARY, *FAMILIES]), F.col("family")).cast("double") - 1), "licence-rows")

    # every family weighs as much as any other, and ordinary text as all of them: few rows are no reason to doubt a name
    sizes = {r["family"]: r["count"] for r in kept.groupBy("family").count().collect()}
    shares = [{"family": f, "weight": (len(FAMILIES) if f == ORDINARY else 1) * sum(sizes.values()) / (2 * len(FAMILIES) * n)} for f, n in sizes.items()]
    kept = kept.join(F.broadcast(_table(spark, shares, "family:string,weight:double")), "family")

    vectors = CountVectorizer(inputCol="terms", outputCol="features", binary=True, vocabSize=1 << 16).fit(kept)
    featured = vectors.transform(kept)
    calibrating = F.col("held")
    fitted = LogisticRegression(family="multinomial", regParam=REGULARISATION, elasticNetParam=SPARSITY, maxIter=60, standardization=False, weightCol="weight").fit(featured.filter(~calibrating))
    matrix, offsets = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    classes = [ORDINARY, *FAMILIES][: len(offsets)]
    weights = _table(spark, [
        {"gram": int(term), "w": [round(float(x), 6) for x in matrix[:, k]]} for k, term in enumerate(vectors.vocabulary) if abs(matrix[:, k]).max() > 1e-4
    ], "gram:bigint,w:array<double>")
    intercepts = dict(zip(classes, map(float, offsets), strict=True))
    model = LicenceModel(materialize(weights, "licence-weights"), templates, intercepts, 1.0, 0.0)

    judged = _scored(kept.filter(calibrating).select(F.col("key").alias("row"), F.lit(0).alias("pos"), F.transform("terms", lambda t: t.cast("long")).alias("grams"), "family"), model, "family")
    right = (F.col("best") == F.col("family")).cast("double").alias("right")
    margins = materialize(judged.select(F.array("margin").alias("m"), right), "licence-margins")
    counts = margins.groupBy("right").count().collect()
    if len(counts) > 1:  # Platt's scaling of the margin
        from pyspark.ml.functions import array_to_vector

        platt = LogisticRegression(labelCol="right", regParam=0.01, standardization=False).fit(margins.select(array_to_vector("m").alias("features"), "right"))
        model.scale, model.shift = max(float(platt.coefficients[0]), 1e-3), float(platt.intercept)
    return model


def _scored(grams: DataFrame, model: LicenceModel, *keys: str) -> DataFrame:
    """Of the paragraphs (row, pos, grams) with any n-gram of the model: ``best`` family, its ``margin`` over ordinary text, and ``met``, all their n-grams that any template has."""
    # outer: an inner explode brings a filter on the array, which the optimizer would work out anew from the text below;
    # the join drops what has no n-gram
    exploded = grams.select("row", "pos", *keys, F.size("grams").alias("n_grams"), F.explode_outer("grams").alias("gram"))
    classes = list(model.intercepts)
    # a set: rows that are repeated bring the same n-grams again
    met = exploded.join(model.wording, "gram").groupBy("row", "pos", "n_grams", *keys).agg(F.array_sort(F.collect_set(F.struct("gram", "w"))).alias("terms"))
    met = met.select("row", "pos", "n_grams", *keys, F.col("terms.gram").alias("met"), F.filter("terms", lambda t: t["w"].isNotNull()).alias("terms"))
    met = met.filter(F.size("terms") > 0).select("row", "pos", "n_grams", *keys, "met", *[
        F.aggregate(F.transform("terms", lambda t: F.get(t["w"], F.lit(k))), F.lit(0.0), lambda total, w: total + w).alias(f"w{k}") for k in range(len(classes))])  # noqa: B023
    logit = [F.col(f"w{k}") + model.intercepts[c] for k, c in enumerate(classes)]
    ranked = F.array_max(F.array(*[F.struct(x.alias("logit"), F.lit(c).alias("family")) for x, c in zip(logit[1:], classes[1:], strict=True)]))
    judged = met.withColumn("first", ranked)
    return judged.select("row", "pos", "n_grams", *keys, "met", F.col("first.family").alias("best"), (F.col("first.logit") - logit[0]).alias("margin"))


def licence_paragraphs(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """Paragraphs that aren't ordinary text: row, pos, family, confidence, overlap, confirmed.

    ``family`` is ``unknown`` where the calibrated confidence is too low, or no template confirms it.
    """
    # few rows, read twice
    found = materialize(_scored(_grams(paragraphs(docs), "words"), model).filter("margin > 0"), "licence-paragraphs")
    met = found.select("row", "pos", F.col("best").alias("family"), "n_grams", "margin", F.explode("met").alias("gram"))
    shared = met.join(model.templates, ["gram", "family"]).groupBy("row", "pos", "id").agg(
        F.count("*").alias("n"), F.first("n_template").alias("n_template"), F.first("n_grams").alias("n_grams"))
    overlap = shared.groupBy("row", "pos").agg(F.max(F.col("n") / F.least("n_template", "n_grams")).alias("overlap"))
    confidence = 1 / (1 + F.exp(-(model.scale * F.col("margin") + model.shift)))
    judged = found.select("row", "pos", "best", confidence.alias("confidence")).join(overlap, ["row", "pos"], "left")
    judged = judged.withColumn("overlap", F.coalesce("overlap", F.lit(0.0))).withColumn("confirmed", F.col("overlap") >= LEAST_OVERLAP)
    sure = F.col("confirmed") & (F.col("confidence") >= LEAST_CONFIDENCE)
    return judged.select("row", "pos", F.when(sure, F.col("best")).otherwise(UNKNOWN).alias("family"), "confidence", "overlap", "confirmed")


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_paragraphs, n_licence, families, confidence.

    ``n_paragraphs`` counts lines with a word, ``families`` are the licence families found, sorted and joined by commas
    (empty: none), ``confidence`` the largest. Null and empty texts have no paragraphs. Every row comes back once, rows
    that repeat others with the same result; a null doc_id stays null; an empty table gives no row; other columns
    aren't read.
    """
    narrow = docs.select("doc_id", "text")
    found = licence_paragraphs(narrow, train(narrow))
    by_row = found.groupBy("row").agg(
        F.count("*").alias("n_licence"), F.array_join(F.sort_array(F.collect_set("family")), ",").alias("families"), F.max("confidence").alias("confidence"))
    worded = F.size(F.filter(F.split("text", "\n", -1), lambda x: F.rlike(x, F.lit("[\\p{L}\\p{N}]"))))
    rows = narrow.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.coalesce(F.when(F.col("text").isNotNull(), worded), F.lit(0)).cast("long").alias("n_paragraphs"))
    return rows.join(by_row, "row", "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n_licence", F.lit(0)).alias("n_licence"),
        F.coalesce("families", F.lit("")).alias("families"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
