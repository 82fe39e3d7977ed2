"""Licence scans with a trained paragraph classifier.

Every line that is not blank, and every paragraph of several lines (blank
lines part them), becomes a sparse bag of hashed word n-grams. A multinomial naive
Bayes classifier is trained on stretches of licence templates, one class a
family, and on all other lines and paragraphs of the table as the class
``unknown``; it needs one pass over them, so none has to be left out. Its
acceptance level is calibrated on all others kept out of training, so that at
most a given part of them would pass. What the classifier accepts is confirmed by
comparison with the family's templates: the part of shared word pairs. No
list of words decides what the classifier sees.

A paragraph has the n-grams of its lines and those across their ends, so each
text is parted into words once, for its lines and its paragraphs together.

Only DataFrame functions and MLlib's JVM estimators are used.
"""

from __future__ import annotations

from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entiscore.llm.tables import stored

UNKNOWN = "unknown"
# Fixed value: what a gram that a class never showed counts as.
SMOOTHING = 0.001

# Usual notices and opening sentences of public licences, by family.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the "
            "warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or "
            "copyright holders be liable for any claim, damages or other liability"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache", "Apache 2.0 license"),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL", "GPL-3.0-or-later"),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("AGPL", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("MPL", "SPDX-License-Identifier: MPL-2.0"),
    ("Apache", "Licensed under the Apache License, Version 2.0."),
    ("Apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
               "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL", "You should have received a copy of the GNU General Public License along with this program."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
             "License as published by the Free Software Foundation; either version 2.1 of the License, or any later version."),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL", "You should have received a copy of the GNU Affero General Public License along with this program."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Licensed under the ISC license."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("Proprietary", "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited."),
)

# Sentences with words of the templates that grant nothing.
NOT_LICENCES: tuple[str, ...] = (
    "He lost his driving license and had to take the bus to work for a year.",
    "The city council granted a liquor license to the restaurant on the corner.",
    "A television licence fee is collected from every household with a set.",
    "Copyright law has been debated in parliament for most of the century.",
    "The general public was not allowed to enter the building under any conditions.",
    "She asked for permission to use the library and its copies of old software manuals.",
    "Free software has changed how programs are written and distributed.",
    "The version of the story that was published differs from the original work.",
    "Under the terms of the agreement the work was to be finished in spring.",
    "The foundation published a free copy of its annual report.",
    "The source of the river lies in the mountains and its forms are many.",
    "International trade rights were released by the commission in the new year.",
    "The public domain of the king included the forest and the lake.",
    "All rights of way on the path are reserved for walkers.",
    "The mit campus is licensed to serve food at the public events of the school.",
)

def words_of(text: Column) -> Column:
    """Lower-case words of letters; digits do not tell families apart."""
    return F.array_remove(F.split(F.lower(text), "[^a-z]+"), "")


def _grams(words: Column, n: int) -> Column:
    """Runs of n words, joined by blanks."""
    last = F.size(words) - n + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(
        F.array().cast("array<string>"))


def _once(value: Column) -> Column:
    """The value, from a generator: a filter moved below a projection would
    take the expression with it and work it out anew at each use."""
    return F.explode(F.array(value))


def _runs(left: str | Column, right: str | Column) -> Column:
    """Hashes of runs that end a word later: of each of ``left`` but the last, with what follows in ``right``."""
    n = F.greatest(F.size(left) - 1, F.lit(0))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.size(right) - n + 1, n), lambda a, b: F.xxhash64(a, b))


def features(rows: DataFrame) -> DataFrame:
    """Rows with ``words`` get ``singles``, ``doubles`` and ``grams``: hashes of
    the words, of runs of two, and of these and runs of three together."""
    rows = rows.withColumn("singles", _once(F.transform("words", lambda x: F.xxhash64(x))))
    rows = rows.withColumn("doubles", _once(_runs("singles", "singles")))
    return rows.withColumn("grams", _once(F.concat("singles", "doubles", _runs("doubles", "singles"))))


def _tf(bits: int) -> HashingTF:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=1 << bits)


def _place(gram: Column, bits: int) -> Column:
    """The feature that :func:`_tf` counts a gram as: both take Murmur3 of it."""
    return F.pmod(F.hash(gram), F.lit(1 << bits))


def counted(rows: DataFrame, bits: int) -> DataFrame:
    """``family, n, grams`` from ``family, gram, n``: how often each feature
    occurs in a family, and one gram that counts as it. Naive Bayes adds up the
    features of a class, so it learns the same from these as from the rows."""
    rows = rows.groupBy("family", _place(F.col("gram"), bits).alias("place"))
    return rows.agg(F.sum("n").alias("n"), F.array(F.min("gram")).alias("grams"))


def hashed(parts: DataFrame) -> DataFrame:
    """Paragraphs get ``singles`` and ``doubles``, the hashes of each line's
    words and runs of two, and ``joints``: for each line with words, where others
    follow, the run of two (``pair``) and those of three (``runs``) that start in
    it and end in a later one."""
    rows = parts.withColumn("singles", _once(F.transform("lines", lambda x: F.transform(words_of(x["line"]), lambda w: F.xxhash64(w)))))
    rows = rows.withColumn("doubles", _once(F.transform("singles", lambda s: _runs(s, s))))
    rows = rows.withColumn("__full", _once(F.filter("singles", lambda s: F.size(s) > 0)))

    def joint(s: Column, i: Column) -> Column:
        after, last, before = F.get("__full", i + 1), F.get(s, F.size(s) - 1), F.get(s, F.size(s) - 2)
        first, second = F.get(after, F.lit(0)), F.coalesce(F.get(after, F.lit(1)), F.get(F.get("__full", i + 2), F.lit(0)))
        runs = F.array(F.when(second.isNotNull(), F.xxhash64(F.xxhash64(last, first), second)), F.when(before.isNotNull(), F.xxhash64(F.xxhash64(before, last), first)))
        return F.when(first.isNotNull(), F.struct(F.xxhash64(last, first).alias("pair"), F.array_compact(runs).alias("runs")))

    return rows.withColumn("joints", _once(F.array_compact(F.transform("__full", joint)))).drop("__full")


def _across() -> Column:
    """The grams of ``joints``."""
    return F.flatten(F.transform("joints", lambda j: F.concat(F.array(j["pair"]), j["runs"])))


class Model:
    """A fitted classifier with its families and acceptance level: by how much
    the likeliest family's log-likelihood has to exceed that of ``unknown``."""

    def __init__(self, classifier: NaiveBayesModel, families: list[str], level: float, bits: int):
        self.classifier, self.families, self.level, self.bits = classifier, families, level, bits

    def _gains(self, rows: DataFrame) -> tuple[DataFrame, float]:
        """Rows with ``__gains``, each feature's largest gain in any family over
        ``unknown``, and the largest gain without features."""
        theta, pi = self.classifier.theta.toArray(), self.classifier.pi.toArray()
        gains = (theta[:-1] - theta[-1]).max(axis=0).tolist()
        gains = rows.sparkSession.createDataFrame([(gains,)], "__gains array<double>")
        return rows.crossJoin(F.broadcast(gains)), float((pi[:-1] - pi[-1]).max()) + 1e-6  # sums in another order differ in the last places

    def _sum(self, grams: str | Column, start: float) -> Column:
        return F.aggregate(grams, F.lit(start), lambda a, g: a + F.get("__gains", _place(g, self.bits)))

    def bounded(self, rows: DataFrame) -> DataFrame:
        """Rows with ``grams`` get ``bound``, which no family's margin over
        ``unknown`` exceeds: the sum of each gram's largest gain in any family."""
        rows, start = self._gains(rows)
        return rows.withColumn("bound", _once(self._sum("grams", start))).drop("__gains")

    def bounded_parts(self, parts: DataFrame) -> DataFrame:
        """Paragraphs of :func:`hashed` get ``bounds``, the :meth:`bounded`
        bound of each line, and ``bound``, that of all lines together."""
        rows, start = self._gains(parts)
        sums = F.zip_with("singles", "doubles", lambda s, d: self._sum(F.concat(s, d, _runs(d, s)), 0.0))
        rows = rows.withColumn("__sums", _once(sums))
        bound = F.aggregate("__sums", F.lit(start), lambda a, x: a + x) + self._sum(_across(), 0.0)
        rows = rows.withColumn("bound", _once(bound)).drop("__gains", "singles", "doubles", "joints")
        return rows.withColumn("bounds", F.transform("__sums", lambda x: x + start)).drop("__sums")

    def judged(self, rows: DataFrame) -> DataFrame:
        """Rows with ``grams`` get ``family`` (the likeliest, or unknown), its ``probability`` and ``margin``."""
        known = len(self.families) - 1  # unknown is the last class
        out = self.classifier.transform(_tf(self.bits).transform(rows))
        out = out.withColumn("__raw", _once(vector_to_array("rawPrediction")))
        of, best = F.slice("__raw", 1, known), F.array_max(F.slice("__raw", 1, known))
        out = out.withColumn("margin", _once(best - F.col("__raw")[known])).withColumn("probability", F.array_max(F.slice(vector_to_array("probability"), 1, known)))
        names = F.array(*(F.lit(f) for f in self.families[:-1]))
        family = F.when(F.col("margin") > self.level, F.element_at(names, F.array_position(of, best).cast("int"))).otherwise(F.lit(UNKNOWN))
        return out.withColumn("family", family).drop("singles", "doubles", "grams", "features", "rawPrediction", "prediction", "__raw")

    def accepted(self, rows: DataFrame) -> DataFrame:
        """The rows with ``words`` that are of a family. Those whose bound is not
        above the level are not: only the others are tried with each family."""
        rows = self.bounded(features(rows)).filter(F.col("bound") > self.level).drop("bound")
        return self.judged(rows).filter(F.col("family") != UNKNOWN)

    def margins(self, parts: DataFrame) -> DataFrame:
        """``margin`` of each line and paragraph of :func:`other_parts`, where it is above 0; else a value that is not."""
        unit = lambda text, bound: F.struct(F.when(bound > 0, text).otherwise("").alias("text"), bound.alias("bound"))
        lines = F.transform(F.filter(F.arrays_zip("lines", "kept", "bounds"), lambda x: x["kept"]), lambda x: unit(x["lines"]["line"], x["bounds"]))
        whole = F.array(unit(joined(F.col("lines")), F.col("bound")))
        rows = self.bounded_parts(parts).select(F.inline(F.concat(lines, F.when(F.col("whole"), whole).otherwise(F.slice(whole, 1, 0)))))
        # Only those whose bound is above 0 are tried with each family.
        rows = self.judged(features(rows.select("bound", _once(words_of(F.col("text"))).alias("words"))))
        return rows.select(F.when(F.col("bound") > 0, F.col("margin")).otherwise(F.col("bound")).alias("margin"))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col`` and ``lines`` (array of ``n``, from 0, and ``line``) of every
    paragraph: lines that are not blank, up to a blank one or the text's end."""
    kept = F.filter(F.transform(F.split(text_col, "\n"), lambda x, i: F.struct(i.alias("n"), x.alias("line"))),
                    lambda x: F.ltrim(x["line"], F.lit(" \t\n\x0b\f\r")) != "")
    rows = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col), _once(kept).alias("__kept")).filter(F.size("__kept") > 0)
    starts = F.filter(F.sequence(F.lit(0), F.size("__kept") - 1), lambda i: (i == 0) | (F.get("__kept", i)["n"] != F.get("__kept", i - 1)["n"] + 1))
    rows = rows.withColumn("__starts", _once(starts))
    parts = F.transform("__starts", lambda s, i: F.slice("__kept", s + 1, F.coalesce(F.get("__starts", i + 1), F.size("__kept")) - s))
    return rows.select(id_col, F.explode(parts).alias("lines"))


def joined(lines: Column) -> Column:
    """The text of a paragraph."""
    return F.array_join(F.transform(lines, lambda x: x["line"]), " ")


def units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``text`` of all that is classified: every line, and every paragraph of several lines."""
    whole = F.when(F.size("lines") > 1, F.array(joined(F.col("lines")))).otherwise(F.array().cast("array<string>"))
    return paragraphs(docs, id_col, text_col).select(F.explode(F.concat(F.transform("lines", lambda x: x["line"]), whole)).alias("text"))


def _pairs(words: Column) -> Column:
    """The distinct word pairs; of a single word, that word."""
    return F.when(F.size(words) > 1, F.array_distinct(_grams(words, 2))).otherwise(F.array_distinct(words))


def _template_pairs(spark: SparkSession) -> DataFrame:
    """``t_family, t_pairs``: the pairs of each template."""
    return (spark.createDataFrame(TEMPLATES, "t_family string, text string").withColumn("t_pairs", _pairs(words_of(F.col("text"))))
            .groupBy("t_family").agg(F.collect_list("t_pairs").alias("t_pairs")))


def _similarity(pairs: str) -> Column:
    """The largest part of shared pairs (of the shorter of the two) with a template in ``t_pairs``."""
    part = lambda t: F.size(F.array_intersect(F.col(pairs), t)) / F.greatest(F.lit(1), F.least(F.size(pairs), F.size(t)))
    return F.array_max(F.transform("t_pairs", part))


def _half_shared(pairs: Column, size: Column) -> Column:
    """Whether half of the pairs (of the shorter of the two) are shared with a
    template in ``t_pairs``: ``pairs`` are those that any has, ``size`` is the
    number of all. Where the shorter has over twice as many, none need be tried."""
    near = F.filter("t_pairs", lambda t: F.least(size, F.size(t)) <= 2 * F.size(pairs))
    return F.exists(near, lambda t: 2 * F.size(F.array_intersect(pairs, t)) >= F.greatest(F.lit(1), F.least(size, F.size(t))))


def _hashed_pairs() -> Column:
    """The pairs of :func:`_pairs`, as hashes."""
    return F.array_distinct(F.when(F.size("words") > 1, F.col("doubles")).otherwise(F.col("singles")))


def other_parts(others: DataFrame, text_col: str, kept_out: bool, seed: int) -> DataFrame:
    """Paragraphs of :func:`hashed` with ``kept`` (for each line whether it is
    one of the others) and ``whole`` (whether the paragraph of several lines
    is). A third of the lines and paragraphs (by the hash of their text) is
    kept out and two thirds are not. Those that share half of their word pairs
    with a template are no others. Lines that nothing needs are left out."""
    near = features(others.sparkSession.createDataFrame(TEMPLATES, "family string, text string").select(words_of(F.col("text")).alias("words")))
    near = near.agg(F.collect_list(_hashed_pairs()).alias("t_pairs"))
    t_any = ", ".join(map(str, near.select(F.array_distinct(F.flatten("t_pairs"))).first()[0]))  # fixed values
    mine = lambda text: (F.pmod(F.xxhash64(F.lit(seed), text), F.lit(3)) == 0) == F.lit(kept_out)

    rows = paragraphs(others.select(F.lit(0).alias("id"), F.col(text_col).alias("text")), "id", "text")
    rows = rows.select("lines", _once((F.size("lines") > 1) & mine(joined(F.col("lines")))).alias("whole"))
    lines = F.when(F.col("whole"), F.col("lines")).otherwise(F.filter("lines", lambda x: mine(x["line"])))
    rows = hashed(rows.select("whole", _once(lines).alias("lines")).filter(F.size("lines") > 0))
    # Pairs that no template has are dropped before the templates are tried one by one; the size is that of all pairs.
    rows = rows.withColumn("__some", _once(F.expr(f"transform(singles, (s, i) -> filter(if(size(s) > 1, doubles[i], s), x -> x IN ({t_any})))")))
    unit = lambda some, pairs: F.struct(some.alias("some"), F.when(F.size(some) > 0, F.size(F.array_distinct(pairs))).alias("size"))
    lines = F.zip_with("singles", F.arrays_zip("doubles", "__some"), lambda s, x: unit(x["__some"], F.when(F.size(s) > 1, x["doubles"]).otherwise(s)))
    # The pairs of all lines together: a line of one word has none of its own, unless it is the only word.
    words, pairs = F.flatten("singles"), F.concat(F.flatten("doubles"), F.col("joints.pair"))
    within = F.flatten(F.zip_with("doubles", "__some", lambda d, x: F.when(F.size(d) > 0, x).otherwise(d)))
    every = unit(F.concat(within, F.expr(f"filter(joints.pair, x -> x IN ({t_any}))")), pairs)
    every = F.when(F.size(words) > 1, every).otherwise(unit(F.flatten("__some"), words))
    rows = rows.withColumn("__units", _once(lines)).withColumn("__every", _once(F.when(F.col("whole"), every))).crossJoin(F.broadcast(near))
    other = lambda u: F.when(F.size(u["some"]) > 0, ~_half_shared(u["some"], u["size"])).otherwise(True)
    rows = rows.withColumn("kept", _once(F.zip_with("lines", "__units", lambda x, u: mine(x["line"]) & other(u))))
    return rows.withColumn("whole", _once(F.col("whole") & other(F.col("__every")))).select("lines", "singles", "doubles", "joints", "kept", "whole")


def other_units(others: DataFrame, text_col: str, kept_out: bool, seed: int) -> DataFrame:
    """The lines and paragraphs of :func:`other_parts` as rows of ``words`` and ``grams``."""
    lines = F.transform(F.filter(F.arrays_zip("lines", "kept"), lambda x: x["kept"]), lambda x: x["lines"]["line"])
    whole = F.when(F.col("whole"), F.array(joined(F.col("lines")))).otherwise(F.array().cast("array<string>"))
    rows = other_parts(others, text_col, kept_out, seed).select(F.explode(F.concat(lines, whole)).alias("text"))
    return features(rows.select(_once(words_of(F.col("text"))).alias("words"))).select("words", "grams")


def other_grams(parts: DataFrame) -> DataFrame:
    """``gram, n`` of the lines and paragraphs of :func:`other_parts`: ``n`` tells how many of them a gram stands in here."""
    whole = F.col("whole").cast("int")
    lines = F.zip_with("singles", "kept", lambda s, k: F.struct(s.alias("hashes"), (k.cast("int") + whole).alias("n"), F.lit(True).alias("words")))
    across = F.struct(_across().alias("hashes"), whole.alias("n"), F.lit(False).alias("words"))
    rows = parts.select(F.inline(F.concat(lines, F.array(across)))).filter((F.col("n") > 0) & (F.size("hashes") > 0))
    rows = rows.select("hashes", "n", "words", F.explode(F.sequence(F.lit(0), F.size("hashes") - 1)).alias("i"))
    a, b, c = (F.get("hashes", F.col("i") + k) for k in range(3))
    more = F.col("words")  # runs of lines; those across are made already
    rows = rows.select("n", F.explode(F.array(a, F.when(more & b.isNotNull(), F.xxhash64(a, b)), F.when(more & c.isNotNull(), F.xxhash64(F.xxhash64(a, b), c)))).alias("gram"))
    return rows.filter(F.col("gram").isNotNull()).select("gram", "n")


def train(spark: SparkSession, others: DataFrame, bits: int = 14, false_part: float = 0.01, seed: int = 3, text_col: str = "text") -> Model:
    """Fit on stretches of the templates against the fixed sentences and all
    others (:func:`other_parts`) that are not kept out. The third kept out sets
    the acceptance level: at most ``false_part`` of them may pass it, and a
    family is at least as likely as ``unknown``. Without others the fixed
    sentences serve alone."""
    t = spark.createDataFrame(TEMPLATES, "family string, text string").withColumn("words", words_of(F.col("text")))
    # The whole template, and stretches of 6, 10 and 16 words from every second word on.
    spans = F.expr("concat(array(named_struct('s', 1, 'n', size(words))), flatten(transform(array(6, 10, 16), n -> "
                   "transform(filter(sequence(1, size(words), 2), s -> s + n - 1 <= size(words)), s -> named_struct('s', s, 'n', n)))))")
    known = (t.withColumn("span", F.explode(spans)).select("family", F.slice("words", F.col("span.s"), F.col("span.n")).alias("words")))
    fixed = spark.createDataFrame([(x,) for x in NOT_LICENCES], "text string").select(words_of(F.col("text")).alias("words"))
    given = known.unionByName(fixed.select(F.lit(UNKNOWN).alias("family"), "words"))
    given = features(given).select("family", F.explode("grams").alias("gram"), F.lit(1).alias("n"))
    other = other_grams(other_parts(others, text_col, False, seed)).select(F.lit(UNKNOWN).alias("family"), "gram", "n")
    families = [*sorted({f for f, _ in TEMPLATES}), UNKNOWN]
    rows = counted(given.unionByName(other), bits)
    label = F.lit(float(len(families) - 1))
    for i, f in enumerate(families[:-1]):
        label = F.when(F.col("family") == f, F.lit(float(i))).otherwise(label)
    rows = stored(rows.withColumn("label", label), "licence-counts")  # the fit reads them more than once
    data = _tf(bits).transform(rows).select("label", "features", F.col("n").cast("double").alias("n"))
    model = Model(NaiveBayes(smoothing=SMOOTHING, weightCol="n").fit(data), families, 0.0, bits)
    level = model.margins(other_parts(others, text_col, True, seed)).agg(F.percentile_approx("margin", 1 - false_part, 10_000)).first()[0]
    model.level = max(0.0, float(level or 0.0))
    return model


def scan(docs: DataFrame, model: Model, least_similarity: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, paragraph, family, probability, similarity, confirmed`` of
    every line that the classifier puts into a family (``paragraph`` is the
    line's number from 0): by itself, or else with the paragraph it stands in,
    so that the lines of a wrapped notice are found as well.

    ``similarity`` is the largest part of shared word pairs with a template of
    the family (of the shorter of line and template), and ``confirmed`` whether
    it reaches ``least_similarity``. Null and empty texts have no lines; rows
    with null ids and repeated rows are scanned like others; an empty table
    gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    parts = model.bounded_parts(hashed(paragraphs(docs, id_col, text_col)))
    # Lines, and paragraphs of several, whose bound is not above the level are of no family.
    alone = F.transform(F.filter(F.arrays_zip("lines", "bounds"), lambda x: x["bounds"] > model.level), lambda x: F.array(x["lines"]))
    whole = F.when((F.size("lines") > 1) & (F.col("bound") > model.level), F.array("lines"))
    tried = parts.select(id_col, F.explode(F.concat(F.transform(alone, lambda x: F.struct(F.lit(True).alias("alone"), x.alias("lines"))),
                                                    F.transform(F.coalesce(whole, F.slice(F.array("lines"), 1, 0)), lambda x: F.struct(F.lit(False).alias("alone"), x.alias("lines"))))).alias("unit"))
    tried = tried.select(id_col, "unit.alone", "unit.lines").withColumn("words", _once(words_of(joined(F.col("lines")))))
    found = model.accepted(tried).select(id_col, "alone", F.col("family").alias("of"), F.col("probability").alias("of_probability"), F.explode("lines").alias("at"))
    found = found.select(id_col, "alone", "of", "of_probability", F.col("at.n").alias("paragraph"), _once(words_of(F.col("at.line"))).alias("words"))
    # Lines of an accepted paragraph that are of a family by themselves are in alone.
    found = model.judged(features(found)).filter(F.col("alone") | (F.col("family") == UNKNOWN))
    found = found.select(id_col, "paragraph", "words", F.col("of").alias("family"), F.col("of_probability").alias("probability"))
    found = found.withColumn("pairs", _once(_pairs(F.col("words")))).join(F.broadcast(_template_pairs(spark)), F.col("family") == F.col("t_family"))  # fixed values
    near = _similarity("pairs")
    return found.select(id_col, "paragraph", "family", "probability", near.alias("similarity"), (near >= least_similarity).alias("confirmed"))
