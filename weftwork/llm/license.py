"""Licence statements in documents: a trained paragraph classifier, confirmed by comparison with templates.

A sparse multinomial logistic regression on word n-grams (single words and pairs) is trained on windows of licence texts and, for
the class of ordinary text, on other sentences and on whole paragraphs of a bounded sample of different texts of the corpus, cut in
windows. A paragraph is scored if it holds a word of an n-gram that speaks for some licence; without one it is ordinary by
definition. A long paragraph is as its most licence-like window.

The unknown class is calibrated on families held out: the classifier is trained again without a third of the families at a time,
and a second regression learns from its scores and from likeness to the templates of the families left whether a window is
ordinary, a licence of a family it does not know (those held out) or one it knows (windows kept apart). A family is named if that is
likelier than an unknown one and its templates confirm it. Other licences are unknown from the probability on that
all but a hundredth of the ordinary windows with such a word, held out, stay below.

Defined cases: null and blank texts have no paragraph; paragraphs are lines, numbered from 0, blank ones too, where a line of more
than ``WRAPPED`` characters that no full stop, colon, semicolon, question or exclamation mark ends goes on in the next line if that
is not blank; repeated rows give repeated results; an empty table gives an empty result; families with equal scores: the first
in the order of ``TEMPLATES``. Everything is DataFrame functions and the DataFrame form of the learner.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.session import checkpointed

ORDINARY, SENTENCE = "none", "sentence"  # ordinary windows of the corpus, and those of OTHERS
UNKNOWN = "unknown"
ALIKE = 0.5  # of the pairs of words of the shorter side, those that the other side has too
SAMPLE = 500  # different texts whose paragraphs stand for ordinary text, at most
WRAPPED = 50  # characters of a line that may go on in the next
CHUNK = 48  # words of a window of a long paragraph; windows overlap by half
FOLDS = 3  # parts of the families, each held out once
FALSE_UNKNOWN = 0.01  # share of ordinary windows with a cue, held out, that may pass as licences of no known family
FEATURES = 4096
PARTS = 4  # partitions of the training rows, whose number is bounded: the learners pass over them hundreds of times
COMMON = 0.002  # share of ordinary paragraphs that have a common word
WINDOWS = (8, 14, 24)
PENALTY, LASSO_SHARE = 2e-4, 0.5

# The notices by which these licences are named, as their publishers word them.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the"
        " License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by"
        " applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0", "License: Apache-2.0",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction, including without limitation the rights to use,"
        " copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE"
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT", "License: MIT",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
        " version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2 or later.", "SPDX-License-Identifier: GPL-3.0-or-later",
        "License: GPLv3", "GPLv3", "GPLv2", "Licensed under the GPL.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-only",
        "License: LGPLv2",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only", "License: AGPLv3",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license.", "Distributed under the 3-clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause", "License: BSD",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "This work is licensed under the Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike license.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc0": [
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
    ],
    "unlicense": ["This is free and unencumbered software released into the public domain. Released under the Unlicense."],
    "all-rights-reserved": ["All rights reserved.", "Copyright. All rights reserved. No part of this may be reproduced."],
}
# Ordinary sentences with words that licences use.
OTHERS = [
    "You need a valid driver license to rent a car.", "He lost his fishing license and had to pay a fine.",
    "The software was released last year under a new name.", "She asked for permission to leave the room early.",
    "This version of the story is free for all readers.", "The general public was not admitted to the building.",
    "The work is done and the file was closed.", "All seats are reserved for members of the foundation.",
    "The rights of the people were granted by the king.", "A copy of the letter was published in the paper.",
    "The terms of the agreement were discussed in public.", "The source of the river is under the mountain.",
    "Distribute the flour evenly and use without delay.", "Under the bridge, version after version of the tale was told.",
    "The bar was granted a license to sell wine under the rules of the county.", "Her driving license was renewed before the trip.",
    "A license is required by law to keep a dog in this town.", "The council released a new version of the form for a marriage license.",
    "The radio station lost its license under the terms of an order by the court.", "Shops without a license must close by midnight.",
    "The license of the taxi company was suspended until the end of the year.", "Pilots must renew their license every two years.",
    "He was granted permission to use the hall free of charge.", "The ministry granted the mine a license for twenty years.",
    "The bank was licensed by the state under the old law.", "The doctor is licensed to work in two states.",
    "The new law is distributed to all members, with or without notes.", "Copies of the plan are free and can be had at the office.",
    "The hotel is provided with water under the terms of the contract.", "The public domain of the city holds parks and rivers.",
    "Tables are reserved under your name until eight.", "The general told the public that the war was over.",
    "The foundation published a free guide to software for schools.", "The work of the commons is never done.",
    "The first version of the bridge was built without a license and fell.", "Any person may copy the recipe and share it.",
    "A hunting license costs forty dollars and is valid for one season.", "The inn had no license to serve beer in the garden.",
    "The agreement was signed under the terms that the council had set.", "Rooms are granted to students under the terms of the school.",
    "The liquor license of the restaurant was granted by the board in March.", "You must show your license before the race.",
    "The film was released under another title in France.", "The album was released in a second version two years later.",
    "Food was distributed to the people free of charge.", "The notes were distributed to the class before the test.",
    "She holds a license as a nurse and a license as a teacher.", "The free program of the theatre is open to the public.",
    "This program shows how a farmer works the land without a tractor.", "The members of the foundation published their report in June.",
    "The library is free to use for all persons who live in the city.", "The terms of the loan limit what the bank may charge.",
    "Warranty repairs are done by the shop where the bicycle was bought.", "The warranty on the washing machine ends after two years.",
    "All rights of way across the field are shown on the map.", "The copyright case was heard by the court for six days.",
    "The author gave a copy of the book to the mayor.", "Use the form on the next page and send it to the office.",
    "The conditions on the mountain were bad and the path was closed.", "The following conditions apply to all guests of the pool.",
    "He works for the general and lives in a public house.", "The source of the noise was a file that fell from the desk.",
    "The permission of the owner is needed to cross the land.", "International trains stop at the common border.",
    "The license plate of the car was found under the seat.", "A new form of the virus was found in version five of the test.",
    "Changes to the documents are sent to all persons in the group.", "The merchant was granted the right to sell salt by the crown.",
]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), "")


def _grams(words: Column) -> Column:
    pairs = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1)))
    return F.array_distinct(F.concat(words, pairs))


def _paragraphs(text: Column) -> Column:
    """Lines of the text, wrapped ones joined."""
    tidy = F.regexp_replace(text, "(?<![ \\t\\r\\f])[ \\t\\r\\f]++(?=\n)", "")
    return F.split(F.regexp_replace(tidy, f"\n(?<=[^\n]{{{WRAPPED}}}[^\n.!?:;]\n)(?=[ \\t]*+[^\\s])", " "), "\n")


def _chunks(words: Column) -> Column:
    """Windows of ``CHUNK`` words that overlap by half and cover all words."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - CHUNK // 2), F.lit(CHUNK // 2))
    return F.transform(starts, lambda at: F.slice(words, at, CHUNK))


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    return spark.createDataFrame(rows, "family string, text string").withColumn("words", _words(F.col("text")))


def _windows(rows: DataFrame) -> DataFrame:
    """Whole texts and their windows of words."""
    whole = rows.select("family", "words")
    parts = [
        rows.where(F.size("words") > width).select(
            "family", F.explode(F.sequence(F.lit(1), F.size("words") - width + 1, F.lit(max(1, width // 3)))).alias("at"), "words"
        ).select("family", F.slice("words", F.col("at"), F.lit(width)).alias("words"))
        for width in WINDOWS
    ]
    for part in parts:
        whole = whole.unionByName(part)
    return whole


@dataclass(frozen=True)
class Model:
    families: list[str]
    bias: list[float]  # of each family against ordinary text
    weights: list[tuple]  # (n-gram, weight of each family against ordinary text)
    cues: list[str]
    calibration: list[list[float]]  # bias and weights of EVIDENCE for ordinary, unknown and known
    cut: float = 0.5  # probability from which a licence is unknown


EVIDENCE = ["licence", "margin", "alike", "nearest"]


def _pairs(words: Column) -> Column:
    """Different pairs of words that follow each other; a single word is a pair by itself."""
    return F.array_distinct(F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), lambda x, i: F.concat_ws(" ", x, F.get(words, i + 1))))


def _template_pairs(text: str) -> list[str]:
    """``_pairs`` of a template, as a constant."""
    words = re.findall(r"[^\W_]+", text.lower())
    return list(dict.fromkeys(" ".join(p) for p in zip(words, words[1:]))) or words


def _all_pairs(families: list[str]) -> list[str]:
    return sorted({pair for family in families for text in TEMPLATES[family] for pair in _template_pairs(text)})


def _likeness(pairs: Column, families: list[str]) -> Column:
    """(family, likeness) for each template of the families: the share of the shorter side's pairs that the longer has too."""
    templates = F.array(*[
        F.struct(F.lit(family).alias("family"), F.lit(_template_pairs(text)).alias("pairs")) for family in families for text in TEMPLATES[family]
    ])
    return F.transform(templates, lambda t: F.struct(
        t["family"].alias("family"),
        (F.size(F.array_intersect(pairs, t["pairs"])) / F.greatest(F.lit(1), F.least(F.size(pairs), F.size(t["pairs"])))).alias("likeness"),
    ))


def _evidence(rows: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """``keys`` of the rows with the best family and ``EVIDENCE``. Rows have ``words`` and ``grams``.

    ``licence``: log-odds of some licence against ordinary text; ``margin``: log-odds of the best family against the
    others; ``alike`` and ``nearest``: likeness to the templates of that family and of any.
    """
    names = F.array(*[F.lit(f) for f in model.families])
    best = F.array_max("logits")

    def log_sum(of: Column) -> Column:
        return best + F.log(F.aggregate(of, F.lit(1e-9), lambda a, x: a + F.exp(x - best)))

    place = F.array_position("logits", best).cast("int")
    others = F.concat(F.slice("logits", F.lit(1), place - 1), F.slice("logits", place + 1, F.lit(len(model.families))))
    scored = _logits(rows.withColumn("pairs", _pairs(F.col("words"))), model, [*keys, "pairs"]).select(
        *keys, F.get(names, place - 1).alias("family"), "pairs",
        log_sum(F.col("logits")).alias("licence"), (best - log_sum(others)).alias("margin"),
    )
    near = scored.withColumn("near", _likeness(F.col("pairs"), model.families))
    own = F.array_max(F.transform(F.filter("near", lambda t: t["family"] == F.col("family")), lambda t: t["likeness"]))
    return near.select(
        *keys, "family", *[F.least(F.greatest(F.col(c), F.lit(-25.0)), F.lit(25.0)).alias(c) for c in EVIDENCE[:2]],
        own.alias("alike"), F.array_max(F.transform("near", lambda t: t["likeness"])).alias("nearest"),
    )


def _ordinary(documents: DataFrame, sample: int) -> DataFrame:
    """Windows of all paragraphs of the ``sample`` different texts of smallest hash, without those worded like a template.

    The hashes are at most ``sample`` rows, which bounds the broadcast; copies are taken once.
    """
    hashed = documents.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("hash"), "text")
    chosen = hashed.select("hash").distinct().orderBy("hash").limit(sample)
    texts = hashed.join(F.broadcast(chosen), "hash").groupBy("hash").agg(F.min("text").alias("text"))
    words = texts.select(F.explode(_paragraphs(F.col("text"))).alias("text")).select(_words(F.col("text")).alias("words"))
    windows = words.where(F.size("words") > 0).select(F.explode(_chunks(F.col("words"))).alias("words")).distinct()
    known = F.lit(_all_pairs(list(TEMPLATES)))
    pairs = _pairs(F.col("words"))
    plain = F.size(F.array_intersect(pairs, known)) < ALIKE * F.size(pairs)
    return windows.where(plain).select(F.lit(ORDINARY).alias("family"), "words")


def _classifier(rows: DataFrame, families: list[str], vocabulary: list[str], steps: int) -> Model:
    """The regression on rows (family, features) of ``families`` and of ordinary text, not yet calibrated.

    Rows of other families are left out.
    """
    of_family = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family"))
    used = rows.where(F.col("family").isin(ORDINARY, SENTENCE, *families)).withColumn("label", of_family.cast("double"))
    licences, ordinary = (used.where(w).count() for w in (F.col("label") > 0, F.col("family") == ORDINARY))
    share = min(1.0, 4 * licences / max(1, ordinary))
    learner = LogisticRegression(
        family="multinomial", regParam=PENALTY, elasticNetParam=LASSO_SHARE, maxIter=steps, weightCol="weight", standardization=False,
    )
    # Windows of the corpus together weigh four times as much as those of licences at most.
    model = learner.fit(used.withColumn("weight", F.when(F.col("family") == ORDINARY, share).otherwise(1.0)))
    matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    against = matrix[1:] - matrix[:1]
    weights = [(gram, *[float(x) for x in against[:, i]]) for i, gram in enumerate(vocabulary) if abs(against[:, i]).max() > 1e-9]
    return Model(families, [float(x) for x in bias[1:] - bias[0]], weights, [], [])


def _calibrate(rows: DataFrame, vocabulary: list[str], cues: list[str]) -> tuple[list[list[float]], float]:
    """Bias and weights of ``EVIDENCE`` for ordinary, unknown and known, from models that lack a part of the families.

    With them the probability that all but ``FALSE_UNKNOWN`` of the ordinary windows have of being unknown at most.

    Each window is judged by a model that has not seen it. Ordinary windows without a cue are never judged, nor are they here.
    """
    seen = None
    for fold in range(FOLDS):
        families = [f for i, f in enumerate(TEMPLATES) if i % FOLDS != fold]
        apart = F.pmod(F.xxhash64("grams"), F.lit(FOLDS)) == fold
        model = _classifier(rows.where(~apart), families, vocabulary, 30)
        ordinary, known = F.col("family").isin(ORDINARY, SENTENCE), F.col("family").isin(families)
        part = rows.where((apart | ~(ordinary | known)) & (~ordinary | F.arrays_overlap("words", F.lit(cues))))
        part = part.withColumn("label", F.when(ordinary, 0.0).when(known, 2.0).otherwise(1.0)).select("label", "words", "grams")
        part = _evidence(part, model, ["label"])
        seen = part if seen is None else seen.unionByName(part)
    seen = checkpointed(seen.repartition(PARTS))
    counts = {r["label"]: r["count"] for r in seen.groupBy("label").count().collect()}
    even = (counts.get(1.0, 0) + counts.get(2.0, 0)) / max(1, counts.get(0.0, 0))
    balance = F.when(F.col("label") == 0, even)
    learner = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=100, weightCol="weight")
    table = VectorAssembler(inputCols=EVIDENCE, outputCol="features").transform(seen.withColumn("weight", balance.otherwise(1.0)))
    model = learner.fit(table)
    weights = [[float(b), *map(float, w)] for b, w in zip(model.interceptVector.toArray(), model.coefficientMatrix.toArray())]
    unknown = F.get(vector_to_array("probability"), F.lit(1))
    cut = model.transform(table).where(F.col("label") == 0).agg(F.percentile(unknown, F.lit(1 - FALSE_UNKNOWN)).alias("cut")).first()["cut"]
    return weights, max(0.5, cut or 0.0)


def fit(documents: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on the templates, on ``OTHERS`` and on paragraphs of the ``sample`` different texts with the smallest hash."""
    spark = documents.sparkSession
    templates = _templates(spark)
    plain = checkpointed(_ordinary(documents, sample))
    # Words that many ordinary windows have; an n-gram of such words alone is no feature.
    seen = plain.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    common = [r["word"] for r in seen.where(F.col("n") >= max(2, COMMON * plain.count())).select("word").collect()]
    others = spark.createDataFrame([(t,) for t in OTHERS], "text string").select(
        F.lit(SENTENCE).alias("family"), _words(F.col("text")).alias("words")
    )
    rows = checkpointed(
        _windows(templates.select("family", "words")).unionByName(others).unionByName(plain)
        .distinct().withColumn("grams", _grams(F.col("words"))).repartition(PARTS)
    )
    told = F.filter("grams", lambda g: ~F.forall(F.split(g, " "), lambda w: w.isin(common))) if common else F.col("grams")
    vectoriser = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=FEATURES, binary=True)
    vectoriser = vectoriser.fit(rows.where(~F.col("family").isin(ORDINARY, SENTENCE)).withColumn("grams", told))
    rows = vectoriser.transform(rows).cache()
    model = _classifier(rows, list(TEMPLATES), vectoriser.vocabulary, 60)
    cues = sorted({max((w for w in g.split(" ") if w not in common), key=len) for g, *w in model.weights if max(w) > 0})
    calibration, cut = _calibrate(rows, vectoriser.vocabulary, cues)
    rows.unpersist()
    return replace(model, cues=cues, calibration=calibration, cut=cut)


def _weighed(grams: str, model: Model) -> Column:
    """The n-grams that have a weight, in order."""
    known = [gram for gram, *_ in model.weights]
    return F.sort_array(F.filter(grams, lambda g: g.isin(known)))


def _logits(rows: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """``keys`` of the rows with the logits of their ``grams``: one for each family, against ordinary text.

    Only n-grams with a weight are looked up, and each different set of them once. The weights are at most ``FEATURES``
    rows, which bounds the broadcast.
    """
    columns = [f"w{i}" for i in range(len(model.families))]
    table = rows.sparkSession.createDataFrame(
        model.weights or [("", *[0.0] * len(columns))], "gram string, " + ", ".join(f"{c} double" for c in columns)
    )
    rows = rows.withColumn("weighed", _weighed("grams", model)).withColumn("id", F.xxhash64("weighed"))
    sums = (
        rows.select("id", "weighed").distinct().select("id", F.explode("weighed").alias("gram"))
        .join(F.broadcast(table), "gram").groupBy("id").agg(*[F.sum(c).alias(c) for c in columns])
    )
    logits = F.array(*[F.coalesce(F.col(c), F.lit(0.0)) + b for c, b in zip(columns, model.bias)])
    return rows.join(sums, "id", "left").select(*keys, logits.alias("logits"))


def _cue_pattern(cues: list[str]) -> str:
    """The cues as whole words, by first letter, so that a word meets the cues of its letter only."""
    letters: dict[str, list[str]] = {}
    for cue in cues:
        letters.setdefault(cue[0], []).append(cue[1:])
    return "(?<![\\p{L}\\p{N}])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in letters.items()) + ")(?![\\p{L}\\p{N}])"


def _windows_of(stated: DataFrame) -> DataFrame:
    """Rows (key, words, grams): the windows of each different paragraph of rows (key, content).

    They hold the key alone of their paragraph, or the rows of a long one would grow with the square of its length.
    """
    distinct = stated.select("key", "content").dropDuplicates(["key"]).select("key", _words(F.col("content")).alias("words"))
    return distinct.select("key", F.explode(_chunks(F.col("words"))).alias("words")).withColumn("grams", _grams(F.col("words")))


def scan(documents: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, paragraph, family, probability, similarity) of the paragraphs that state a licence.

    ``similarity`` is that of the classifier's family or, for ``unknown``, of the nearest template of any.
    """
    if not model.cues:
        return documents.limit(0).select(
            "doc_id", F.lit(0).alias("paragraph"), F.lit("").alias("family"), F.lit(0.0).alias("probability"), F.lit(0.0).alias("similarity"))
    cue = _cue_pattern(model.cues)
    stated = checkpointed(
        documents.where(F.lower("text").rlike(cue))
        .select("doc_id", F.posexplode(_paragraphs(F.col("text"))).alias("paragraph", "content"))
        .where(F.lower("content").rlike(cue)).withColumn("key", F.sha2("content", 256))
    )
    found = _evidence(_windows_of(stated), model, ["key"])
    of_class = [row[0] + sum((F.col(c) * w for c, w in zip(EVIDENCE, row[1:])), F.lit(0.0)) for row in model.calibration]
    scored = found.withColumn("scores", F.array(*of_class)).withColumn("top", F.array_max("scores"))
    shares = F.transform("scores", lambda x: F.exp(x - F.col("top")))
    shares = scored.withColumn("raised", shares).withColumn("total", F.aggregate("raised", F.lit(0.0), lambda a, x: a + x))
    ordinary, unknown, known = (F.get("raised", F.lit(i)) / F.col("total") for i in range(3))
    named = (known >= unknown) & (F.col("alike") >= ALIKE)
    judged = shares.select(
        "key", F.struct(
            (F.when(named, known > ordinary).otherwise(unknown + known >= model.cut)).alias("stated"), named.alias("named"), (1 - ordinary).alias("licence"), F.when(named, F.col("family")).otherwise(UNKNOWN).alias("family"),
            F.when(named, known / (1 + F.exp(-F.col("margin")))).otherwise(unknown + known).alias("probability"),
            F.when(named, F.col("alike")).otherwise(F.col("nearest")).alias("similarity"),
        ).alias("best"),
    )
    # A paragraph is as its named window, the most certain one, or as its most licence-like one.
    best = judged.groupBy("key").agg(F.max("best").alias("best")).where("best.stated")
    return stated.join(best, "key").select("doc_id", "paragraph", "best.family", "best.probability", "best.similarity")
