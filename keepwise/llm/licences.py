"""Licence scans with a trained paragraph classifier.

Paragraphs (lines up to one without letter or digit, so notices may be wrapped
and stand in comments) and their lines are read as word 1- to 3-grams. A multinomial logistic
regression over the sparse n-grams of the reference notices tells the licence
families and ordinary text apart. It is trained here, on the notices below with
each word left out in turn, sentences that speak of licences without naming
one, and a bounded sample of the corpus' own lines. Probabilities are calibrated
on rows left out of the fit: a family is accepted from the probability that
all but ``MISTAKES`` of the left-out rows of no family stay under. Every family
is confirmed of which a notice has at least ``MIN_OVERLAP`` of its word 3-grams
in the paragraph, and half of those that no better matching notice has; also one
that an SPDX line or a title line names. A paragraph that the regression accepts,
whole or by one of its lines, without a confirmed family is of the class ``unknown``.

All work is DataFrame and SQL functions and Spark ML in the JVM.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

# Public licence notices by family.
NOTICES = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.",
                 "Released under the GNU AGPL v3.0.",
                 "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                 "published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License "
                   "is distributed on an AS IS basis, without warranties or conditions of any kind."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met.",
            "Released under the BSD 3-Clause License.", "Licensed under the BSD License."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.",
                  "Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                     "Licensed under CC BY-NC 4.0."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                     "Licensed under CC BY-SA 4.0."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.",
                "Released under CC0 1.0 Universal public domain dedication."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "Released under the GNU GPL v2.0.",
                "You can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation, either version 2 of the License, or any later version."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "Released under the GNU GPL v3.0.",
                "You can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation, either version 3 of the License, or any later version."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted.", "Released under the ISC License."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.",
                 "Released under the GNU LGPL v3.0.",
                 "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                 "published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: SPDX identifiers that are not the family's name.
SPDX = {"BSD": ["bsd-2-clause", "bsd-3-clause"],
        **{f: [f"{f.lower()}-only", f"{f.lower()}-or-later"] for f in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0")}}
#: Titles that make up a line, "|" being the line's ends, by family.
TITLES = {
    "AGPL-3.0": r"\|gnu affero general public license[ |](version 3\b|v3)", "Apache-2.0": r"\|apache license[ |]version 2\.0\b",
    "BSD": r"\|(the )?bsd( [23]-clause)? license\|", "CC0-1.0": r"\|cc0 1\.0 universal\|",
    "CC-BY-4.0": r"\|(creative commons )?attribution 4\.0 international\|",
    "CC-BY-NC-4.0": r"\|(creative commons )?attribution-noncommercial 4\.0 international\|",
    "CC-BY-SA-4.0": r"\|(creative commons )?attribution-sharealike 4\.0 international\|",
    "GPL-2.0": r"\|gnu general public license[ |](version 2\b|v2)", "GPL-3.0": r"\|gnu general public license[ |](version 3\b|v3)",
    "ISC": r"\|(the )?isc license( isc)?\|", "LGPL-3.0": r"\|gnu lesser general public license[ |](version 3\b|v3)",
    "MIT": r"\|(the )?mit license( mit)?\|", "MPL-2.0": r"\|mozilla public license[ |](version |v\. ?)?2\.0\b",
    "Unlicense": r"\|the unlicense\|",
}
# Sentences that share words with notices but name no family.
OTHERS = [
    "The driver's license was renewed by the office.", "A license is required to sell food here.",
    "All rights reserved.", "Copyright 2020 by the author.", "He was licensed as a doctor under state law.",
    "Students of the MIT released a paper under pressure.", "The Apache helicopter was released from service.",
    "Permission was granted to use the hall.", "The software is provided by a third party.",
    "This work was published under the terms of the agreement.", "Version 3 of the report was released to the public.",
    "The conditions of the license agreement apply to any person.", "Redistribution of wealth is subject to debate.",
    "The film is in the public domain.", "Licensed under a commercial license.",
    "Released under a proprietary license.", "This document is licensed under its own terms.",
]
#: Corpus lines with any of these are not taken for lines of no family in training.
ANCHORS = ("licen", "gnu", "permission", "redistribut", "public domain", "waived", "cc0", "cc by", "redistribution",
           "warrant", "mozilla", "unencumbered", "attribution", "universal")
NONE, UNKNOWN = "none", "unknown"
#: Corpus lines in training at most, the share of no-family rows that may pass, the overlap that confirms.
SAMPLE_LINES = 2000
MISTAKES = 0.01
MIN_OVERLAP = 0.6
#: Parts that the rows of one text fall into when results come back to them.
COPY_PARTS = 32
FAMILIES = [NONE, *sorted(NOTICES)]


#: Lines without letter or digit (blank, or comment marks alone) part paragraphs.
BORDER = r"\r?\n(?:[^\p{L}\p{N}\r\n]*+\r?\n)++"
_WORD = "[a-z0-9]++(?:[.-][a-z0-9]++)*+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def grams(words: Column, n: int) -> Column:
    """Word n-grams, repeats included."""
    many = F.greatest(F.size(words) - (n - 1), F.lit(0))
    out = F.slice(words, F.lit(1), many)
    for k in range(1, n):
        out = F.zip_with(out, F.slice(words, F.lit(k + 1), many), lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def features(words: Column) -> Column:
    """Word 1- to 3-grams without those that hold a null."""
    return F.array_compact(F.concat(*[grams(words, n) for n in (1, 2, 3)]))


def known_words(text: Column) -> Column:
    """The words in order; null for one that no sentence above holds, so neither does any n-gram with it."""
    known = sorted({w for ts in (*NOTICES.values(), OTHERS) for t in ts for w in re.findall(_WORD, t.lower())})
    return F.transform(tokens(text), lambda w: F.when(w.isin(known), w))


def _with_words(paragraphs: DataFrame) -> DataFrame:
    """``paragraphs`` with the known words of every line and of the whole."""
    return paragraphs.withColumn("lines", F.transform(F.split("line", "\n"), known_words)).withColumn("words", F.flatten("lines"))


def gated(text: Column) -> Column:
    low = F.lower(text)
    found = F.lit(False)
    for a in ANCHORS:
        found = found | F.contains(low, F.lit(a))
    return found


def _listed(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """(family, words) of the sentences."""
    structs = [F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f, t in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("r")).select("r.family", tokens(F.col("r.text")).alias("words"))


@dataclass
class LicenceModel:
    vectorizer: CountVectorizerModel
    regression: LogisticRegressionModel
    threshold: float


def fit(docs: DataFrame, sample_lines: int = SAMPLE_LINES) -> LicenceModel:
    """Train and calibrate; only the bounded sample of lines comes from ``docs``."""
    spark = docs.sparkSession
    notices = _listed(spark, [(f, t) for f, ts in NOTICES.items() for t in ts])
    others = _listed(spark, [(NONE, t) for t in OTHERS])
    texts = docs.where("text is not null").select("text", F.xxhash64("text").alias("h"))
    share = max(1, texts.count() // (sample_lines // 4))
    lines = (texts.where(F.pmod("h", F.lit(share)) == 0).select(F.explode(F.split("text", "\n")).alias("line"))
             .where(~gated(F.col("line"))).distinct().orderBy(F.xxhash64("line"), "line").limit(sample_lines)
             .select(F.lit(NONE).alias("family"), tokens(F.col("line")).alias("words")))
    # every word left out in turn, and the sentence whole
    left_out = F.transform(F.sequence(F.lit(0), F.size("words")), lambda i: F.struct(
        i.alias("at"), F.concat(F.slice("words", F.lit(1), i), F.slice("words", i + 2, F.size("words"))).alias("words")))
    whole = F.array(F.struct(F.lit(-1).alias("at"), F.col("words")))
    varied = notices.unionByName(others).select("family", F.explode(F.concat(whole, left_out)).alias("v")).select(
        "family", "v.at", "v.words")
    rows = varied.unionByName(lines.withColumn("at", F.lit(0))).withColumn("grams", features(F.col("words")))
    vocabulary = sorted(r["g"] for r in notices.unionByName(others).select(F.explode(features(F.col("words"))).alias("g"))
                        .distinct().collect())  # as large as the notices above
    vectorizer = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", minTF=1.0).setBinary(True)
    label = F.element_at(F.create_map(*[F.lit(x) for i, f in enumerate(FAMILIES) for x in (f, float(i))]), F.col("family"))
    # sentences count the same however many words they can lose
    weight = F.when(F.col("at") < 0, 5.0).otherwise(1.0)
    data = materialise(vectorizer.transform(rows.withColumn("label", label).withColumn("weight", weight)).select(
        "features", "label", "weight", "at", F.xxhash64("words").alias("h")), "licence-training")
    aside = (F.col("at") >= 0) & (F.pmod("h", F.lit(5)) == 0)
    regression = LogisticRegression(family="multinomial", weightCol="weight", maxIter=60, regParam=0.001,
                                    standardization=False).fit(data.where(~aside))
    held = regression.transform(data.where(aside & (F.col("label") == 0)))
    best = F.array_max(F.slice(vector_to_array("probability"), 2, len(FAMILIES) - 1))
    edge = held.select(F.percentile(best, F.lit(1 - MISTAKES)).alias("p")).first()["p"]
    return LicenceModel(vectorizer, regression, max(0.5, edge or 0.0))


def _three(words: list[str]) -> list[str]:
    return list(dict.fromkeys(" ".join(words[i : i + 3]) for i in range(len(words) - 2)))


def _notice_grams() -> list[str]:
    """Every word 3-gram of a notice."""
    return sorted({g for texts in NOTICES.values() for t in texts for g in _three(re.findall(_WORD, t.lower()))})


def _notices() -> Column:
    """All notices (family, text, grams): a fixed list, carried as a literal."""
    made = []
    for family, texts in sorted(NOTICES.items()):
        for words in (re.findall(_WORD, t.lower()) for t in texts):
            three = _three(words)
            made.append(F.struct(F.lit(family).alias("family"), F.lit(f" {' '.join(words)} ").alias("text"),
                                 F.array(*map(F.lit, three)).alias("grams")))
    return F.array(*made)


def _short_forms(text: Column) -> Column:
    """Families that SPDX lines or title lines of a paragraph name."""
    ids = {x: f for f in NOTICES for x in (f.lower(), *SPDX.get(f, []))}
    known = F.create_map(*[F.lit(x) for pair in sorted(ids.items()) for x in pair])
    named = F.regexp_extract_all(F.lower(text), F.lit(r"spdx-license-identifier[ \t]*+:([^\r\n]++)"), F.lit(1))
    spdx = F.transform(tokens(F.array_join(named, " ")), lambda w: F.element_at(known, w))
    lines = F.concat(F.lit("|"), F.array_join(F.transform(F.split(text, "\n"), lambda x: F.array_join(tokens(x), " ")), "|"), F.lit("|"))
    titles = F.array(*[F.when(lines.rlike(r), F.lit(f)) for f, r in sorted(TITLES.items())])
    # every title and identifier line holds one of these
    may = F.lit(False)
    for part in ("license", "cc0", "attribution"):
        may = may | F.contains(F.lower(text), F.lit(part))
    return F.when(may, F.array_compact(F.concat(spdx, titles))).otherwise(F.array().cast("array<string>"))


def confirmed(paragraphs: DataFrame) -> DataFrame:
    """The rows (with a column ``line``) with families (all confirmed ones) and
    overlap (of the best matching notice)."""
    return _confirmed(_with_words(paragraphs), paragraphs.columns)


def _confirmed(paragraphs: DataFrame, names: list[str]) -> DataFrame:
    rows = paragraphs.withColumn("notices", _notices())
    rows = rows.withColumn("mine", F.filter(grams(F.col("words"), 3), lambda g: g.isin(_notice_grams()))).withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " ", "?"), F.lit(" ")))
    share = F.transform("notices", lambda n: F.struct(
        F.contains(F.col("joined"), n["text"]).alias("whole"),
        (F.size(F.array_intersect(n["grams"], F.col("mine"))) / F.size(n["grams"])).alias("overlap"),
        F.size(n["grams"]).alias("size"), n["family"].alias("family"), n["grams"].alias("grams")))
    # null where no notice has a 3-gram of the paragraph
    rows = rows.withColumn("share", F.when(F.size("mine") > 0, F.sort_array(F.filter(share, lambda h: h["overlap"] > 0), asc=False)))

    def step(acc, h):
        own = F.array_except(h["grams"], acc["used"])
        held = (F.size(own) > 0) & (F.size(F.array_intersect(own, F.col("mine"))) * 2 >= F.size(own))
        return F.when(held, F.struct(F.concat(acc["families"], F.array(h["family"])).alias("families"),
                                     F.array_union(acc["used"], h["grams"]).alias("used"))).otherwise(acc)

    none = F.array().cast("array<string>")
    found = F.aggregate(F.filter("share", lambda h: h["overlap"] >= MIN_OVERLAP),
                        F.struct(none.alias("families"), none.alias("used")), step, lambda acc: acc["families"])
    return rows.select(*names, F.array_sort(F.array_distinct(F.concat(F.coalesce(found, none), _short_forms(F.col("line"))))).alias("families"),
                       F.coalesce(F.array_max(F.transform("share", lambda h: h["overlap"])), F.lit(0.0)).alias("overlap"))


def classify(paragraphs: DataFrame, model: LicenceModel, keep: list[str] | None = None) -> DataFrame:
    """The rows (with a column ``line``, a paragraph) that read as a licence, one
    for each confirmed family or one ``unknown``, with family, probability (the
    highest of the paragraph and its lines) and overlap. ``keep`` names the
    columns to return (default: all); those left out are not exchanged."""
    names = keep or paragraphs.columns
    words = _with_words(paragraphs.withColumn("line", F.coalesce("line", F.lit(""))))
    rows = _confirmed(words, [*dict.fromkeys([*names, "lines", "words"])])
    each = F.when(F.size("lines") > 1, F.concat(F.array("words"), F.col("lines"))).otherwise(F.array("words"))
    units = rows.select(*names, "families", "overlap", F.posexplode(each).alias("place", "unit"))
    scored = model.regression.transform(model.vectorizer.transform(units.withColumn("grams", features(F.col("unit")))))
    best = F.array_max(F.slice(vector_to_array("probability"), 2, len(FAMILIES) - 1))
    # equal rows are counted by their whole paragraph
    rows = scored.groupBy(*names, "families", "overlap").agg(
        F.max(best).alias("probability"), F.count_if(F.col("place") == 0).alias("copies"))
    rows = rows.where((F.size("families") > 0) | (F.col("probability") >= model.threshold))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.select(*names, F.explode(F.when(F.size("families") > 0, F.col("families")).otherwise(
        F.array(F.lit(UNKNOWN)))).alias("family"), "probability", "overlap")


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, families (distinct confirmed ones, ascending,
    comma-joined; empty if none), n_paragraphs (with a confirmed family), n_unknown.

    Null and empty texts have none; repeated rows stay repeated. Every paragraph
    and line of every text is read by the classifier. An empty table gives none."""
    texts = docs.select("doc_id", "text", F.sha2("text", 256).alias("digest"))
    model = fit(docs)
    lines = texts.where("digest is not null").select("digest", F.posexplode(F.split("text", BORDER)).alias("at", "line"))
    known = F.col("family") != UNKNOWN
    # repeated texts are one group
    found = classify(lines, model, ["digest", "at"]).groupBy("digest").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(known, F.col("family")))), ",").alias("families"),
        F.count_distinct(F.when(known, F.col("at"))).alias("n_paragraphs"),
        F.count_distinct(F.when(~known, F.col("at"))).alias("n_unknown"))
    # copies of a text are spread over the tasks by their id
    found = found.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(COPY_PARTS - 1))))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(COPY_PARTS)).cast("int")
    zero = F.lit(0).cast("long")
    with_text = texts.where("digest is not null").select("doc_id", "digest", part.alias("part")).join(found, ["digest", "part"], "left").select(
        "doc_id", F.coalesce("families", F.lit("")).alias("families"), F.coalesce("n_paragraphs", zero).alias("n_paragraphs"),
        F.coalesce("n_unknown", zero).alias("n_unknown"))
    return with_text.unionByName(texts.where("digest is null").select(
        "doc_id", F.lit("").alias("families"), zero.alias("n_paragraphs"), zero.alias("n_unknown")))
