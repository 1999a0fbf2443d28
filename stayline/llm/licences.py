"""Finds licence notices by a trained paragraph classifier, in DataFrame and SQL functions throughout.

Paragraphs are lines. Their words and word pairs that occur in a licence template are the features of a sparse multinomial
logistic regression over the licence families and a class of ordinary prose. It is trained on the templates, whole and cut
at either end, and on ordinary paragraphs from a bounded sample of the corpus. A family is predicted only above a
probability that is calibrated on ordinary paragraphs held back from training; below it a paragraph that looks like a
notice is ``unknown``. A prediction counts as confirmed if the paragraph holds enough of a template of its family.

Only paragraphs with a word or pair that speaks for some family more than for prose, or against prose more than against
some family, can be taken for a notice; the others are passed over by one pattern.
Null and empty texts have no paragraphs. Rows with a null id are scanned like any other. Rows are independent, so ties and
repeated rows get equal results; families of equal probability are settled by name. An empty table gives an empty result,
its classifier being trained on the templates alone. Very long lines are one paragraph. Only named columns are read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.session import cut_lineage

# What notices of each family say.
TEMPLATES = {
    "agpl": ["this program is licensed under the gnu affero general public license version 3"],
    "apache": ["licensed under the apache license version 2.0", "apache license version 2.0 january 2004", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "licensed under the bsd 3 clause license", "released under the bsd license"],
    "cc-by": ["licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license"],
    "cc-by-nc": ["licensed under cc by-nc 4.0", "this work is licensed under a creative commons attribution noncommercial 4.0 international license", "not for commercial use cc by-nc"],
    "cc-by-sa": ["licensed under cc by-sa 4.0", "this work is licensed under a creative commons attribution sharealike 4.0 international license"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related rights cc0 1.0 universal public domain dedication"],
    "gpl": ["this work is licensed under the gnu general public license version 3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "licensed under the gnu gpl version 2 or later"],
    "lgpl": ["licensed under the gnu lesser general public license version 2.1", "this library is free software under the gnu lgpl"],
    "mit": ["released under the mit license", "licensed under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2.0", "licensed under the mozilla public license version 2.0"],
    "proprietary": ["all rights reserved", "all rights reserved no part of this publication may be reproduced without prior written permission", "copyright all rights reserved proprietary and confidential"],
}
PROSE, UNKNOWN = "prose", "unknown"


def words(text: Column) -> Column:
    """Lower-cased words; dots and hyphens stay inside of one."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.-]+|[.-]+(?=\s|$)", " "), " "), lambda w: w != "")


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once although ``use`` names it several times or inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def grams(tokens: Column) -> Column:
    """The distinct words and word pairs."""
    def both(t: Column) -> Column:
        pairs = F.transform(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.get(t, i), w))
        return F.array_distinct(F.concat(t, pairs))

    return _bound(tokens, both)


@dataclass(frozen=True)
class Model:
    """Weights by family and feature, those left out being 0, biases by family, and the calibrated threshold."""

    weights: dict[str, dict[str, float]]
    biases: dict[str, float]
    threshold: float

    @property
    def markers(self) -> tuple[str, ...]:
        """Features with a greater weight in some family than in prose, be it that prose's is negative."""
        prose = self.weights[PROSE]
        families = [own for name, own in self.weights.items() if name != PROSE]
        known = sorted({g for own in self.weights.values() for g in own})
        return tuple(g for g in known if max(own.get(g, 0.0) for own in families) > prose.get(g, 0.0))

    def prose_by_default(self) -> bool:
        odds = sum(math.exp(b - self.biases[PROSE]) for f, b in self.biases.items() if f != PROSE)
        return odds <= 1


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(family, line) for family, lines in TEMPLATES.items() for line in lines]
    given = spark.range(1).select(F.explode(F.expr(f"array({', '.join(f'struct({f!r} as family, {t!r} as line)' for f, t in rows)})")).alias("given"))
    return given.select("given.*").select("family", words(F.col("line")).alias("tokens"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, line (from 0) and paragraph, the lines that hold a word."""
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "paragraph"))
    return rows.where(F.col("paragraph").rlike(r"\p{L}"))


def ordinary(docs: DataFrame, sample_docs: int) -> DataFrame:
    """grams and held_back of the paragraphs, notices left out, of at most ``sample_docs`` documents, those with the
    smallest hash of their id."""
    # Ids only, sample_docs at most: 8 bytes each, so this side may be broadcast.
    chosen = F.broadcast(docs.where("doc_id is not null").select(F.col("doc_id").alias("_of")).orderBy(F.xxhash64("_of"), "_of").limit(sample_docs).distinct())
    lines = paragraphs(docs.join(chosen, F.col("doc_id") == F.col("_of"), "left_semi"))
    lines = lines.select(words(F.col("paragraph")).alias("tokens"), (F.pmod(F.xxhash64("doc_id", "line"), F.lit(3)) == 0).alias("held_back"))
    lines = lines.where(F.size("tokens") > 0).withColumn("grams", grams(F.col("tokens")))
    # A notice in the sample is not ordinary: it holds half of some template's pairs.
    likeness = F.greatest(*[_held(F.col("grams"), _pairs(line)) for texts in TEMPLATES.values() for line in texts], F.lit(0.0))
    return lines.where(likeness < 0.5).select("grams", "held_back")


def fit(docs: DataFrame, sample_docs: int = 2_000, most_alarms: float = 0.001, strength: float = 1e-3) -> Model:
    """Trains on the templates and on ordinary paragraphs of ``sample_docs`` documents. The threshold is the probability
    that all but ``most_alarms`` of the held-back ordinary paragraphs stay below, and one half at least."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel

    spark = docs.sparkSession
    templates = _templates(spark)
    features = [r[0] for r in templates.select(F.explode(grams(F.col("tokens"))).alias("g")).distinct().orderBy("g").collect()]  # of the templates
    size = F.size("tokens")
    cut = lambda start, length: F.slice("tokens", start, length)
    cuts = F.array("tokens", cut(F.lit(2), F.greatest(size - 1, F.lit(1))), cut(F.lit(1), F.greatest(size - 1, F.lit(1))), cut(F.lit(1), F.greatest((size * 3 / 4).cast("int"), F.lit(3))))
    notices = templates.select("family", F.explode(cuts).alias("tokens"))
    prose = cut_lineage(ordinary(docs, sample_docs))  # read in every round of the optimiser
    families = [PROSE, *sorted(TEMPLATES)]
    label = F.array_position(_strings(families), F.col("family")) - 1
    counted = CountVectorizerModel.from_vocabulary(features, "grams", "features", binary=True)
    train = notices.select("family", grams(F.col("tokens")).alias("grams"), F.lit(20.0).alias("weight"))
    train = train.unionAll(prose.where("not held_back").select(F.lit(PROSE).alias("family"), "grams", F.lit(1.0).alias("weight")))
    train = counted.transform(train.withColumn("label", label.cast("double")))
    fitted = LogisticRegression(family="multinomial", weightCol="weight", regParam=strength, elasticNetParam=0.9, standardization=False, maxIter=40).fit(train)
    matrix, biases = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    weights = {f: {g: float(w) for g, w in zip(features, matrix[i]) if w} for i, f in enumerate(families)}
    model = Model(weights, dict(zip(families, map(float, biases))), 0.5)
    scored = with_chances(prose.where("held_back").select("grams"), model)
    level = scored.select(F.array_max(F.slice("chances", 2, len(families))).alias("p")).agg(F.percentile_approx("p", 1 - most_alarms, 10_000)).first()[0]
    return Model(weights, model.biases, max(0.5, level or 0.0))


def _pairs(line: str) -> list[str]:
    own = line.split()
    return [f"{a} {b}" for a, b in zip(own, own[1:])]


def _held(found: Column, pairs: list[str]) -> Column:
    """Share of a template's word pairs that are among ``found``."""
    return F.size(F.array_intersect(found, _strings(list(dict.fromkeys(pairs))))) / float(len(set(pairs)))


def _strings(values: list[str]) -> Column:
    """An array literal; the values are words of templates, without quotes."""
    return F.expr(_list(values))


def _list(values: list[str]) -> str:
    return f"cast(array({', '.join(repr(v) for v in values)}) as array<string>)"


def with_chances(rows: DataFrame, model: Model) -> DataFrame:
    """Adds chances, the probabilities of the classes from the column grams: prose first, then the families by name."""
    known = sorted({g for own in model.weights.values() for g in own})

    def score(name: str) -> str:
        table = ", ".join(f"'{g}', {w!r}D" for g, w in model.weights[name].items())
        return f"aggregate(known, {model.biases[name]!r}D, (total, g) -> total + coalesce(try_element_at(map({table}), g), 0D))" if table else f"{model.biases[name]!r}D"

    scores = F.expr(f"element_at(transform(array(array_intersect(grams, {_list(known)})), known -> array({', '.join(map(score, model.weights))})), 1)")
    odds = lambda own: F.transform(own, lambda s: 1 / F.aggregate(own, F.lit(0.0), lambda total, other: total + F.exp(other - s)))
    return rows.withColumn("chances", _bound(scores, odds))


def scan(docs: DataFrame, model: Model, least_likeness: float = 0.6) -> DataFrame:
    """doc_id, line, family (or unknown), probability, likeness to the nearest template of the family, and confirmed: one
    row for each paragraph that the classifier takes for a notice rather than prose."""
    first_words = sorted({re.escape(m.split()[0]) for m in model.markers})
    # Without a marker no feature lifts a family against prose, so what the biases say holds; they must say prose for this to
    # be exact.
    if first_words and model.prose_by_default():
        spoken = rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{'|'.join(first_words)})(?![\p{{L}}\p{{N}}])"
        lines = paragraphs(docs.where(F.col("text").rlike(spoken))).where(F.col("paragraph").rlike(spoken))
        found = lines.withColumn("grams", grams(words(F.col("paragraph"))))
        found = found.where(F.arrays_overlap("grams", _strings(list(model.markers))))
    else:
        found = paragraphs(docs).withColumn("grams", grams(words(F.col("paragraph"))))
    found = with_chances(found.select("doc_id", "line", "grams"), model)
    families = list(model.weights)
    best = F.array_max(F.slice("chances", 2, len(families)))
    named = F.element_at(_strings(families), F.array_position(F.slice("chances", 2, len(families)), best).cast("int") + 1)
    told = found.withColumn("_best", best).where(F.element_at("chances", 1) < 0.5)
    told = told.withColumn("_family", F.when(F.col("_best") >= model.threshold, named).otherwise(F.lit(UNKNOWN)))
    likeness = F.lit(0.0)
    for family, lines in TEMPLATES.items():
        likeness = F.when(F.col("_family") == family, F.greatest(*[_held(F.col("grams"), _pairs(line)) for line in lines], F.lit(0.0))).otherwise(likeness)
    told = told.withColumn("_likeness", likeness)
    return told.select("doc_id", "line", F.col("_family").alias("family"), F.col("_best").alias("probability"), F.col("_likeness").alias("likeness"), (F.col("_likeness") >= least_likeness).alias("confirmed"))
