"""Operator 7: licence scans with a trained paragraph classifier, in SQL functions and MLlib only.

Lines, and runs of neighbouring lines, are described by the set of their words and word pairs
(marks of comments are no words). A multinomial
logistic regression with an L1 part, so that few n-grams carry weight, tells licence families
from ``unknown``. It is trained on the family templates and altered forms of them, against a
bounded sample of the corpus's own lines (``SAMPLE_DOCS``, ``SAMPLE_LINES``; whole up to
``LINE_CHARS`` characters, of longer ones ``PIECES`` pieces spread over the line, as many
characters in all), word-shuffled templates and fixed other sentences. The sampled lines have no
labels: those that hold half of a template's words are left out, the rest is taken as unknown. A second logistic regression on held-out paragraphs
turns the margin over ``unknown`` into a calibrated probability; below ``MIN_KNOWN`` a paragraph
is unknown. A prediction counts once a template of that family confirms it: at least
``MIN_TEMPLATE`` of the template's word pairs stand in the paragraph, among them one that no
other family's template has. Licences that only share words with a family stay unconfirmed.

Scoring reads every line of every text, and for notices wrapped over lines every run of
neighbouring lines with words, at any width: from a run's first line its last ``RUN_WORDS`` words
count, from its last line the first as many, and the lines between hold fewer than that in all,
which is about twice the longest template. A run counts if it is confirmed, no line or shorter
run inside it is confirmed for its family, and no counted run of that family overlaps it. Lines
and runs without any of the trigger words are
passed over, which loses nothing: the triggers are chosen so that all other n-grams together
cannot lift a family over ``unknown``. No rows are exploded, joined or shuffled.

Defined results: null and empty texts have no paragraph with words and no finding; an empty
table gives an empty table (trained on templates alone); a text without line ends is one
paragraph, of any length; repeated rows are treated alike; a null ``doc_id`` stays null; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cutpoint.llm.common import text_or_empty

# Families and sentences by which works name their licence.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0"],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT"],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later"],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "bsd": [
        "Released under the 3-clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause"],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC"],
    "epl-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "SPDX-License-Identifier: EPL-2.0"],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense"],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0"],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0."],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0."],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0."],
    "cc-by-nd": [
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-ND 4.0."],
    "cc-by-nc-sa": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0."],
    "cc-by-nc-nd": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-NC-ND 4.0."],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released into the public domain under CC0 1.0."],
    "reserved": [
        "All rights reserved.",
        "Copyright the authors. All rights reserved."],
}
# Sentences that share words with licences and are none.
OTHER = [
    "The driver showed his license to the officer at the border.",
    "The museum is open to the general public and free of charge.",
    "The library was published as free software by a small foundation.",
    "They reserved all seats and had every right to complain.",
    "She works at MIT and studied the Apache language.",
    "A version of the file is part of the project and its source code.",
    "Conditions are met when the following forms are used.",
    "Er kam mit dem Zug und mit der Lizenz.",
    "La versión general del software libre es de la fundación.",
    "Tous droits de passage sont dus à la version publique.",
]
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *TEMPLATES]

SAMPLE_DOCS = 400
SAMPLE_LINES = 2000
LINE_CHARS = 32_000
PIECES = 16
MIN_KNOWN = 0.5
MIN_TEMPLATE = 0.6
#: Words of a notice that runs over lines; the longest template has about half as many.
RUN_WORDS = 64
L1 = 0.001

GRAMS = ("array_distinct(concat(w, transform(sequence(1, greatest(size(w), 1)), "
         "i -> if(i < size(w), concat(w[i - 1], ' ', w[i]), w[i - 1]))))")


def words(line: str) -> str:
    """Lower-case words of a line (SQL)."""
    return f"regexp_extract_all(lower({line}), '[a-z0-9]+', 0)"


def grams(line: str) -> str:
    """The set of a line's words and word pairs (SQL)."""
    return f"transform(array({words(line)}), w -> if(size(w) = 0, w, {GRAMS}))[0]"


class Model(NamedTuple):
    """``weights``: the n-grams that carry weight, one value per family; ``calibration``:
    slope and intercept of the margin's log-odds; ``triggers``: words of which one must stand
    in a paragraph that is not unknown."""
    weights: dict[str, list[float]]
    intercepts: list[float]
    calibration: tuple[float, float]
    triggers: list[str]


def _rows(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*(
        F.struct(F.lit(f).alias("family"), F.lit(t).alias("line")) for f, t in rows))))


def sample_lines(docs: DataFrame) -> DataFrame:
    """A bounded sample of the corpus's paragraphs, spread by hash, without those that hold a
    template's words: ``line``."""
    some = (docs.where("text IS NOT NULL").select("doc_id", "text")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))
    lines = some.select(F.posexplode(F.split("text", "\n")).alias("at", "line")).where("line rlike '[a-zA-Z]'")
    own = " OR ".join(f"size(array_intersect({words('line')}, {_array(_words(t))})) >= {math.ceil(len(_words(t)) / 2)}"
                      for texts in TEMPLATES.values() for t in texts)
    return (lines.where(f"NOT ({own})").orderBy(F.xxhash64("line", "at"), "line").limit(SAMPLE_LINES)
            .select(F.expr(_spread("line")).alias("line")))


def _spread(line: str) -> str:
    """A line, or of one longer than LINE_CHARS evenly spread pieces of that many characters in all (SQL)."""
    size = LINE_CHARS // PIECES
    pieces = (f"transform(sequence(0, {PIECES - 1}), k -> "
              f"substring({line}, int(k * (bigint(length({line})) - {size}) div {PIECES - 1}) + 1, {size}))")
    return f"if(length({line}) <= {LINE_CHARS}, {line}, array_join({pieces}, ' '))"


def _words(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall("[a-z0-9]+", text.lower())))


def _array(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def training(docs: DataFrame) -> DataFrame:
    """``family, line, part`` (0 to 3): templates and altered forms, other sentences, and
    sampled paragraphs; a quarter (part 0) is held out for calibration."""
    spark = docs.sparkSession
    known = _rows(spark, [(f, t) for f, texts in TEMPLATES.items() for t in texts])
    near = ["the and of", "for more details see", "in this document", "copyright 2020 the team"]
    forms = [F.col("line"), *(F.concat(F.lit(a + " "), F.col("line")) for a in near),
             *(F.concat(F.col("line"), F.lit(" " + a)) for a in near),
             *(F.concat(F.lit(a + " "), F.col("line"), F.lit(" " + b)) for a, b in zip(near, reversed(near), strict=True)),
             *(F.expr(f"array_join(transform(filter(transform(split(line, ' '), (x, i) -> struct(x, i)), z -> z.i % 7 <> {k}), z -> z.x), ' ')")
               for k in range(7))]
    altered = known.select("family", F.posexplode(F.array(*forms)).alias("form", "line"))
    mixed = known.select(F.posexplode(F.array(*(
        F.expr(f"array_join(transform(sort_array(transform(split(line, ' '), x -> struct(xxhash64(x, {k}) as h, x))), z -> z.x), ' ')")
        for k in range(4)))).alias("form", "line"))
    plain = _rows(spark, [(UNKNOWN, t) for t in OTHER]).withColumn("form", F.lit(0))
    sampled = sample_lines(docs).select(F.lit(UNKNOWN).alias("family"), F.lit(0).alias("form"), "line")
    rows = altered.unionByName(mixed.withColumn("family", F.lit(UNKNOWN))).unionByName(plain).unionByName(sampled)
    return rows.withColumn("part", F.pmod(F.xxhash64("line", "form"), F.lit(4)))


def fit(docs: DataFrame) -> Model:
    """Train and calibrate on templates and the corpus's sample."""
    number = F.array_position(F.array(*(F.lit(f) for f in FAMILIES)), F.col("family")) - 1
    rows = (training(docs).withColumn("grams", F.expr(grams("line"))).where("size(grams) > 0")
            .withColumn("label", number.cast("double")).coalesce(2).cache())
    counted = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=3, vocabSize=4096).fit(rows)
    seen = counted.transform(rows)
    share = rows.agg(F.avg((F.col("label") == 0).cast("double"))).first()[0]
    seen = seen.withColumn("weight", F.when(F.col("label") == 0, F.lit(0.5 / share)).otherwise(F.lit(0.5 / (1 - share))))
    net = LogisticRegression(family="multinomial", regParam=L1, elasticNetParam=0.8, maxIter=60, standardization=False,
                             weightCol="weight").fit(seen.where("part <> 0"))
    table, intercepts = net.coefficientMatrix.toArray(), net.interceptVector.toArray()
    weights = {g: [round(float(x), 6) for x in table[:, k]] for k, g in enumerate(counted.vocabulary) if abs(table[:, k]).max() > 1e-6}
    intercepts = [round(float(x), 6) for x in intercepts]
    bare = Model(weights, intercepts, (1.0, 0.0), [])
    margins = (rows.where("part = 0").select(F.expr(_verdict(bare, "line")).alias("v"), (F.col("label") > 0).cast("double").alias("label"))
               .select("label", F.array("v.margin").alias("m")))
    margins = margins.select("label", F.expr("m[0]").alias("margin"))
    from pyspark.ml.feature import VectorAssembler
    ready = VectorAssembler(inputCols=["margin"], outputCol="features").transform(margins)
    line = LogisticRegression(regParam=0.001, maxIter=50, standardization=False).fit(ready)
    slope, shift = max(float(line.coefficients[0]), 1e-3), float(line.intercept)
    common = (rows.where("label = 0").select(F.explode("grams").alias("g")).where(F.col("g").isin(sorted({x for g in weights for x in g.split()})))
              .groupBy("g").count().collect()) if weights else []
    rows.unpersist()
    return Model(weights, intercepts, (slope, shift),
                 triggers(weights, intercepts, (slope, shift), {r.g: r["count"] for r in common}))


def triggers(weights: dict[str, list[float]], intercepts: list[float], calibration: tuple[float, float],
             common: dict[str, int]) -> list[str]:
    """Words, the rarest among unknown paragraphs (``common``) first and then by falling weight,
    such that n-grams without any of them, all taken together, leave every family's margin
    below the calibrated bar."""
    bar = (math.log(MIN_KNOWN / (1 - MIN_KNOWN)) - calibration[1]) / calibration[0]
    gain = {g: [max(0.0, w[f] - w[0]) for f in range(1, len(FAMILIES))] for g, w in weights.items()}
    by_word: dict[str, float] = {}
    for g, w in gain.items():
        for x in g.split():
            by_word[x] = max(by_word.get(x, 0.0), max(w) / len(g.split()))
    chosen: list[str] = []
    left = {g: w for g, w in gain.items() if max(w) > 0}
    for x in sorted(by_word, key=lambda x: (common.get(x, 0) // 8, -by_word[x], x)):
        most = [intercepts[f] - intercepts[0] + sum(w[f - 1] for w in left.values()) for f in range(1, len(FAMILIES))]
        if max(most) < bar:
            break
        chosen.append(x)
        left = {g: w for g, w in left.items() if x not in g.split()}
    return chosen


def _numbers(values: list[float]) -> str:
    return "array(" + ", ".join(f"{v!r}D" for v in values) + ")"


def _verdict(model: Model, line: str) -> str:
    """The scores of a line (SQL): a struct of ``family`` number, ``margin`` over unknown."""
    names = list(model.weights)
    table = f"map_from_arrays({_array(names)}, array({', '.join(_numbers(model.weights[g]) for g in names)}))" if names else None
    start = _numbers(model.intercepts)
    scores = start if not names else (
        f"aggregate(array_intersect({grams(line)}, {_array(names)}), {start}, "
        f"(s, g) -> zip_with(s, element_at({table}, g), (a, b) -> a + b))")
    best = "array_max(slice(s, 2, size(s)))"
    return f"transform(array({scores}), s -> named_struct('family', array_position(s, {best}) - 1, 'margin', {best} - s[0]))[0]"


def _pairs(text: str) -> list[str]:
    w = re.findall("[a-z0-9]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:], strict=False)))


def _own(family: str, text: str) -> list[str]:
    """A template's word pairs that no other family's template has."""
    others = {p for f, texts in TEMPLATES.items() if f != family for t in texts for p in _pairs(t)}
    return [p for p in _pairs(text) if p not in others]


def _templates(family: str) -> str:
    """Word-pair sets ``pairs`` and ``own`` of a family's templates, by the family's number (SQL)."""
    def sets(f: str, text: str) -> str:
        return f"named_struct('pairs', {_array(_pairs(text))}, 'own', {_array(_own(f, text))})"
    cases = " ".join(f"when {k} then array({', '.join(sets(f, t) for t in texts)})"
                     for k, (f, texts) in enumerate(TEMPLATES.items(), 1))
    return f"case {family} {cases} end"


def _units(text: str) -> str:
    """All lines of a text and all runs of two or more neighbouring lines with words that hold a word
    pair of a template's own, without which a run is never confirmed and so never counts (SQL):
    ``t`` (text), ``line`` and ``last`` (from 0)."""
    own = _array(sorted({p for f, texts in TEMPLATES.items() for t in texts for p in _own(f, t)}))
    # Whether an own pair starts in the line; its second word may be the next line's first.
    starts = (f"transform(w, (x, i) -> if(size(x) = 0, false, coalesce(arrays_overlap(transform(sequence(1, size(x)), "
              f"j -> concat(x[j - 1], ' ', if(j < size(x), x[j], get(get(w, i + 1), 0)))), {own}), false)))")
    ends = (f"aggregate(if(i + 1 < size(w) and size(w[i]) > 0 and exists(slice(o, i + 1, {RUN_WORDS + 1}), z -> z), "
            f"sequence(i + 1, least(i + {RUN_WORDS}, size(w) - 1)), cast(array() as array<int>)), "
            "named_struct('open', true, 'n', 0, 'ends', cast(array() as array<int>)), "
            "(s, k) -> if(not s.open or size(w[k]) = 0, named_struct('open', false, 'n', s.n, 'ends', s.ends), "
            f"named_struct('open', s.n + size(w[k]) < {RUN_WORDS}, 'n', s.n + size(w[k]), 'ends', concat(s.ends, array(k)))), s -> s.ends)")
    held = f"filter({ends}, k -> exists(slice(o, i + 1, k - i + 1), z -> z))"
    first = f"slice(w[i], greatest(size(w[i]) - {RUN_WORDS - 1}, 1), {RUN_WORDS})"
    run = f"concat({first}, flatten(slice(w, i + 2, k - i - 1)), slice(w[k], 1, {RUN_WORDS}))"
    none = "cast(array() as array<struct<t: string, line: int, last: int>>)"
    runs = (f"transform(array(transform({text}, t -> {words('t')})), w -> transform(array({starts}), o -> "
            f"if(not exists(o, z -> z), {none}, flatten(transform(sequence(0, size(w) - 1), "
            f"i -> transform({held}, k -> named_struct('t', array_join({run}, ' '), 'line', i, 'last', k))))))[0])[0]")
    return f"concat(transform({text}, (t, i) -> named_struct('t', t, 'line', i, 'last', i)), {runs})"


def any_of(words: list[str]) -> str:
    """A pattern for any of the words, with the beginnings that they share written once; what is no
    plain word stands as it is."""
    def shared(ends: list[str]) -> str:
        heads = {e[0]: [] for e in ends if e}
        for e in ends:
            if e:
                heads[e[0]].append(e[1:])
        parts = [h + shared(rest) for h, rest in heads.items()]
        if len(parts) == 1 and "" not in ends:
            return parts[0]
        return "(?:" + "|".join(parts) + ")" + ("?" if "" in ends else "") if parts else ""

    plain = sorted({w for w in words if re.fullmatch("[a-z0-9]+", w)})
    return "|".join([*([shared(plain)] if plain else []), *[w for w in words if w not in plain]])


def findings(model: Model, text: str = "text") -> Column:
    """An array over the lines that the classifier names and the runs of lines that count: ``line``
    and ``last`` (from 0), ``family``, ``probability``, ``template`` (share of the best template
    found with a pair of its own), ``confirmed``."""
    # As words are runs of a-z and 0-9, an underscore ends them too. Tried on the text after a blank:
    # asking what stands before each place (a look behind) costs more than the words themselves.
    trigger = f"[^a-z0-9](?:{any_of(model.triggers)})(?![a-z0-9])" if model.triggers else "(?!)"
    slope, shift = model.calibration
    names = _array(FAMILIES)
    share = (f"transform(array({grams('x.t')}), g -> array_max(transform({_templates('x.v.family')}, "
             "t -> if(arrays_overlap(t.own, g), size(array_intersect(t.pairs, g)) / size(t.pairs), 0D))))[0]")
    kind = "array<struct<line: int, last: int, family: string, probability: double, template: double, confirmed: boolean>>"
    none = f"cast(array() as {kind})"
    named = f"""
      transform(filter(transform(filter({_units(f"split({text}, '\\n')")},
          x -> concat(' ', lower(x.t)) rlike '{trigger}'),
        x -> named_struct('t', x.t, 'line', x.line, 'last', x.last, 'v', {_verdict(model, 'x.t')})),
        x -> x.v.margin * {slope!r}D + {shift!r}D >= {math.log(MIN_KNOWN / (1 - MIN_KNOWN))!r}D),
        x -> transform(array({share}), c -> named_struct('line', x.line, 'last', x.last, 'family', {names}[int(x.v.family)],
          'probability', 1 / (1 + exp(-(x.v.margin * {slope!r}D + {shift!r}D))), 'template', c, 'confirmed', c >= {MIN_TEMPLATE}))[0])"""
    # By last line and then from the shortest: for each family the latest start of what is
    # confirmed so far, and the last line of the latest run that counts.
    order = ("(a, b) -> case when a.last <> b.last then a.last - b.last else b.line - a.line end")
    zero = f"array_repeat(-1, {len(FAMILIES)})"
    at = f"array_position({names}, x.family) - 1"
    counts = f"x.last > x.line and x.line > s.start[int({at})] and x.line > s.kept[int({at})]"
    runs = (f"aggregate(array_sort(filter(a, x -> x.confirmed), {order}), named_struct('start', {zero}, 'kept', {zero}, 'runs', {none}), "
            f"(s, x) -> named_struct('start', transform(s.start, (v, f) -> if(f = {at}, greatest(v, x.line), v)), "
            f"'kept', if({counts}, transform(s.kept, (v, f) -> if(f = {at}, x.last, v)), s.kept), "
            f"'runs', if({counts}, concat(s.runs, array(x)), s.runs)), s -> s.runs)")
    return F.expr(f"""
      if(not concat(' ', lower({text})) rlike '{trigger}', {none},
        transform(array(cast({named} as {kind})), a -> if(size(a) = 0, a,
          array_sort(concat(filter(a, x -> x.line = x.last), {runs}))))[0])""")


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row per input row: ``doc_id, n_paragraphs`` (lines with a word), ``n_named`` (lines
    named by the classifier and runs that count), ``n_confirmed`` (by a template too), ``families``
    (confirmed, sorted, comma-joined), ``found`` (``line:family`` of the confirmed ones, a run by its first line), ``probability`` (the highest, 0 without any)."""
    rows = docs.select("doc_id", text_or_empty().alias("text")).select("doc_id", "text", findings(model).alias("all"))
    sure = F.filter("all", lambda x: x["confirmed"])
    return rows.select(
        "doc_id", F.expr("size(filter(split(text, '\\n'), x -> x rlike '[^ \\\\t\\\\r\\\\x0b\\\\f]'))").cast("long").alias("n_paragraphs"),
        F.size("all").cast("long").alias("n_named"), F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.transform(sure, lambda x: F.concat_ws(":", x["line"], x["family"])), ",").alias("found"),
        F.coalesce(F.array_max(F.transform(sure, lambda x: x["probability"])), F.lit(0.0)).alias("probability"))
