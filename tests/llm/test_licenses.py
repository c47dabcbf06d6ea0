import re

import pytest
from pyspark.sql import types as T

from cutpoint.llm import licenses

SCHEMA = T.StructType([T.StructField(n, T.LongType() if n == "doc_id" else T.StringType()) for n in ("doc_id", "text", "families", "all")])


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "f", None) for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def model(spark):
    return licenses.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def brute_margin(model, line):
    w = re.findall("[a-z0-9]+", line.lower())
    s = list(model.intercepts)
    for g in {*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))}:
        s = [a + b for a, b in zip(s, model.weights.get(g, [0] * len(s)))]
    best = max(s[1:])
    return s.index(best), best - s[0]


def test_findings_equal_brute_force(spark, model):
    lines = [t for texts in licenses.TEMPLATES.values() for t in texts] + licenses.OTHER
    lines += ["", " ", "the MIT of heit mit der License", "license license license", "under the terms of the public version 2.0", "word " * 5000]
    rows = licenses.scan(frame(spark, lines), model).collect()
    slope, shift = model.calibration
    for r in rows:
        k, margin = brute_margin(model, lines[r.doc_id])
        named = margin * slope + shift >= 0
        assert r.n_named == named, lines[r.doc_id]
    # The triggers pass over nothing: without them the findings are the same.
    every = model._replace(triggers=["[a-z0-9]+"])
    again = licenses.scan(frame(spark, lines), every).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_families_and_odd_texts(spark, model):
    texts = [None, "", "\n\n \n", "Some prose.\nReleased under the MIT License.\nMore prose.\nAll rights reserved.",
             "Licensed under the Apache License, Version 2.0." * 1, "Er fuhr mit dem Zug.", "x" * 100_000 + "\nLicensed under CC BY-NC 4.0.",
             "Some prose.\nReleased under the MIT License.\nMore prose.\nAll rights reserved."]
    rows = {r.doc_id: r for r in licenses.scan(frame(spark, texts), model).collect()}
    assert [rows[i].families for i in range(8)] == ["", "", "", "mit,reserved", "apache-2.0", "", "cc-by-nc", "mit,reserved"]
    assert rows[3].found == "1:mit,3:reserved" and rows[3].n_paragraphs == 4 and rows[0].n_paragraphs == 0
    assert rows[5].probability == 0 and 0.5 <= rows[3].probability <= 1
    assert licenses.scan(frame(spark, []), model).count() == 0
    plan = licenses.scan(frame(spark, texts), model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_all_statements_of_the_corpus_are_found(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = licenses.scan(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect()
    stated = [bool(re.search("licen[sc]e|rights reserved", r.text, re.I)) for r in rows]
    assert sum(stated) > 20 and stated == [r.families != "" for r in rows]


def test_training_on_an_empty_table(spark):
    assert licenses.fit(frame(spark, [])).weights


WRAPPED = {
    "gpl": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining
a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction,""",
    "apache-2.0": """Licensed under the Apache License,
Version 2.0 (the "License"); you may not use
this file except in compliance
with the License.""",
}


def test_wrapped_notices_are_found_once(spark, model):
    texts, want = [], []
    for family, notice in WRAPPED.items():
        lines = notice.split("\n")
        plain, words = "A first line of prose about the sea.", notice.split()
        narrow = [" ".join(words[k:k + 3]) for k in range(0, len(words), 3)]
        for form in (lines, [" * " + x for x in lines], ["# " + x for x in lines], [x + "\r" for x in lines], narrow):
            texts += ["\n".join(form), "\n".join([plain, "", *form, "", plain]), "\n".join([plain, *form, plain])]
            want += [family] * 3
        # A blank line, also one of a comment, parts the notice.
        texts += ["\n\n".join(narrow), "\n *\n".join(" * " + x for x in narrow)]
        want += [""] * 2
    rows = {r.doc_id: r for r in licenses.scan(frame(spark, texts), model).collect()}
    for i, family in enumerate(want):
        assert (rows[i].families, rows[i].n_confirmed) == (family, int(family != "")), texts[i]
    twice = WRAPPED["bsd"] + "\n\n" + WRAPPED["gpl"] + "\n" + WRAPPED["bsd"]
    [r] = licenses.scan(frame(spark, [twice]), model).collect()
    assert r.found == "0:bsd,4:gpl,8:bsd"
    every = model._replace(triggers=["[a-z0-9]+"])
    assert sorted(map(tuple, rows.values())) == sorted(map(tuple, licenses.scan(frame(spark, texts), every).collect()))


def test_neighbours_of_a_family_are_told_apart(spark, model):
    assert all(licenses._own(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts)
    cc = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    gnu = "This work is licensed under the GNU {}General Public License, version 3."
    lines = {cc.format("-ShareAlike"): "cc-by-sa", cc.format("-NoDerivatives"): "cc-by-nd", cc.format("-NonCommercial-ShareAlike"): "cc-by-nc-sa",
             cc.format(""): "cc-by", cc.format("-NonCommercial"): "cc-by-nc", gnu.format("Affero "): "agpl", gnu.format("Lesser "): "lgpl", gnu.format(""): "gpl",
             "SPDX-License-Identifier: ISC": "isc", "SPDX-License-Identifier: MIT": "mit", "Released under the ISC License.": "isc",
             # Of no listed family: nothing is confirmed.
             "SPDX-License-Identifier: EUPL-1.2": "", "SPDX-License-Identifier: Zlib": "", cc.format("-Sampling"): "", gnu.format("Quux "): ""}
    rows = {r.doc_id: r.families for r in licenses.scan(frame(spark, list(lines)), model).collect()}
    assert [rows[i] for i in range(len(lines))] == list(lines.values())


def test_words_between_underscores_are_words(spark, model):
    texts = ["released_under_the_MIT_License_", "_SPDX_License_Identifier_Apache_2_0_", "mit_license_", "x_copyright_the_authors_all_rights_reserved_x"]
    rows = licenses.scan(frame(spark, texts), model).collect()
    every = model._replace(triggers=["[a-z0-9]+"])
    assert sorted(map(tuple, rows)) == sorted(map(tuple, licenses.scan(frame(spark, texts), every).collect()))
    assert {r.doc_id: r.families for r in rows}[0] == "mit"


def test_sampled_lines_are_whole_or_spread(spark):
    long = " ".join(f"w{i}" for i in range(4000))
    longer = " ".join(f"w{i}" for i in range(40_000))
    got = {r.line for r in licenses.sample_lines(frame(spark, [long, longer])).collect()}
    assert long in got and len(got) == 2
    [some] = got - {long}
    assert some.startswith("w0 w1 ") and some.endswith(" w39998 w39999") and len(some) == licenses.LINE_CHARS + licenses.PIECES - 1


def test_any_of_shares_beginnings():
    words = ["mit", "mi", "apache", "apart", "a", "0", "gpl", "gpl3"]
    pattern = re.compile(f"[^a-z0-9](?:{licenses.any_of(words)})(?![a-z0-9])")
    for w in [*words, "m", "mitt", "ap", "apar", "gp", "gpl33", "00", "xmit"]:
        for text in (w, f"x {w}", f"x_{w}, y", f"{w} {w}"):
            assert bool(pattern.search(" " + text)) == (w in words), text
    assert licenses.any_of(["[a-z0-9]+"]) == "[a-z0-9]+"


def test_only_runs_with_an_own_pair_are_joined(spark, model):
    """Lines of plain words make no runs; a notice over lines makes those around its own pairs."""
    def units(text):
        df = frame(spark, [text])
        return [tuple(r) for r in df.selectExpr(f"inline({licenses._units('split(text, chr(10))')})").collect()]

    plain = "one word\n" * 40 + "and more"
    assert [(a, b) for _, a, b in units(plain)] == [(i, i) for i in range(41)]
    runs = [u for u in units("one word\nunder the mit\nlicense here\nend") if u[2] > u[1]]
    assert sorted(u[1:] for u in runs) == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3)]
    assert ("under the mit license here", 1, 2) in runs
