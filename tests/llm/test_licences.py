from __future__ import annotations

import random

import pytest

from keepwise.llm import licences
from keepwise.llm.common import table

from .conftest import sentence


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    rows, want = [], {}
    names = sorted(licences.NOTICES)
    for i in range(200):
        lines = [sentence(rng, rng.choice(["en", "fr"]), rng.randint(3, 30)) for _ in range(4)]
        if i % 4 == 0:
            family = names[i // 4 % len(names)]
            lines.insert(rng.randrange(5), rng.choice(licences.NOTICES[family]))
            want[i] = family
        if i % 10 == 1:
            lines.append(rng.choice(licences.OTHERS))
        rows.append((i, "\n".join(lines)))
    return spark.createDataFrame(rows, "doc_id long, text string"), want


def test_families_are_found_and_others_left_alone(corpus):
    docs, want = corpus
    rows = licences.scan(docs).collect()
    assert len(rows) == 200
    for r in rows:
        assert r.families == want.get(r.doc_id, ""), (r, want.get(r.doc_id))
        assert r.n_paragraphs == (r.doc_id in want)


def test_unconfirmed_paragraphs_are_unknown(spark, corpus):
    model = licences.fit(corpus[0])
    lines = ["This work is licensed under the GNU General Public License, version 3",
             "LICENSED under### the Apache*** License, Version 2.0!", "Licensed under the CC BY-NC", "A house by the river."]
    df = spark.createDataFrame([(i, x, "extra") for i, x in enumerate(lines)], "n long, line string, label string")
    got = {r.n: r.family for r in licences.classify(df.drop("label"), model).collect()}
    assert got[0] == "GPL-3.0" and got[1] == "Apache-2.0" and got.get(2) in (None, "unknown", "CC-BY-NC-4.0") and 3 not in got


def test_odd_documents(odd_docs, no_docs):
    rows = licences.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.families == "" and r.n_paragraphs == 0 for r in rows)
    assert licences.scan(no_docs).collect() == []


def test_driver_table_lines(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    plain = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in licences.scan(docs).collect():
        assert r.families == ",".join(sorted({f for line, f in plain.items() if line in texts[r.doc_id]}))


def test_no_python_in_the_plan(corpus):
    plan = licences.scan(corpus[0])._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_wrapped_short_and_several_notices(spark, corpus):
    import textwrap

    mit = ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
           'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
           'the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.')
    gpl = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
           "License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version.")
    wrap = lambda t, mark="": "\n".join(mark + x for x in textwrap.wrap(t, 72))
    cases = {wrap(mit): "MIT", "/*\n" + wrap(mit, " * ") + "\n */\nint main;": "MIT", wrap(gpl.format(2), "# "): "GPL-2.0",
             wrap(gpl.format(3), "// "): "GPL-3.0", "# SPDX-License-Identifier: MIT": "MIT",
             "// SPDX-License-Identifier: (GPL-2.0-or-later OR BSD-3-Clause)\nint x;": "BSD,GPL-2.0",
             "MIT License\n\nCopyright (c) 2020": "MIT", "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007": "GPL-3.0",
             "Licensed under the MIT License or the Apache License, Version 2.0.": "Apache-2.0,MIT",
             "Licensed under the Apache License, Version 2.0 or the MIT license.": "Apache-2.0,MIT",
             "The MIT released a license plate.\n\nThe Apache chief.": "",
             wrap(mit) + "\n\n" + wrap(licences.NOTICES["BSD"][0]): "BSD,MIT"}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(docs.unionByName(corpus[0].withColumn("doc_id", corpus[0].doc_id + 1000))).collect()}
    assert {t: got[i].families for i, t in enumerate(cases)} == cases
    assert got[len(cases) - 1].n_paragraphs == 2 and got[8].n_paragraphs == 1


def test_paragraphs_without_anchor_words_are_read(spark):
    notice = ("hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
              "files, to deal in the Software without restriction.")
    rows = [(1, f"A house by the river.\n\n{notice}"), (1, f"A house by the river.\n\n{notice}"), (2, "A house by the river."), (3, None)]
    assert not any(a in notice.lower() for a in licences.ANCHORS)
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.families, r.n_paragraphs) for r in got) == [(1, "MIT", 1), (1, "MIT", 1), (2, "", 0), (3, "", 0)]


def test_equal_paragraphs_stay_rows_of_their_own(spark, corpus):
    model = licences.fit(corpus[0])
    df = spark.createDataFrame([(1, "Released under the MIT License.\nfree")] * 3, "n long, line string")
    assert [r.family for r in licences.classify(df, model).collect()] == ["MIT"] * 3
