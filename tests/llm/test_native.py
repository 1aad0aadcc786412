import hashlib
import re
import textwrap

import duckdb

import pytest

from celltrove.llm import decontaminate, licenses

from .texts import AWKWARD, documents

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items):
    windows = []
    for key, text in items:
        w = words(text)
        n = min(len(w), 10)
        windows += [(key, w[i : i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if w[i : i + len(win)] == win:
                    hit |= {*range(i, i + len(win))}
                    found.add(str(item))
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), ids, bool(hit)))
    return out


@pytest.mark.parametrize("items", [[], [(1, None), (2, "")], [(k, " ".join(f"w{(k * 7 + i) % 23}" for i in range(n))) for k, n in enumerate([1, 2, 3, 4, 5, 7, 9, 10, 11, 25])] + [(30, "É ß"), (31, "eleven twelve one two")]])
def test_decontamination_equals_brute_force(spark, save, items):
    texts = AWKWARD + [" ".join(f"W{(s * i + i // 5) % 23}" for i in range(60)) for s in range(1, 9)] + [items[-1][1] + "! tail" if items and items[-1][1] else "x", "x É, ß y"]
    docs = list(enumerate(texts)) + [(3, "a"), (3, "other text w3 w4"), (None, "w0")]
    sf = save(documents=spark.createDataFrame(docs, "doc_id long, text string"), benchmark=spark.createDataFrame(items, "item_id long, text string"))
    got = [tuple(r) for r in decontaminate.op2_decontaminate(spark, sf).collect()]
    assert sorted(got, key=str) == sorted(brute(docs, items), key=str)


def test_large_benchmark_is_not_broadcast(spark, save, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    text = " ".join(f"q{i}" for i in range(14))
    rows = [(0, text), (1, "nothing")]
    sf = save(documents=documents(spark, [t for _, t in rows]), benchmark=spark.createDataFrame([(5, text)], "item_id long, text string"))
    assert sorted(tuple(r) for r in decontaminate.op2_decontaminate(spark, sf).collect()) == brute(rows, [(5, text)])


def test_clean_keeps_columns_and_other_rows(spark):
    docs = documents(spark, ["a b c d e f g h i j k", None, "fine"]).selectExpr("*", "1 AS spans", "2 AS win")
    kept = decontaminate.clean(docs, spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]


def test_licences(spark, save):
    by = dict(licenses.SENTENCES)
    head = "\n".join([by["apache-head"], by["apache-copy"], by["apache-disclaim"]])
    texts = [*AWKWARD, "Foo.\nReleased under the MIT License.", head, by["reserved"] + " " + by["cc-by-line"], "RELEASED under   the mit license!"]
    rows = licenses.op8_licenses(spark, save(documents=documents(spark, [*texts, texts[-1]])))
    got = {r["doc_id"]: r["licence"] for r in rows.collect()}
    n = len(AWKWARD)
    assert [got[i] for i in range(n)] == ["none"] * n
    assert [got[n + i] for i in range(5)] == ["MIT", "Apache-2.0", "CC-BY-4.0", "MIT", "MIT"]
    assert {r["doc_id"]: r["rules"] for r in rows.collect()}[n + 1].split(",")[0] == "apache-header"


def test_wrapped_licences(spark, save):
    mit = """The MIT License (MIT)

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
    by = dict(licenses.SENTENCES)
    wrap = lambda *keys, start="", end="\n": end.join(textwrap.fill(by[k], 40, initial_indent=start, subsequent_indent=start).replace("\n", end) for k in keys)
    texts = [
        mit, mit.replace("\n", "\r\n"), wrap("apache-head", "apache-copy", "apache-disclaim", start=" * "), wrap("gpl-free", "gpl-hope", "gpl-details", start="# "),
        "Title\n" + wrap("bsd-redist", "bsd-endorse", end="\r\n"), "Licensed under the Apache License, Version 2.0\n" + by["apache-head"].split("2.0 ")[1], "All\n\nrights reserved.", "x\n" * 30000 + "All rights reserved",
    ]
    rows = {r["doc_id"]: r for r in licenses.op8_licenses(spark, save(documents=documents(spark, texts))).collect()}
    assert [rows[i]["rules"].split(",")[0] for i in range(8)] == ["mit-full", "mit-full", "apache-header", "gpl3-header", "bsd-3", "apache-short", "", "proprietary"]
    assert rows[0]["sentence_ids"] == "mit-name,mit-grant,mit-notice" and rows[5]["sentence_ids"] == "apache-head"


def test_odd_spacing_passes_the_anchor_filter(spark, save):
    texts = [f"All{x}rights{x}reserved." for x in ("  ", "\t", "\u00a0", "-", ", ", "\n")]
    rows = licenses.op8_licenses(spark, save(documents=documents(spark, texts))).collect()
    assert [r["licence"] for r in rows] == ["Proprietary"] * len(texts)
    assert not any(" " in a for a in licenses.ANCHORS)


def by_sql(sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet/*.parquet'")
    return sorted(con.execute(licenses.oracle()).fetchall(), key=str)


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """frob is {0}free software: you can redistribute it and/or modify
it under the terms of the GNU {1}General Public License as published by
the Free Software Foundation, either version {2} of the License, or
(at your option) any later version.

frob is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {1}General Public License for more details."""
BSD = """Copyright (c) 2011, Some People, Inc. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
{0}2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{1}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE."""
ENDORSE = """3. Neither the name of Some People, Inc. nor the
   names of its contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""


def test_real_texts_in_comments(spark, save):
    lead = lambda text, first, each, last: "\n".join([first, *(f"{each}{x}".rstrip() for x in text.split("\n")), last])
    styles = [("", "", ""), ("#", "# ", "#"), ("//", "// ", "//"), ("/*", " * ", " */"), ("<!--", "  ", "-->"), (";;", ";; ", ";;"), ("", "-- ", ""), ("REM", "REM ", "REM")]
    wanted, texts = [], []
    for text, licence in (
        (APACHE, "Apache-2.0"), (GPL.format("", "", 3), "GPL-3.0-or-later"), (GPL.format("", "", 2), "GPL-2.0-or-later"), (GPL.format("", "Lesser ", "2.1"), "LGPL-2.1-or-later"), (GPL.format("", "Affero ", "3"), "AGPL-3.0-or-later"),
        (BSD.format("", ""), "BSD-2-Clause"), (BSD.format("", ENDORSE), "BSD-3-Clause"), (ISC, "ISC"), ("SPDX-License-Identifier: MPL-2.0", "MPL-2.0"),
        ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    ):
        for first, each, last in styles:
            for end in ("\n", "\r\n"):
                texts.append(f"x = 1{end}" + lead(text, first, each, last).replace("\n", end) + f"{end}y = 2")
                wanted.append(licence)
    texts += ["This program is free software: anyone may read it.", GPL.format("not ", "", 3).split("\n\n")[0], "You may obtain a copy of the License at home", "Redistribution and use in source and binary forms, with or without modification, are permitted."]
    wanted += ["none"] * 4
    sf = save(documents=documents(spark, texts))
    rows = [tuple(r) for r in licenses.op8_licenses(spark, sf).collect()]
    assert [(texts[i][:60], x) for i, *_, x in sorted(rows)] == [(t[:60], w) for t, w in zip(texts, wanted, strict=True)]
    assert sorted(rows, key=str) == by_sql(sf)


def test_licences_of_awkward_rows(spark, save):
    said = [x for _, x in licenses.SENTENCES]
    texts = [*AWKWARD, *said, "\n".join(said), " ".join(said), "| All rights reserved. |", "a" * 300_000 + ". All rights reserved. " + "b\n" * 100_000]
    rows = [(i, t, 1, "x", None) for i, t in enumerate(texts)] + [(0, said[0], 1, "x", None), (0, said[0], 1, "x", None), (None, said[1], 1, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licence int, rules string, sentences string")
    sf = save(documents=docs)
    found = sorted((tuple(r) for r in licenses.op8_licenses(spark, sf).collect()), key=str)
    assert len(found) == len(rows) and found == by_sql(sf)
    assert all(r[1] == 1 for r in found if r[0] is not None and len(AWKWARD) <= r[0] < len(AWKWARD) + len(said))
    assert licenses.scan(docs).columns == docs.columns
    empty = save(documents=documents(spark, []))
    assert licenses.op8_licenses(spark, empty).count() == 0 and by_sql(empty) == []


def test_native_plans_have_no_python(spark):
    for query in (decontaminate.op2_decontaminate, licenses.op8_licenses):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "Python" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan


def test_wordings_of_references_and_older_headers(spark, save):
    old = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; either version {}, or (at your option) any later version."
    said = [
        (old.format("General Public License", "2"), "GPL-2.0-or-later"), (old.format("Library General Public License", "2 of the License"), "LGPL-2.0-or-later"), (old.format("Lesser General Public License", "2.1"), "LGPL-2.1-or-later"),
        ("This project is licensed under the terms of the MIT license.", "MIT"), ("The source code is released under the MIT licence.", "MIT"), ("Licensed under MIT", "MIT"),
        ("Distributed under the terms of the Apache License 2.0.", "Apache-2.0"), ("This package is licensed under GPLv3+.", "GPL-3.0-or-later"), ("# This file is licensed under the GNU General\n# Public License v2.0.", "GPL-2.0-only"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"), ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
        ("This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at\nhttps://www.eclipse.org/legal/epl-2.0/", "EPL-2.0"),
        ("The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\").", "CDDL-1.0"), ("The Artistic License 2.0", "Artistic-2.0"), ("Licensed under the EUPL, Version 1.2.", "EUPL-1.2"),
        ("Released under the BSD 3-Clause License.", "BSD-3-Clause"), ("Microsoft Public License (Ms-PL)", "MS-PL"), ("PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2", "PSF-2.0"), ("Licensed under the WTFPL.", "WTFPL"), ("Licensed under MPL 2.0.", "MPL-2.0"),
        ("This is not licensed under the MIT license.", "none"), ("He was licensed under the old terms.", "none"), ("MIT gave a license version 2 to the lab.", "none"), ("The film was released under the title MIT.", "none"),
    ]
    sf = save(documents=documents(spark, [t for t, _ in said]))
    rows = [tuple(r) for r in licenses.op8_licenses(spark, sf).collect()]
    assert [(said[i][0], x) for i, *_, x in sorted(rows)] == said
    assert sorted(rows, key=str) == by_sql(sf)
