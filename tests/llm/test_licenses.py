import duckdb

from edge import ROWS, documents
from triad.llm import licenses as R
from triad.llm.queries import ORACLE

MID = "/root/testdata/sf0.01"
MIT = """Copyright (c) someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""


def test_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{MID}/documents.parquet'")
    want = sorted(con.sql(f"SELECT doc_id, match, license, sentences FROM ({ORACLE['op3_license_sentences']})").fetchall())
    got = sorted(tuple(r) for r in R.op3_license_sentences(spark, MID).collect())
    assert got == want and len({g[2] for g in got}) >= 4


def test_full_texts_and_rules():
    k = R.Recognizer()
    assert [x[1:3] for x in k.licenses(MIT)] == [("MIT", "mit-grant,mit-notice,mit-warranty")]
    commented = "\n".join(f" * {x}" for x in MIT.split("\n"))
    assert [x[1] for x in k.licenses(commented)] == ["MIT"]
    assert [x[1] for x in k.licenses(MIT.split("THE SOFTWARE IS")[0])] == ["incomplete", "incomplete"]
    # one more condition makes another licence (and no MIT)
    other = MIT.replace("THE SOFTWARE IS", "The Software shall be used for Good, not Evil.\n\nTHE SOFTWARE IS")
    assert [x[1:3] for x in k.licenses(other)] == [("altered", "mit-grant,mit-notice,other,mit-warranty")]
    assert [x[1] for x in k.licenses("// SPDX-License-Identifier: MIT\ncode\nAll rights reserved.")] == ["MIT", "All-rights-reserved"]
    found = k.licenses("Some prose. Licensed under CC BY-NC 4.0. More\nReleased under the\nMIT License.")
    assert [(x[1]) for x in found] == ["CC-BY-NC-4.0", "MIT"]
    assert k.licenses("It is not Licensed under CC BY-NC 4.0, or so they say.") == []


def test_spans():
    text = "é. Released under the MIT License. End"
    (_, _, _, start, end), = R.Recognizer().licenses(text)
    assert text[start:end].strip() == "Released under the MIT License."


def test_edges(spark):
    assert R.scan(documents(spark)).collect() == [] and R.scan(documents(spark, [])).collect() == []
    rows = [*ROWS, (1, MIT * 30, "en", "s"), (None, MIT, "en", "s"), (None, MIT, "en", "s")]
    assert R.scan(documents(spark, rows)).count() == 32


def test_narrow_lines_and_three_clauses():
    """A sentence over any number of lines; the third clause makes another licence."""
    import textwrap

    known = R.Recognizer()
    by = dict(R.SENTENCES)

    def found(ids, width, mark):
        text = "\n".join(mark + line for i in ids for line in textwrap.wrap(by[i], width))
        return [(n, s) for _, n, s, _, _ in known.licenses(text)]

    mit, bsd = ["mit-grant", "mit-notice", "mit-warranty"], ["bsd-grant", "bsd-source", "bsd-binary"]
    for width in (20, 40, 55, 80):
        assert found(mit, width, "# ") == [("MIT", ",".join(mit))]
        assert found(bsd, width, "") == [("BSD-2-Clause", ",".join(bsd))]


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL ACME INC. OR ITS CONTRIBUTORS BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS
OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN
IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
NAMES = """3. Neither the name of %s nor the names of its
   contributors may be used to endorse or promote products derived from this
   software without specific prior written permission.
"""


def names(text):
    return [x[1] for x in R.Recognizer().licenses(text)]


def test_holders_and_unknown_clauses():
    assert names(BSD % "") == ["BSD-2-Clause"]
    for holder in ("Acme Inc.", "the copyright holder", "The Regents of the University of X, Y. Z., and others", "A"):
        assert names(BSD % (NAMES % holder)) == ["BSD-3-Clause"], holder
    assert names(BSD % (NAMES % " ".join(["word"] * 30))) == ["altered"]
    assert names(BSD % "3. You must send a postcard to the author of this software.\n") == ["altered"]
    assert names("Neither the name of the game nor its rules matter.") == []


def test_common_licences():
    by = {}
    for i, t in R.SENTENCES:
        by.setdefault(i, t.replace("{}", "Some Person, Ltd."))
    for name, ids in R.RULES:
        assert names("Intro words of the file here.\n" + "\n\n".join(by[i] for i in ids)) == [name], ids
    apache = by["apache-grant"] + "\n" + by["apache-copy"] + "\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n" + by["apache-asis"]
    assert names(apache) == ["Apache-2.0"]
    mpl = "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n" \
          " * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"
    assert [x[1:3] for x in R.Recognizer().licenses(mpl)] == [("MPL-2.0", "mpl2-form,mpl2-copy")]
