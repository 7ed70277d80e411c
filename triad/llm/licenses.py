"""Licence recognition by sentences and ordered rules.

A text is cut into pieces at line ends and sentence ends, and a piece's words
(runs of a-z and 0-9 in lower case) are its normal form.  One piece, or
consecutive ones joined (lines of one sentence, and across a full stop where the known
sentence has one), that equals a known sentence becomes that sentence's
identifier.  A known sentence may have one gap, written ``{}``, for a holder's
or product's name of up to GAP words.  Any other sentence of CLAUSE words and more (not
counting addresses) between two identifiers is the identifier ``other``.

The document's identifier sequence is then read from the left: the longest rule that
matches there names the licence.  A rule interrupted by ``other`` is ``altered``: a
text with an unknown clause is no shorter licence.  An identifier that begins no
rule is reported as ``incomplete``.

Defined results: null and empty texts and those without a known sentence have no
rows; repeated rows give their rows again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from triad.llm.common import columns, slices

# Known sentences.  One identifier may have several wordings.
SENTENCES = [
    ("mit-short", "Released under the MIT License."),
    ("mit-short", "Licensed under the MIT License."),
    ("mit-short", "This project is licensed under the MIT License."),
    ("mit-short", "SPDX-License-Identifier: MIT"),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                  "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
                  "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
                  "subject to the following conditions:"),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial "
                   "portions of the Software."),
    ("mit-warranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
                     "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("apache-short", "Licensed under the Apache License, Version 2.0."),
    ("apache-short", "Licensed under the Apache License, Version 2.0"),
    ("apache-short", "SPDX-License-Identifier: Apache-2.0"),
    ("apache-grant", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                     "compliance with the License."),
    ("apache-copy", "You may obtain a copy of the License at"),
    ("apache-asis", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                    "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl3-short", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl3-short", "Licensed under the GNU General Public License, version 3."),
    ("gpl3-short", "SPDX-License-Identifier: GPL-3.0-only"),
    ("gpl2-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                   "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                   "option) any later version."),
    ("gpl3-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                   "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                   "option) any later version."),
    ("gpl-hope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                 "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("cc-by-nc-4", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-4", "Licensed under CC BY 4.0."),
    ("cc-by-4", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4", "Licensed under CC BY-SA 4.0."),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                  "the following conditions are met:"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                   "following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                   "following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-names", "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from "
                  "this software without specific prior written permission."),
    ("bsd-names", "Neither the name of {} nor the names of other contributors may be used to endorse or promote products derived from "
                  "this software without specific prior written permission."),
    ("bsd-names", "The name of {} may not be used to endorse or promote products derived from this software without specific prior "
                  "written permission."),
    ("bsd-advert", "All advertising materials mentioning features or use of this software must display the following acknowledgement:"),
    ("bsd-warranty", "THIS SOFTWARE IS PROVIDED BY {} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
                     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("bsd-liability", "IN NO EVENT SHALL {} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
                      "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
                      "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
                      "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
                      "DAMAGE."),
    ("mit-liability", "IN NO EVENT SHALL {} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
                      "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                  "provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc-grant", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
                  "provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc-warranty", "THE SOFTWARE IS PROVIDED \"AS IS\" AND {} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
                     "WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("isc-liability", "IN NO EVENT SHALL {} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
                      "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
                      "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("mpl2-form", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl2-form", "SPDX-License-Identifier: MPL-2.0"),
    ("mpl2-copy", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("mpl2-copy", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("lgpl21-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                     "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
                     "version."),
    ("lgpl3-later", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
                    "version."),
    ("agpl3-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
                    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
                    "version."),
    ("gpl-hope", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                 "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    *[("gpl-see", f"See the GNU {k}General Public License for more details.") for k in ("", "Lesser ", "Affero ")],
    *[("gpl-copy", f"You should have received a copy of the GNU {k}General Public License along with this {w}.")
      for k in ("", "Lesser ", "Affero ") for w in ("program", "library")],
    ("gpl2-title", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("gpl3-title", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("lgpl3-title", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("agpl3-title", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("apache-text", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, "
                    "non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly "
                    "display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("zlib-warranty", "This software is provided 'as-is', without any express or implied warranty."),
    ("zlib-liability", "In no event will the authors be held liable for any damages arising from the use of this software."),
    ("zlib-grant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
                   "and redistribute it freely, subject to the following restrictions:"),
    ("cc0", "To the extent possible under law, {} has waived all copyright and related or neighboring rights to this work."),
    ("reserved", "All rights reserved."),
]
# Licence rules as ordered sentence identifiers.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("MIT", ["mit-short"]),
    ("Apache-2.0", ["apache-grant", "apache-copy", "apache-asis"]),
    ("Apache-2.0", ["apache-grant"]),
    ("Apache-2.0", ["apache-short"]),
    ("Apache-2.0", ["apache-text"]),
    ("GPL-3.0-only", ["gpl3-short"]),
    *[(name, [first, *rest]) for name, first in (
        ("GPL-2.0-or-later", "gpl2-later"), ("GPL-3.0-or-later", "gpl3-later"), ("LGPL-2.1-or-later", "lgpl21-later"),
        ("LGPL-3.0-or-later", "lgpl3-later"), ("AGPL-3.0-or-later", "agpl3-later"))
      for rest in (["gpl-hope", "gpl-see", "gpl-copy"], ["gpl-hope", "gpl-see"], ["gpl-hope"], [])],
    ("GPL-2.0-only", ["gpl2-title"]),
    ("GPL-3.0-only", ["gpl3-title"]),
    ("LGPL-3.0-only", ["lgpl3-title"]),
    ("AGPL-3.0-only", ["agpl3-title"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC0-1.0", ["cc0"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-names", "bsd-warranty", "bsd-liability"]),
    *[(name, ["bsd-grant", "bsd-source", "bsd-binary", *more, *last]) for name, more in (("BSD-3-Clause", ["bsd-names"]), ("BSD-2-Clause", []))
      for last in (["bsd-warranty", "bsd-liability"], ["bsd-warranty"], [])],
    ("ISC", ["isc-grant", "isc-warranty", "isc-liability"]),
    ("ISC", ["isc-grant"]),
    ("MPL-2.0", ["mpl2-form", "mpl2-copy"]),
    ("MPL-2.0", ["mpl2-form"]),
    ("Unlicense", ["unlicense"]),
    ("Zlib", ["zlib-warranty", "zlib-liability", "zlib-grant"]),
    ("All-rights-reserved", ["reserved"]),
]
GAP = 20                         # words of a name in a gap
CLAUSE = 4                       # words of a sentence that counts as a clause
OTHER = "?"

END = re.compile(r"[.!?:]+(?=[ \t-\r]|\Z)|\n")
WORD = re.compile(r"[a-z0-9]+")
ADDRESS = re.compile(r"[^\x20\x09-\x0D]+://[^\x20\x09-\x0D]+")


def normal(text: str) -> str:
    return " ".join(WORD.findall(text.lower()))


def interrupted(ids: list[str]) -> list[list[str]]:
    """The sequence with OTHER in every choice of places between its identifiers."""
    out = [ids[:1]]
    for i in ids[1:]:
        out = [x + between + [i] for x in out for between in ([], [OTHER])]
    return [x for x in out if OTHER in x]


class Recognizer:
    """Known sentences by their normal form, and rules as one pattern."""

    def __init__(self, sentences=SENTENCES, rules=RULES):
        self.names = list(dict.fromkeys(i for i, _ in sentences))
        code = {n: chr(0x100 + k) for k, n in enumerate(self.names)} | {OTHER: OTHER}
        self.known = {normal(s): code[i] for i, s in sentences if "{}" not in s}
        self.gaps = [(*map(normal, s.split("{}")), code[i]) for i, s in sentences if "{}" in s]
        whole = [*map(str.split, self.known), *(p.split() for p, _, _ in self.gaps)]
        self.begins = {" ".join(w[:k]) for w in whole for k in range(1, len(w) + 1)}
        self.heads = {p for p, _, _ in self.gaps}
        #: where a known sentence goes on after a full stop
        self.inner = set()
        for _, s in sentences:
            at = [m.start() for m in END.finditer(s.split("{}")[0])][:-1]
            self.inner |= {normal(s[:i]) for i in at}
        self.rules = {"".join(map(code.get, ids)): n for n, ids in rules}
        altered = {"".join(map(code.get, x)) for _, ids in rules for x in interrupted(ids)}
        self.rules = {**dict.fromkeys(altered, "altered"), **self.rules}
        self.pattern = re.compile("|".join([re.escape(r) for r in sorted(self.rules, key=lambda s: (-len(s), s))] + [r"[^?]"]))

    def sentence(self, joined: str, in_gap: list) -> str | None:
        """The identifier of a normal form; ``in_gap`` are the gapped sentences that it begins."""
        if joined in self.known:
            return self.known[joined]
        for head, tail, c in in_gap:
            if joined.endswith(" " + tail) and 0 < len(joined[len(head):len(joined) - len(tail)].split()) <= GAP:
                return c
        return None

    def sentences(self, text: str) -> list[tuple[str, int, int]]:
        """(identifier code, start, end) of the known sentences and of OTHER between them."""
        pieces, at = [], 0  # normal form, whether a line end follows, start, end
        for m in END.finditer(text):
            # "SPDX-License-Identifier: MIT" is one sentence although a colon ends a piece
            pieces.append((text[at:m.start()], m[0] in ("\n", ":"), at, m.end()))
            at = m.end()
        pieces.append((text[at:], False, at, len(text)))
        out, i = [], 0
        while i < len(pieces):
            joined, found = "", None
            for j in range(i, len(pieces)):
                part = normal(pieces[j][0])
                joined = f"{joined} {part}" if joined else part
                if not part and j == i:
                    break
                in_gap = [g for g in self.gaps if joined.startswith(g[0] + " ") and len(joined.split()) <= len(g[0].split()) + GAP + len(g[1].split())]
                if joined not in self.begins and not in_gap:
                    break
                c = self.sentence(joined, in_gap)
                if c:
                    found = (j, c)
                if not part or not pieces[j][1] and joined not in self.inner and not in_gap:
                    break
            if found:
                out.append((found[1], pieces[i][2], pieces[found[0]][3]))
                i = found[0]
            elif out and out[-1][0] != OTHER and len(normal(ADDRESS.sub(" ", pieces[i][0])).split()) >= CLAUSE:
                out.append((OTHER, pieces[i][2], pieces[i][3]))
            i += 1
        return out

    def licenses(self, text: str) -> list[tuple[int, str, str, int, int]]:
        """(number, licence, identifiers, start, end) of each match."""
        found = self.sentences(text)
        seq = "".join(c for c, _, _ in found)
        return [(k, self.rules.get(m[0], "incomplete"), ",".join("other" if c == OTHER else self.names[ord(c) - 0x100] for c in m[0]),
                 found[m.start()][1], found[m.end() - 1][2]) for k, m in enumerate(self.pattern.finditer(seq), 1)]


def scan(docs: DataFrame, known: Recognizer | None = None) -> DataFrame:
    """doc_id, match, license, sentences, start, end (code points) of every match."""
    known = known or Recognizer()
    names = ["doc_id", "match", "license", "sentences", "start", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = [(d, *x) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True) if t
                    for x in known.licenses(t)]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return columns(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, match long, license string, sentences string, start long, end long")


def op3_license_sentences(spark, sf_dir: str) -> DataFrame:
    """Licences of every document in the order of its text."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "match", "license", "sentences")


def oracle() -> str:
    """The same in SQL, for sentences of one line or of lines and colons joined, and names in one line."""
    r = Recognizer()
    known = ", ".join(f"('{k}', '{c}')" for k, c in r.known.items())
    names = ", ".join([f"('{chr(0x100 + i)}', '{n}')" for i, n in enumerate(r.names)] + [f"('{OTHER}', 'other')"])
    rules = ", ".join(f"('{s}', '{n}')" for s, n in r.rules.items())
    gaps = " ".join(f"WHEN regexp_full_match(w.s, '{h}( [a-z0-9]+){{1,{GAP}}} {t}') THEN '{c}'" for h, t, c in r.gaps)
    return rf"""
WITH RECURSIVE known(s, c) AS (VALUES {known}), names(c, id) AS (VALUES {names}), rules(s, license) AS (VALUES {rules}),
src AS (SELECT row_number() OVER () AS r, doc_id, string_split(
          regexp_replace(regexp_replace(text, '([.!?:]+)([\x20\x09-\x0D])', '\1' || chr(2) || '\2', 'g'), '([.!?:]+)$', '\1' || chr(2)), chr(10)) AS l
        FROM documents WHERE text <> ''),
lines AS (SELECT r, doc_id, unnest(l) AS l, generate_subscripts(l, 1) AS i FROM src),
cut AS (SELECT r, doc_id, i, string_split(l, chr(2)) AS p FROM lines),
piece AS (SELECT r, doc_id, i, unnest(p) AS t, generate_subscripts(p, 1) AS j, len(p) AS n FROM cut),
norm AS (SELECT r, doc_id, row_number() OVER (PARTITION BY r ORDER BY i, j) AS k,
                trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) AS s, j = n OR (t LIKE '%:' AND NOT regexp_matches(t, '[.!?:]:$')) AS soft,
                len(regexp_extract_all(lower(regexp_replace(t, '{ADDRESS.pattern}', ' ', 'g')), '[a-z0-9]+')) >= {CLAUSE} AS clause FROM piece),
w AS (SELECT *, lead(s, 1) OVER x AS s1, lead(s, 2) OVER x AS s2, lead(soft, 1) OVER x AS f1 FROM norm WINDOW x AS (PARTITION BY r ORDER BY k)),
hit AS (SELECT r, doc_id, k, clause, coalesce(c3.c, c2.c, c1.c, CASE {gaps} END) AS c,
          CASE WHEN c3.c IS NOT NULL THEN 3 WHEN c2.c IS NOT NULL THEN 2 ELSE 1 END AS span FROM w
        LEFT JOIN known c1 ON c1.s = w.s LEFT JOIN known c2 ON w.soft AND c2.s = w.s || ' ' || w.s1 AND w.s <> '' AND w.s1 <> ''
        LEFT JOIN known c3 ON w.soft AND w.f1 AND c3.s = w.s || ' ' || w.s1 || ' ' || w.s2 AND w.s <> '' AND w.s1 <> '' AND w.s2 <> ''),
other AS (SELECT r, doc_id, k, coalesce(c, CASE WHEN clause AND coalesce(lag(span, 1) OVER y, 1) < 2 AND coalesce(lag(span, 2) OVER y, 1) < 3 THEN '{OTHER}' END) AS c
          FROM hit WINDOW y AS (PARTITION BY r ORDER BY k)),
seq AS (SELECT r, doc_id, regexp_replace(string_agg(c, '' ORDER BY k), '[?]+', '{OTHER}', 'g') AS s FROM other WHERE c IS NOT NULL GROUP BY r, doc_id),
m AS (SELECT r, doc_id, regexp_extract_all(s, '{r.pattern.pattern}') AS m FROM seq),
e AS (SELECT r, doc_id, unnest(m) AS s, generate_subscripts(m, 1)::BIGINT AS match FROM m),
ch AS (SELECT r, match, unnest(string_split(s, '')) AS c, generate_subscripts(string_split(s, ''), 1) AS i FROM e),
ids AS (SELECT r, match, string_agg(id, ',' ORDER BY i) AS sentences FROM ch JOIN names USING (c) GROUP BY r, match)
SELECT doc_id, e.match, coalesce(license, 'incomplete') AS license, sentences
FROM e JOIN ids ON ids.r = e.r AND ids.match = e.match LEFT JOIN rules ON rules.s = e.s
"""
