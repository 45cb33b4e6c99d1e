import brute
import duckdb

from flightlake.llm import licences

APACHE = """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */"""
BSD = """Copyright (c) 2020, Someone. All rights reserved.
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
ENDORSE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
TEXTS = [
    (1, APACHE, "Apache-2.0"), (2, BSD, "BSD-2-Clause"), (3, BSD + ENDORSE, "BSD-3-Clause"), (4, "Some prose\nReleased under the MIT License.\nMore", "MIT"),
    (5, "// SPDX-License-Identifier: MIT\ncode", "MIT"), (6, "Licenced under the Apache Licence, version 2.0.", "Apache-2.0"),
    (7, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "CC-BY-NC-4.0,MIT"), (8, "All rights reserved.", ""),
    (9, "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.", "GPL-2.0-or-later"),
    (10, "A licence to speak of nothing. " * 2000, None), (11, None, None), (12, "", None), (13, "mit", None),
]


def test_licences(spark):
    got = {r["doc_id"]: r["licences"] for r in licences.licences(brute.frame(spark, [(d, t) for d, t, _ in TEXTS])).collect()}
    assert got == {d: name for d, _, name in TEXTS if name is not None}


def test_matched_sentences_are_used_up(spark):
    (r,) = licences.licences(brute.frame(spark, [(3, BSD + ENDORSE)])).collect()
    assert (r["n_sentences"], r["n_unmatched"]) == (5, 1)


def test_sql_says_the_same(spark):
    rows = [(d, t) for d, t, _ in TEXTS] + [(4, TEXTS[3][1]), (None, BSD)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cur = con.execute(licences.licences_sql())
    names = [d[0] for d in cur.description]
    wanted = sorted(repr(tuple(dict(zip(names, r))[c] for c in ("doc_id", "licences", "n_sentences", "n_unmatched"))) for r in cur.fetchall())
    assert sorted(repr(tuple(r)) for r in licences.licences(brute.frame(spark, rows)).collect()) == wanted


def test_empty_table(spark):
    assert licences.licences(brute.frame(spark, [])).collect() == []


def test_sentences_without_a_cue_or_with_a_wrapped_one(spark):
    isc = "/*\n * Permission to use, copy, modify, and/or distribute this software for any\n * purpose with or without fee is hereby\n * granted, provided that the above copyright notice and this permission notice\n * appear in all copies.\n */"
    free = "# This is free and unencumbered software released into the public\n# domain."
    liable = "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    corpus = [(1, "CC0 1.0 Universal"), (2, isc), (3, free), (4, liable), (5, "ISC"), (6, "My licence:\nISC")]
    got = sorted(tuple(r) for r in licences.licences(brute.frame(spark, corpus)).collect())
    assert got == [(1, "CC0-1.0", 1, 0), (2, "ISC", 1, 0), (3, "Unlicense", 1, 0), (4, "", 1, 1), (6, "", 1, 1)]
