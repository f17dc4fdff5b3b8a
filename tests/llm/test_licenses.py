import re

import duckdb

from orderloom.llm import licenses

MIT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""


def scan(make, texts):
    rows = [(k, t, "en", "a") for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in licenses.scan(make(rows)).collect()}
    return [(got[k].n_sentences, got[k].sentence_ids, got[k].licenses) for k in range(len(texts))]


def test_full_texts_and_short_lines(make):
    got = scan(
        make,
        [
            MIT, APACHE,
            "Prose here.\nReleased under the MIT License.\nMore prose. All rights reserved.",
            "Prose. Licensed under CC BY-NC 4.0. Go on",
            "no such thing as a license here", None, "", "All rights reserved",
            "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.\nReleased under the MIT License.\nSee the License for the specific language governing permissions and limitations under the License.",
        ],
    )
    assert got[0] == (4, "copyright,mit-grant,mit-notice,mit-asis", "MIT")
    assert got[1][1:] == ("apache-grant,apache-asis,apache-see", "Apache-2.0")
    assert got[2] == (2, "mit-short,reserved", "MIT,Proprietary")
    assert got[3] == (1, "cc-by-nc-short", "CC-BY-NC-4.0")
    assert got[4:7] == [(0, "", "")] * 3
    assert got[7] == (1, "reserved", "Proprietary")
    assert got[8][2] == "Apache-2.0,MIT"


def test_every_rule_finds_its_own_sentences(make):
    texts = ["\n\n".join(licenses.SENTENCES[i][0] for i in ids) for _, ids in licenses.RULES]
    got = scan(make, texts)
    assert [g[2] for g in got] == [name for name, _ in licenses.RULES]


def test_every_sentence_has_a_hint_and_one_identifier():
    assert all(re.search(licenses.HINT, v) for vs in licenses.SENTENCES.values() for v in vs)
    assert len(licenses.known_sentences()) == len(
        {licenses.normal(v) for vs in licenses.SENTENCES.values() for v in vs}
    )
    used = {i for _, ids in licenses.RULES for i in ids}
    assert used == set(licenses.SENTENCES)


def test_all_planted_lines_are_found(documents, small_docs):
    lines = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
        "All rights reserved.": "Proprietary",
    }
    got = {r.doc_id: r.licenses.split(",") for r in licenses.scan(documents).collect()}
    for i, text, _, _ in small_docs:
        want = [lines[x] for x in text.split("\n") if x in lines]
        assert [x for x in got[i] if x] == want


def test_odd_rows_agree_with_sql(spark, make, odd_rows):
    rows = [*odd_rows, (500, MIT, "en", "a"), (500, MIT, "en", "a"), (501, APACHE, "en", "b")]
    got = sorted(map(tuple, licenses.scan(make(rows)).collect()), key=str)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [r[:2] for r in rows])
    assert got == sorted(con.sql(licenses.oracle()).fetchall(), key=str)
    assert licenses.scan(make([])).collect() == []


GPL2 = """/* This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 */
"""
GPL3 = GPL2.replace("software;", "software:").replace("Foundation; either version 2", "Foundation, either version 3")


def test_published_headers_and_breaks_before_any_sign(make):
    got = scan(
        make,
        [
            GPL2, GPL3, MIT.replace('files (the "Software"), to deal\nin', 'files (the\n"Software"), to deal in'),
            "Licensed under the Apache\nLicense, Version 2.0.", "Copyright\n(c) 2020 Some One\n\nProse",
            'Licensed under the Apache License, Version 2.0\n(the "License"); you may not use this file except in compliance with the License.',
            "Licensed under the\n\nMIT License.", "Licensed under the\n#\n# MIT License.", "It is not\nlicensed under the MIT License.",
            "Licensed under the MIT License\n(All rights reserved)\nProse", "Licensed under the \n \nMIT License.",
        ],
    )
    assert got[0][1:] == ("gpl2-grant,gpl-asis", "GPL-2.0-or-later")
    assert got[1][1:] == ("gpl3-grant,gpl-asis", "GPL-3.0-or-later")
    assert got[2] == (4, "copyright,mit-grant,mit-notice,mit-asis", "MIT")
    assert got[3] == (1, "apache-short", "Apache-2.0")
    assert got[4] == (1, "copyright", "")
    assert got[5] == (1, "apache-grant", "Apache-2.0")
    assert got[6:9] == [(0, "", "")] * 3
    assert got[9] == (2, "mit-short,reserved", "MIT,Proprietary")
    assert got[10] == (0, "", "")


def broken_sentences():
    """Known sentences broken at each word in turn and at all words, and their identifiers."""
    for identifier, variants in licenses.SENTENCES.items():
        for words in (v.split(" ") for v in variants):
            for k in range(1, len(words)):
                yield " ".join(words[:k]) + "\n" + " ".join(words[k:]), identifier
            for gap in ("\n", "\r\n", " \n  ", "\n# ", "\n// "):
                yield gap.join(words), identifier


def test_sentences_broken_at_any_word(make):
    broken = list(broken_sentences())
    got = scan(make, [f"On licences.\n\n{text}\nMore prose" for text, _ in broken])
    assert [(*g[:2], t) for g, (t, _) in zip(got, broken, strict=True)] == [(1, i, t) for t, i in broken]


def test_broken_sentences_without_another_hint(make):
    assert all(re.search(licenses.WORDS, key) for key in licenses.known_sentences())
    broken = [*broken_sentences(), ("All rights  reserved.", "reserved"), ("All\trights\treserved", "reserved")]
    got = scan(make, [f"Prose.\n\n{text}\nMore prose" for text, _ in broken])
    assert [(*g[:2], t) for g, (t, _) in zip(got, broken, strict=True)] == [(1, i, t) for t, i in broken]
