"""License scans by sentence rules.

A text is cut into normalised sentences, known ones become identifiers, and ordered rules rewrite the
sequence of identifiers: where a rule's identifiers follow each other, with at most two other known
sentences between neighbours, they become the license. Rules that say more come first.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public license texts and notices, as published.
SENTENCES = {
    "mit-short": ["Released under the MIT License.", "Licensed under the MIT License.",
                  "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-asis": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "isc-asis": ["THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."],
    "apache-short": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "apache-grant": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "apache-asis": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "apache-see": ["See the License for the specific language governing permissions and limitations under the License."],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "bsd-asis": ["THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."],
    "gpl3-short": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"],
    "gpl2-short": ["Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only"],
    "gpl3-grant": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl2-grant": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "gpl-asis": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "mpl-short": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "unlicense-grant": ["This is free and unencumbered software released into the public domain."],
    "cc0-short": ["This work is dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "cc-by-short": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa-short": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc-short": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "reserved": ["All rights reserved."],
}

# Which identifiers, in this order, make which license. Earlier rules win.
RULES = [
    ("Apache-2.0", ["apache-grant", "apache-asis", "apache-see"]),
    ("Apache-2.0", ["apache-grant"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-asis"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-asis"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-asis"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("ISC", ["isc-grant", "isc-asis"]),
    ("GPL-3.0-or-later", ["gpl3-grant", "gpl-asis"]),
    ("GPL-2.0-or-later", ["gpl2-grant", "gpl-asis"]),
    ("GPL-3.0-or-later", ["gpl3-grant"]),
    ("GPL-2.0-or-later", ["gpl2-grant"]),
    ("MIT", ["mit-short"]),
    ("Apache-2.0", ["apache-short"]),
    ("GPL-3.0-only", ["gpl3-short"]),
    ("GPL-2.0-only", ["gpl2-short"]),
    ("MPL-2.0", ["mpl-short"]),
    ("Unlicense", ["unlicense-grant"]),
    ("CC0-1.0", ["cc0-short"]),
    ("CC-BY-4.0", ["cc-by-short"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-short"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-short"]),
    ("Proprietary", ["reserved"]),
]

COPYRIGHT = "copyright"
# Known sentences and notices have one of these words; texts without any are not cut at all.
WORDS = r"(?i)licen[sc]|copyright|reserved|permission|warrant|redistribution|domain"
# The SQL's own choice of texts, which misses phrases broken between words.
HINT = r"(?i)licen[sc]|copyright|rights reserved|permission|warrant|redistribution|public domain"
# Patterns that Java and RE2 read alike.
LEADER = r"(?m)^[ \t]*(?://+|#+|\*+|--+|;+)[ \t]*"
WRAP = r"([^.!?\n])[ \t]*\r?\n[ \t]*([a-z]|[A-Z][A-Z])"
END = r"([.!?]\"?)[ \t\r\n]+"
OTHER = r"[^a-z0-9]+"
# Java only: blank lines, and what is no word, line break or blank between two words.
BLANK = r"\n[ \t\r]*\n[ \t\r\n]*"
NO_WORD = r"[^a-z0-9\n]+"
NOTICE = r"copyright(?: |\n(?:c[ \n]|[0-9]))[^\n]*+"
BETWEEN = "((?:<[a-z0-9-]+>){0,2}?)"
NAME = "=([A-Za-z0-9.-]+)="


def normal(sentence: str) -> str:
    """The first sentence of a text as it is compared."""
    return re.sub(OTHER, " ", re.split(END, sentence)[0].lower()).strip()


def known_sentences() -> dict[str, str]:
    """Identifier of each normalised sentence."""
    return {
        normal(variant): identifier
        for identifier, variants in SENTENCES.items()
        for variant in variants
    }


def rewrites() -> list[tuple[str, str, int]]:
    """Pattern, license and number of groups (what stood between, which stays) of each rule."""
    return [
        (BETWEEN.join(f"<{i}>" for i in ids), f"={name}=", len(ids) - 1) for name, ids in RULES
    ]


def known_pattern() -> str:
    """Whole known sentences, broken between any words, and copyright notices; longer ones first."""
    known = sorted(known_sentences(), key=len, reverse=True)
    either = "|".join([NOTICE, *(k.replace(" ", r"[ \n]") for k in known)])
    return rf"(?<![^\n])(?:{either})(?![^\n])"


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    table = F.create_map(*[F.lit(x) for pair in known_sentences().items() for x in pair])
    cut = F.regexp_replace(text, LEADER, "")
    # Sentences and paragraphs end in two line breaks; where a line ends in one, a sentence may end.
    cut = F.regexp_replace(cut, BLANK, "\n\n")
    cut = F.regexp_replace(cut, WRAP, "$1 $2")
    cut = F.regexp_replace(cut, END, "$1\n\n")
    plain = F.regexp_replace(F.regexp_replace(F.lower(cut), NO_WORD, " "), " ?\n ?", "\n")
    named = F.transform(
        F.regexp_extract_all(F.trim(plain), F.lit(known_pattern()), F.lit(0)),
        lambda s: F.when(s.startswith("copyright"), F.lit(COPYRIGHT)).otherwise(
            F.try_element_at(table, F.translate(s, "\n", " "))
        ),
    )
    return F.when(F.coalesce(text, F.lit("")).rlike(WORDS), named).otherwise(
        F.array().cast("array<string>")
    )


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_sentences, sentence_ids, licenses`` of every document.

    ``n_sentences`` counts the known sentences of the whole text; ``sentence_ids`` names them and
    ``licenses`` the licenses by the rules, in order of their place, repeated where they repeat,
    joined by commas. Sentences end at a stop or blank line, or at a line break unless the next
    line goes on in lower case or capitals or the known sentence goes on there: it is found however
    its lines are broken, the longest first. Comment signs at the start of lines do not count. Null
    and empty texts have none. Rows are independent: null ids and repeated rows come back as they are, an
    empty table gives no rows, other columns are ignored.
    """
    found, licenses = "_ids", F.col("_marked")
    for pattern, name, groups in rewrites():
        kept = "".join(f"${k + 1}" for k in range(groups))
        licenses = F.regexp_replace(licenses, pattern, name + kept)
    marked = F.array_join(F.transform(found, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    return (
        docs.select(F.col(id_col).alias("doc_id"), identifiers(F.col(text_col)).alias(found))
        .select("*", marked.alias("_marked"))
        .select(
            "doc_id",
            F.size(found).cast("long").alias("n_sentences"),
            F.array_join(found, ",").alias("sentence_ids"),
            F.array_join(F.regexp_extract_all(licenses, F.lit(NAME), F.lit(1)), ",").alias(
                "licenses"
            ),
        )
    )


def oracle() -> str:
    """The scan as SQL over ``documents``, for sentences whose lines go on in lower case or capitals."""

    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    table = known_sentences()
    keys = "[" + ", ".join(map(quoted, table)) + "]"
    values = "[" + ", ".join(map(quoted, table.values())) + "]"
    licenses = "list_aggregate(list_transform(ids, lambda x: '<' || x || '>'), 'string_agg', '')"
    for pattern, name, groups in rewrites():
        kept = "".join(f"\\{k + 1}" for k in range(groups))
        licenses = f"regexp_replace({licenses}, {quoted(pattern)}, {quoted(name + kept)}, 'g')"
    return f"""
WITH hinted AS (
  SELECT doc_id, CASE WHEN regexp_matches(coalesce(text, ''), {quoted(HINT)}) THEN text END AS t
  FROM documents
), cut AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, {quoted(LEADER)}, '', 'g'),
    {quoted(WRAP)}, '\\1 \\2', 'g'), {quoted(END)}, '\\1' || chr(10), 'g') AS t
  FROM hinted
), plain AS (
  SELECT doc_id, list_transform(string_split(lower(t), chr(10)),
    lambda s: trim(regexp_replace(s, {quoted(OTHER)}, ' ', 'g'))) AS sentences
  FROM cut
), named AS (
  SELECT doc_id, coalesce(list_filter(list_transform(sentences, lambda s:
    CASE WHEN starts_with(s, 'copyright ') THEN {quoted(COPYRIGHT)}
    ELSE ({values})[list_position({keys}, s)] END), lambda x: x IS NOT NULL), []) AS ids
  FROM plain
)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences,
  coalesce(array_to_string(ids, ','), '') AS sentence_ids,
  coalesce(array_to_string(regexp_extract_all({licenses}, {quoted(NAME)}, 1), ','), '') AS licenses
FROM named"""
