"""Licences recognised from known sentences and ordered rules over them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import let, pick

# Sentences of public licence texts and notices, normalised to lower-case
# letters and digits separated by single spaces, with the identifier each stands for.
SENTENCES = {
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "this project is licensed under the mit license": "mit-ref",
    "mit license": "mit-title",
    "the mit license": "mit-title",
    "the mit license mit": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-as-is",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "licensed under the apache license version 2 0": "apache-2-ref",
    "licensed under the apache license version 2 0 the license": "apache-2-head",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may not use this work except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at": "apache-copy",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-as-is",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-as-is",
    "licensed under the bsd 2 clause license": "bsd-2-ref",
    "licensed under the bsd 3 clause license": "bsd-3-ref",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-as-is",
    "this work is licensed under the gnu general public license version 2": "gpl-2-ref",
    "this work is licensed under the gnu general public license version 3": "gpl-3-ref",
    "licensed under the gnu general public license version 2": "gpl-2-ref",
    "licensed under the gnu general public license version 3": "gpl-3-ref",
    "licensed under the gnu lesser general public license version 2 1": "lgpl-21-ref",
    "licensed under the gnu lesser general public license version 3": "lgpl-3-ref",
    "licensed under the gnu affero general public license version 3": "agpl-3-ref",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-terms",
    "either version 2 of the license or at your option any later version": "gpl-2-later",
    "either version 3 of the license or at your option any later version": "gpl-3-later",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl-hope",
    "licensed under cc by 4 0": "cc-by-ref",
    "licensed under cc by sa 4 0": "cc-by-sa-ref",
    "licensed under cc by nc 4 0": "cc-by-nc-ref",
    "licensed under cc by nd 4 0": "cc-by-nd-ref",
    "licensed under cc0 1 0": "cc0-ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-ref",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2-head",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl-2-copy",
    "this is free and unencumbered software released into the public domain": "unlicense-head",
    "this library is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl-2-only-terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl-terms",
    "either version 2 1 of the license or at your option any later version": "lgpl-21-later",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl-3-terms",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl-3-terms",
    "this source code form is subject to the terms of the mozilla public license v": "mpl-2-head",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl-2-copy",
    "this software is provided as is without any express or implied warranty": "zlib-as-is",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "distributed under the boost software license version 1 0": "bsl-ref",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-ref",
    "this work is licensed under a creative commons attribution noderivatives 4 0 international license": "cc-by-nd-ref",
}

# SPDX identifiers that a licence tag may name.
SPDX = (
    "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0",
    "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0",
    "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
    "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MPL-2.0", "OFL-1.1", "Unlicense", "WTFPL", "Zlib",
)
SPDX_TAG = "spdx license identifier"
SENTENCES.update(
    {f"{SPDX_TAG} {re.sub('[^a-z0-9]+', ' ', name.lower())}": f"spdx-{name.lower()}" for name in SPDX}
)


@dataclass(frozen=True)
class LicenceRule:
    """A licence and the identifiers that make it up, in their order."""

    licence: str
    sequence: tuple[str, ...]


# Longer rules come first; a sentence belongs to the first rule that takes it.
RULES = (
    LicenceRule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is")),
    LicenceRule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    LicenceRule("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    LicenceRule("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    LicenceRule("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    LicenceRule("Apache-2.0", ("apache-2-head", "apache-comply", "apache-copy", "apache-as-is", "apache-see")),
    LicenceRule("Apache-2.0", ("apache-2-head", "apache-comply", "apache-copy")),
    LicenceRule("GPL-2.0-or-later", ("gpl-free", "gpl-terms", "gpl-2-later")),
    LicenceRule("GPL-3.0-or-later", ("gpl-free", "gpl-terms", "gpl-3-later")),
    LicenceRule("GPL-2.0-only", ("gpl-free", "gpl-2-only-terms")),
    LicenceRule("GPL-3.0-or-later", ("gpl-free", "gpl-3-terms")),
    LicenceRule("LGPL-2.1-or-later", ("gpl-free", "lgpl-terms", "lgpl-21-later")),
    LicenceRule("LGPL-3.0-or-later", ("gpl-free", "lgpl-3-terms")),
    LicenceRule("AGPL-3.0-or-later", ("gpl-free", "agpl-3-terms")),
    LicenceRule("Zlib", ("zlib-as-is", "zlib-grant")),
    LicenceRule("BSL-1.0", ("bsl-ref",)),
    LicenceRule("ISC", ("isc-grant", "isc-as-is")),
    LicenceRule("MPL-2.0", ("mpl-2-head", "mpl-2-copy")),
    LicenceRule("MPL-2.0", ("mpl-2-head",)),
    LicenceRule("Apache-2.0", ("apache-2-head",)),
    LicenceRule("Apache-2.0", ("apache-2-ref",)),
    LicenceRule("MIT", ("mit-ref",)),
    LicenceRule("BSD-2-Clause", ("bsd-2-ref",)),
    LicenceRule("BSD-3-Clause", ("bsd-3-ref",)),
    LicenceRule("GPL-2.0", ("gpl-2-ref",)),
    LicenceRule("GPL-3.0", ("gpl-3-ref",)),
    LicenceRule("LGPL-2.1", ("lgpl-21-ref",)),
    LicenceRule("LGPL-3.0", ("lgpl-3-ref",)),
    LicenceRule("AGPL-3.0", ("agpl-3-ref",)),
    LicenceRule("CC-BY-4.0", ("cc-by-ref",)),
    LicenceRule("CC-BY-SA-4.0", ("cc-by-sa-ref",)),
    LicenceRule("CC-BY-NC-4.0", ("cc-by-nc-ref",)),
    LicenceRule("CC-BY-ND-4.0", ("cc-by-nd-ref",)),
    LicenceRule("CC0-1.0", ("cc0-ref",)),
    LicenceRule("Unlicense", ("unlicense-head",)),
    *(LicenceRule(name, (f"spdx-{name.lower()}",)) for name in SPDX),
)

# Recognised sentences further apart than this do not belong to one rule.
MAX_GAP = 3

# A sentence that speaks of licensing, known or not.
SPEAKS = "(^| )(license|licensed|licence|licenced|copyright|warranty|warranties)( |$)"

# Steps that mark the ends of sentences with \u0001 and reduce the rest to words.  Comment leaders
# go from the starts of lines; the word License that a line break parts from the name before it
# comes back to it; a licence tag and what it names are a sentence.  Then sentences end after
# a stop and white space, at an empty line, and where a new line starts like a sentence.
CLEANING = (
    ("(^|\\n)[ \\t]*(//+|#+|/\\*+|\\*+/?|--+|;+|%+)", "$1"),
    ("([A-Za-z,])[ \\t\\r]*\\n[ \\t]*(License[ ,])", "$1 $2"),
    ("(?i)(SPDX-License-Identifier:[ \\t]*[A-Z0-9.-]+)[+]", "$1-or-later"),
    ("(?i)SPDX-License-Identifier:[ \\t]*[(]?([A-Z0-9.-]+)", "\u0001spdx license identifier $1\u0001"),
    ("([.;:!?])[ \\t\\r\\n]+", "$1\u0001"),
    ("\\n[ \\t\\r]*\\n", "\u0001"),
    ("\\n[ \\t\\r]*([A-Z][a-z])", "\u0001$1"),
    ("[^A-Za-z0-9\u0001]+", " "),
)


def sentences(text: Column) -> Column:
    """Normalised sentences of a text in order, empty ones included."""
    marked = F.coalesce(text, F.lit(""))
    for pattern, replacement in CLEANING:
        marked = F.regexp_replace(marked, pattern, replacement)
    return F.transform(F.split(F.lower(marked), "\u0001"), lambda s: F.trim(s))


def _token(identifier: str) -> str:
    return f"<{identifier}>"


def scan(
    docs: DataFrame,
    known: dict[str, str] = SENTENCES,
    rules: tuple[LicenceRule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, licences, identifiers, n_known, n_unmatched, n_unknown`` for every row.

    ``identifiers`` are the known sentences in text order, ``licences`` the distinct
    licences of the rules that matched, both joined by commas (empty if there are none).
    ``n_unmatched`` counts known sentences that no rule took and ``n_unknown`` sentences
    that speak of licensing but are not known.  Comment leaders do not matter, and of a licence tag
    the first identifier is read.  A rule takes sentences in its order with at most two others
    between neighbours (`MAX_GAP`): further apart they belong to different notices.

    Sentences and rules are a bounded table held in the plan, so a document is scanned
    within its row and nothing is shuffled.  A null or empty text has no sentences; null
    ids and repeated rows are scanned like others; an empty table gives no rows.
    """
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    ordered = F.array(
        *[
            F.struct(
                F.lit("".join(map(_token, r.sequence))).alias("pattern"),
                F.lit(r.licence).alias("licence"),
            )
            for r in rules
        ]
    )

    def looked_up(found: Column) -> Column:
        named = F.transform(
            found,
            lambda s, i: F.struct(
                i.alias("i"),
                F.try_element_at(table, s).alias("id"),
                s.rlike(SPEAKS).alias("speaks"),
            ),
        )
        return let(
            F.filter(named, lambda x: x["id"].isNotNull() | x["speaks"]),
            lambda x: F.struct(
                F.filter(x, lambda y: y["id"].isNotNull()).alias("hits"),
                F.size(F.filter(x, lambda y: y["id"].isNull())).alias("n_unknown"),
            ),
        )

    def sequence(hits: Column) -> Column:
        return F.aggregate(
            hits,
            F.struct(F.lit(0).alias("last"), F.lit("").alias("s")),
            lambda a, x: F.struct(
                x["i"].alias("last"),
                F.concat(
                    a["s"],
                    F.when(x["i"] - a["last"] > MAX_GAP, "|").otherwise(""),
                    F.lit("<"), x["id"], F.lit(">"),
                ).alias("s"),
            ),
            lambda a: a["s"],
        )

    def matched(tokens: Column) -> Column:
        return F.aggregate(
            ordered,
            F.struct(tokens.alias("left"), F.array().cast("array<string>").alias("found")),
            lambda a, r: F.struct(
                F.replace(a["left"], r["pattern"], F.lit("|")).alias("left"),
                F.when(F.contains(a["left"], r["pattern"]), F.array_append(a["found"], r["licence"]))
                .otherwise(a["found"])
                .alias("found"),
            ),
        )

    scanned = pick(docs, id_col, text_col).select(
        F.col(id_col).alias("doc_id"), let(sentences(F.col(text_col)), looked_up).alias("x")
    )
    return scanned.select(
        "doc_id", "x.hits", "x.n_unknown", let(sequence(F.col("x.hits")), matched).alias("m")
    ).select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct("m.found")), ",").alias("licences"),
        F.array_join(F.transform("hits", lambda h: h["id"]), ",").alias("identifiers"),
        F.size("hits").cast("long").alias("n_known"),
        (F.size(F.split("m.left", "<")) - 1).cast("long").alias("n_unmatched"),
        F.col("n_unknown").cast("long").alias("n_unknown"),
    )


def reference_sql() -> str:
    """The same result in DuckDB's SQL, with one step for each rule."""
    marked = "coalesce(text, '')"
    for pattern, replacement in CLEANING:
        pattern = pattern.replace("\u0001", "\\x01")
        replacement = "'" + replacement.replace("\u0001", "' || chr(1) || '").replace("$", "\\") + "'"
        marked = f"regexp_replace({marked}, '{pattern}', {replacement}, 'g')"
    known = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    steps, last = [], "r0"
    for k, rule in enumerate(RULES, 1):
        pattern = "".join(map(_token, rule.sequence))
        steps.append(
            f"r{k} AS (SELECT doc_id, replace(tokens, '{pattern}', '|') AS tokens,"
            f" CASE WHEN contains(tokens, '{pattern}') THEN list_append(found, '{rule.licence}')"
            f" ELSE found END AS found FROM {last})"
        )
        last = f"r{k}"
    return f"""
WITH known(s, id) AS (VALUES {known}),
listed AS (SELECT doc_id, string_split(lower({marked}), chr(1)) AS ss FROM documents),
sentence AS (
  SELECT doc_id, unnest(list_transform(ss, lambda x: trim(x))) AS s, generate_subscripts(ss, 1) AS i
  FROM listed),
named AS (SELECT doc_id, i, s, id FROM sentence LEFT JOIN known USING (s)),
gaps AS (
  SELECT doc_id, i, id, i - 1 - lag(i - 1, 1, 0) OVER (PARTITION BY doc_id ORDER BY i) AS gap
  FROM named WHERE id IS NOT NULL),
hits AS (
  SELECT doc_id, count(*) AS n_known, string_agg(id, ',' ORDER BY i) AS identifiers,
    string_agg(CASE WHEN gap > {MAX_GAP} THEN '|' ELSE '' END || '<' || id || '>', '' ORDER BY i) AS tokens
  FROM gaps GROUP BY doc_id),
unknown AS (
  SELECT doc_id, count(*) AS n FROM named
  WHERE id IS NULL AND regexp_matches(s, '{SPEAKS}') GROUP BY doc_id),
r0 AS (SELECT doc_id, tokens, CAST([] AS VARCHAR[]) AS found FROM hits),
{", ".join(steps)}
SELECT d.doc_id,
  coalesce(array_to_string(list_sort(list_distinct(r.found)), ','), '') AS licences,
  coalesce(h.identifiers, '') AS identifiers,
  coalesce(h.n_known, 0) AS n_known,
  coalesce(length(r.tokens) - length(replace(r.tokens, '<', '')), 0) AS n_unmatched,
  coalesce(u.n, 0) AS n_unknown
FROM documents d LEFT JOIN hits h USING (doc_id) LEFT JOIN {last} r USING (doc_id)
LEFT JOIN unknown u USING (doc_id)
"""
