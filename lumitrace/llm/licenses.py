"""Licences by sentence rules, with DataFrame functions only.

A text is cut into sentences, each is normalised to lower-case words with one
space between them, and known sentences are replaced by their identifiers, in
the order in which they stand. The document's sequence of identifiers is then
matched against ordered rules: a rule that finds its identifiers in a row turns
them into the name of a licence, and later rules see what is left. Identifiers
that no rule took are reported.

A sentence ends with . ! ? ; or : before white space, or at an empty line, so
licence text may be wrapped over lines; the colon of an SPDX tag ends none.
A sentence that is known counts as often as it stands there. Known sentences may stand inside a
sentence, as a heading before them need not end with a stop.

Defined results: NULL and empty texts have no sentences and no licences;
repeated rows are scanned one by one; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumitrace.llm import frames

#: Texts without any of these hold no known sentence.
HINT = "(?i)licen[cs]|copyright|rights reserved|permission|redistribut|warrant|free software|public domain|creative commons|endorse|be liable|cc0|spdx"
BREAK = r"[.!?;:]+[\x22')\]]*\s+|\n\s*\n"
#: The same as they are asked of raw text: words of a hint may be wrapped, and a tag and its licence are one sentence.
RAW_HINT = HINT.replace(" ", "[^a-z0-9]+")
RAW_BREAK = f"(?<!(?i:spdx-license-identifier))(?:{BREAK})"
# Normalised sentences of public licence texts and notices, by identifier.
SENTENCES = {
    "spdx-apache2": "spdx license identifier apache 2 0",
    "spdx-mit": "spdx license identifier mit",
    "spdx-gpl3": "spdx license identifier (gpl 3 0|gpl 3 0 only|gpl 3 0 or later)",
    "spdx-gpl2": "spdx license identifier (gpl 2 0|gpl 2 0 only|gpl 2 0 or later)",
    "spdx-lgpl": "spdx license identifier lgpl [23] [01]( only| or later)?",
    "spdx-agpl3": "spdx license identifier agpl 3 0( only| or later)?",
    "spdx-bsd2": "spdx license identifier bsd 2 clause",
    "spdx-bsd3": "spdx license identifier bsd 3 clause",
    "spdx-mpl2": "spdx license identifier mpl 2 0",
    "spdx-isc": "spdx license identifier isc",
    "apache2-short": "licensed under the apache license version 2 0",
    "apache2-comply": "you may not use this file except in compliance with the license",
    "apache2-copy": "you may obtain a copy of the license at",
    "apache2-unless": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    "apache2-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-short": "(released|licensed|distributed) under the (terms of the )?mit license",
    "mit-title": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-asis": "the software is provided as is without warranty of any kind express or implied",
    "mit-liable": "in no event shall the authors or copyright holders be liable for any claim damages or other liability",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc-asis": "the software is provided as is and the author disclaims all warranties with regard to this software",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice",
    "bsd-endorse": "neither the name of [a-z0-9 ]+ may be used to endorse or promote products derived from this software",
    "bsd-asis": "this software is provided by [a-z0-9 ]+ as is and any express or implied warranties",
    "bsd-liable": "in no event shall [a-z0-9 ]+ be liable for any direct indirect incidental special exemplary or consequential damages",
    "gpl-terms": "redistribute it and or modify it under the terms of the gnu general public license",
    "lgpl-terms": "redistribute it and or modify it under the terms of the gnu lesser general public license",
    "agpl-terms": "redistribute it and or modify it under the terms of the gnu affero general public license",
    "gpl-later2": "either version 2 of the license or at your option any later version",
    "gpl-later3": "either version 3 of the license or at your option any later version",
    "gpl-hope": "is distributed in the hope that it will be useful but without any warranty",
    "gpl-copy": "you should have received a copy of the gnu (lesser |affero )?general public license",
    "gpl3-short": "licensed under the (terms of the )?gnu general public license version 3",
    "gpl2-short": "licensed under the (terms of the )?gnu general public license version 2",
    "lgpl-short": "licensed under the (terms of the )?gnu lesser general public license",
    "agpl-short": "licensed under the (terms of the )?gnu affero general public license",
    "mpl2-short": "subject to the terms of the mozilla public license v(ersion)? 2 0",
    "cc-by-nc": "licensed under (a )?(cc by nc|creative commons attribution noncommercial) 4 0",
    "cc-by-sa": "licensed under (a )?(cc by sa|creative commons attribution sharealike) 4 0",
    "cc-by": "licensed under (a )?(cc by|creative commons attribution) 4 0",
    "cc0": "(cc0 1 0 universal|dedicated to the public domain under cc0)",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications",
    "copyright": "copyright (c )?[12][0-9]{3}",
    "reserved": "all rights reserved",
}
_NOTICE = "(<copyright>|<reserved>)*"
# Ordered rules over identifiers; the first that matches takes them.
RULES = [
    ("Apache-2.0", f"{_NOTICE}<apache2-short>(<apache2-comply>)?(<apache2-copy>)?(<apache2-unless>)?(<apache2-see>)?"),
    ("Apache-2.0", "<spdx-apache2>"),
    ("MIT", f"(<mit-title>)?{_NOTICE}<mit-grant>(<mit-keep>)?(<mit-asis>)?(<mit-liable>)?"),
    ("MIT", f"{_NOTICE}(<mit-short>|<spdx-mit>)"),
    ("ISC", f"{_NOTICE}(<isc-grant>(<isc-asis>)?|<spdx-isc>)"),
    ("BSD-3-Clause", f"{_NOTICE}<bsd-grant><bsd-source><bsd-binary><bsd-endorse>(<bsd-asis>)?(<bsd-liable>)?"),
    ("BSD-2-Clause", f"{_NOTICE}<bsd-grant><bsd-source><bsd-binary>(<bsd-asis>)?(<bsd-liable>)?"),
    ("BSD-3-Clause", "<spdx-bsd3>"),
    ("BSD-2-Clause", "<spdx-bsd2>"),
    ("GPL-3.0-or-later", f"{_NOTICE}<gpl-terms><gpl-later3>(<gpl-hope>)?(<gpl-copy>)?"),
    ("GPL-2.0-or-later", f"{_NOTICE}<gpl-terms><gpl-later2>(<gpl-hope>)?(<gpl-copy>)?"),
    ("GPL", f"{_NOTICE}<gpl-terms>(<gpl-hope>)?(<gpl-copy>)?"),
    ("LGPL", f"{_NOTICE}(<lgpl-terms>(<gpl-later2>|<gpl-later3>)?(<gpl-hope>)?(<gpl-copy>)?|<lgpl-short>|<spdx-lgpl>)"),
    ("AGPL-3.0", f"{_NOTICE}(<agpl-terms>(<gpl-later3>)?(<gpl-hope>)?(<gpl-copy>)?|<agpl-short>|<spdx-agpl3>)"),
    ("GPL-3.0", f"{_NOTICE}(<gpl3-short>|<spdx-gpl3>)"),
    ("GPL-2.0", f"{_NOTICE}(<gpl2-short>|<spdx-gpl2>)"),
    ("MPL-2.0", f"{_NOTICE}(<mpl2-short>|<spdx-mpl2>)"),
    ("CC-BY-NC-4.0", f"{_NOTICE}<cc-by-nc>"),
    ("CC-BY-SA-4.0", f"{_NOTICE}<cc-by-sa>"),
    ("CC-BY-4.0", f"{_NOTICE}<cc-by>"),
    ("CC0-1.0", "<cc0>"),
    ("Unlicense", "<unlicense>"),
    ("Zlib", f"{_NOTICE}<zlib-grant>"),
    ("Proprietary", "(<copyright>)+<reserved>"),
]


def sentences(text: Column) -> Column:
    """Normalised sentences of the text, with a space at both ends."""
    plain = F.transform(F.split(text, RAW_BREAK, -1), lambda s: F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(s, frames.UPPER, frames.LOWER), "[^a-z0-9]+", " ")), F.lit(" ")))
    return F.when(text.rlike(RAW_HINT), plain).otherwise(F.array().cast("array<string>"))


def _places(sentence: Column, pattern: Column) -> Column:
    """Where the matches of a pattern start."""
    between, found = F.split(sentence, pattern, -1), F.regexp_extract_all(sentence, pattern, F.lit(0))
    length = lambda parts, n: F.aggregate(F.slice(parts, 1, n), F.lit(0), lambda total, x: total + F.length(x))
    return F.transform(found, lambda m, i: length(between, i + 1) + length(found, i) + 1)


def identifiers(sentence: Column) -> Column:
    """Identifiers of the known sentences inside one, each as often as it stands there, by place, then by name."""
    known = F.array(*[F.struct(F.regexp_instr(sentence, F.lit(f" {p} ")).alias("at"), F.lit(name).alias("name"), F.lit(f" {p}(?= )").alias("pattern")) for name, p in SENTENCES.items()])
    found = F.filter(known, lambda k: k["at"] > 0)
    each = F.flatten(F.transform(found, lambda k: F.transform(_places(sentence, k["pattern"]), lambda at: F.struct(at.alias("at"), k["name"].alias("name")))))
    return F.transform(F.array_sort(each), lambda k: k["name"])


def licences(docs: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per row: doc_id, sentences (identifiers in order), licences (names in order), unmatched (identifiers that no rule took)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), sentences(F.col("text").cast("string")).alias("own"))
    worth = F.filter("own", lambda s: s.rlike(HINT))
    rows = rows.select("doc_id", F.flatten(F.transform(worth, identifiers)).alias("sentences"))
    sequence = F.concat_ws("", F.transform("sentences", lambda s: F.concat(F.lit("<"), s, F.lit(">"))))
    for name, rule in rules or RULES:
        sequence = F.regexp_replace(sequence, rule, f"#{name};")
    rows = rows.withColumn("_left", sequence)
    taken = F.regexp_extract_all(F.col("_left"), F.lit("#([^;]+);"), F.lit(1))
    rest = F.regexp_extract_all(F.col("_left"), F.lit("<([^>]+)>"), F.lit(1))
    return rows.select("doc_id", "sentences", taken.alias("licences"), rest.alias("unmatched"))


def sql(rules: list[tuple[str, str]] | None = None) -> str:
    """The same for DuckDB, lists joined by commas."""
    folded = f"translate(coalesce(text, ''), '{frames.UPPER}', '{frames.LOWER}')"
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    # Without look-behind: the character after a tag is blanked, so no sentence ends there.
    joined = f"regexp_replace({folded}, '(spdx-license-identifier)[.!?;:\\n]', '\\1 ', 'g')"

    def places(name: str, pattern: str) -> str:
        """Matches of one sentence. Without look-ahead: spaces are doubled, so neighbours need not share one."""
        p = quoted(f" {pattern} ".replace(" ", "  ")[1:-1])
        length = lambda parts, upto: f"coalesce(list_sum(list_transform({parts}[1:{upto}], lambda x: length(x))), 0)"
        at = length(f"string_split_regex(d, {p})", "i") + " + " + length(f"regexp_extract_all(d, {p}, 0)", "i - 1")
        return f"CASE WHEN regexp_matches(d, {p}) THEN list_transform(regexp_extract_all(d, {p}, 0), lambda m, i: {{'at': ({at})::BIGINT, 'name': {quoted(name)}}}) ELSE [] END"

    known = ", ".join(places(n, p) for n, p in SENTENCES.items())
    left = "array_to_string(list_transform(ids, lambda x: '<' || x || '>'), '')"
    for name, rule in rules or RULES:
        left = f"regexp_replace({left}, {quoted(rule)}, {quoted(f'#{name};')}, 'g')"
    return f"""
WITH own AS (
  SELECT doc_id, CASE WHEN regexp_matches(coalesce(text, ''), {quoted(RAW_HINT)})
    THEN list_transform(string_split_regex({joined}, {quoted(BREAK)}), lambda s: ' ' || trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) || ' ') ELSE [] END AS own FROM documents
),
ids AS (SELECT doc_id, flatten(list_transform(list_transform(list_filter(own, lambda s: regexp_matches(s, {quoted(HINT)})), lambda s: replace(s, ' ', '  ')),
  lambda d: list_transform(list_sort(flatten([{known}])), lambda k: k.name))) AS ids FROM own),
taken AS (SELECT doc_id, ids, {left} AS l FROM ids)
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentences, coalesce(array_to_string(regexp_extract_all(l, '#([^;]+);', 1), ','), '') AS licences,
  coalesce(array_to_string(regexp_extract_all(l, '<([^>]+)>', 1), ','), '') AS unmatched
FROM taken
"""
