"""Licence scans by sentence rules.

A text becomes a sequence of normalised sentences (split at line ends and at
sentence marks before white space; lower case; runs of anything but a-z and 0-9
become one space).  Lines up to the next sentence mark, blank line or colon at a
line's end are also joined: if that is a known sentence, wrapped, it counts
instead of its lines.  If it is none, it is cut before the openings of long known
sentences, so that a title or copyright line in front does not hide one.  Known
sentences map to identifiers, unknown ones drop out, and the sequence of
identifiers is matched against licence rules in order; a match uses its
identifiers up, so that a longer licence goes before one that it contains.

The tables are parameters.  ``learn`` makes them from whole licence texts (such
as a folder of published ones): the sentences that a text keeps however its
lines are wrapped, and for each licence the sequence of those that no other has.

Only DataFrame functions are used, row by row without a shuffle, so copies and
hot sources cost no more than other rows.

The SQL looks up single lines and ``SENTENCES`` only; the driver's tables hold no
wrapped licences, so both agree there.

Defined results: null and empty texts have no sentences and no licence; a
licence found several times counts once; an empty table gives no rows; other
columns pass through, and the four result names win over clashing ones.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, table

#: Normalised licence sentences and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache2-ref",
    "this project is licensed under the apache license version 2 0": "apache2-ref",
    "licensed under the apache license version 2 0 the license": "apache2-grant",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at": "apache2-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2-asis",
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "this project is licensed under the mit license": "mit-ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied": "mit-asis",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "licensed under the gnu general public license version 3": "gpl3-ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-grant",
    "either version 3 of the license or at your option any later version": "gpl3-later",
    "either version 2 of the license or at your option any later version": "gpl2-later",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl-hope",
    "licensed under the gnu lesser general public license version 3": "lgpl3-ref",
    "licensed under the gnu affero general public license version 3": "agpl3-ref",
    "licensed under cc by nc 4 0": "ccbync4-ref",
    "licensed under cc by 4 0": "ccby4-ref",
    "licensed under cc by sa 4 0": "ccbysa4-ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby4-ref",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "ccbysa4-ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccbync4-ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-ref",
    "licensed under the mozilla public license version 2 0": "mpl2-ref",
    "this is free and unencumbered software released into the public domain": "unlicense-ref",
    "all rights reserved": "all-rights",
    "spdx license identifier apache 2 0": "apache2-ref",
    "spdx license identifier mit": "mit-ref",
    "spdx license identifier gpl 3 0 only": "gpl3-ref",
    "spdx license identifier gpl 3 0 or later": "gpl3-ref",
    "spdx license identifier bsd 3 clause": "bsd3-ref",
    "spdx license identifier bsd 2 clause": "bsd2-ref",
    "spdx license identifier cc by 4 0": "ccby4-ref",
    "spdx license identifier cc by nc 4 0": "ccbync4-ref",
    "spdx license identifier mpl 2 0": "mpl2-ref",
}

_GPL = "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"
#: Published sentences that go on after those above, and their identifiers.
PUBLISHED = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-asis",
    f"this program is free software {_GPL} either version 3 of the license or at your option any later version": "gpl-grant gpl3-later",
    f"this program is free software {_GPL} either version 2 of the license or at your option any later version": "gpl-grant gpl2-later",
    _GPL: "gpl-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1": "bsd-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-grant",
    "neither the name of copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "you or your shall mean an individual or legal entity exercising permissions granted by this license": "apache2-you",
    "you are solely responsible for determining the appropriateness of using or redistributing the work and assume any risks associated with your exercise of permissions under this license": "apache2-risk",
    "the gnu general public license is a free copyleft license for software and other kinds of works": "gpl3-kind",
    "by contrast the gnu general public license is intended to guarantee your freedom to share and change all versions of a program to make sure it remains free software for all its users": "gpl3-contrast",
    "by contrast the gnu general public license is intended to guarantee your freedom to share and change free software to make sure the software is free for all its users": "gpl2-contrast",
    "this general public license applies to most of the free software foundation s software and to any other program whose authors commit to using it": "gpl2-applies",
    "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions listed below": "lgpl3-terms",
    "the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community in the case of network server software": "agpl3-kind",
    "contributor means each individual or legal entity that creates contributes to the creation of or owns covered software": "mpl2-contributor",
    "mozilla foundation is the license steward": "mpl2-steward",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-notice",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl2-copy",
}
_MIT_GRANT, _MIT_NOTICE = list(PUBLISHED)[0], "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
PUBLISHED[f"{_MIT_GRANT} {_MIT_NOTICE}"] = "mit-grant mit-notice"  # on one line no colon ends the first

#: Ordered rules: licence, class, and the pattern of its identifiers (each followed by one space).
RULES = [
    ("BSD-3-Clause", "permissive", r"(all-rights )?bsd-grant bsd-source bsd-binary bsd-endorse |bsd3-ref "),
    ("BSD-2-Clause", "permissive", r"(all-rights )?bsd-grant bsd-source bsd-binary |bsd2-ref "),
    ("Apache-2.0", "permissive", r"apache2-you apache2-risk (apache2-grant apache2-comply (apache2-copy )?(apache2-asis )?)?|apache2-grant apache2-comply (apache2-copy )?(apache2-asis )?|apache2-ref "),
    ("MIT", "permissive", r"(all-rights )?mit-grant mit-notice (mit-asis )?|mit-ref "),
    ("ISC", "permissive", r"(all-rights )?isc-grant "),
    ("AGPL-3.0", "copyleft", r"agpl3-kind (gpl3-contrast )?|agpl3-ref "),
    ("LGPL-3.0", "copyleft", r"lgpl3-terms |lgpl3-ref "),
    ("GPL-3.0", "copyleft", r"gpl3-kind gpl3-contrast (gpl-grant gpl3-later (gpl-hope )?)?|gpl-grant gpl3-later (gpl-hope )?|gpl3-ref "),
    ("GPL-2.0", "copyleft", r"gpl2-contrast gpl2-applies (gpl-grant gpl2-later (gpl-hope )?)?|gpl-grant gpl2-later (gpl-hope )?"),
    ("MPL-2.0", "copyleft", r"mpl2-contributor (mpl2-steward )?(mpl2-notice )?(mpl2-copy )?|mpl2-notice (mpl2-copy )?|mpl2-ref "),
    ("CC-BY-SA-4.0", "copyleft", r"ccbysa4-ref "),
    ("CC-BY-NC-4.0", "noncommercial", r"ccbync4-ref "),
    ("CC-BY-4.0", "permissive", r"ccby4-ref "),
    ("Unlicense", "permissive", r"unlicense-ref (unlicense-grant )?|unlicense-grant "),
    ("Proprietary", "restricted", r"all-rights "),
]

_MARKS = r"[.!?;]+([ \t\r\n]|\z)"
_OTHER = r"[^a-z0-9\n]+"
#: Known sentences of so many words or more are found behind other text of their passage, by their first words.
LONG, OPENING = 12, 4
#: What a passage has at least before it is searched for openings.
_HINT = r"licen[cs]e|permi|redistribut|warrant|free software|mozilla|unencumbered|copy "


def passages(text: Column) -> Column:
    """The normalised text up to each sentence mark, blank line or colon at a line's end; line ends inside are kept."""
    marked = F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), _MARKS, "\n\n")
    return F.split(F.regexp_replace(F.regexp_replace(marked, ":[ \t\r]*\n", "\n\n"), _OTHER, " "), "(?: ?\n ?){2,}")


def openings(known: dict[str, str]) -> str:
    """A pattern of the first words of the long known sentences."""
    found = sorted({" ".join(k.split(" ")[:OPENING]) for k in known if len(k.split(" ")) >= LONG}, key=lambda x: (-len(x), x))
    return "(?:^| )(" + "|".join(found) + r")(?= |$)" if found else r"(?!)()"


def scan(docs: DataFrame, text: str = "text", known: dict[str, str] | None = None, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """``docs`` with n_sentences, sentence_ids, licenses and license_classes (arrays, in rule order) behind its own columns.

    ``known``: normalised sentence -> identifiers (by spaces); ``rules``: see ``RULES``; both go into the plan as literals.
    """
    known, rules = known or SENTENCES | PUBLISHED, rules or RULES
    made = ["n_sentences", "sentence_ids", "licenses", "license_classes"]
    parts, rest, hits = fresh(docs, "parts", "rest", "hits")
    lookup = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    opening = openings(known)
    lines = lambda p: F.filter(F.transform(F.split(p, "\n"), lambda s: F.trim(s)), lambda s: s != "")
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made], F.transform(passages(F.col(f"`{text}`")), lines).alias(parts))

    def each(sentences: Column) -> Column:
        return F.array_compact(F.transform(sentences, lambda s: F.element_at(lookup, s)))

    def ids(p: Column) -> Column:
        joined = F.array_join(p, " ")
        whole = F.element_at(lookup, joined)
        cut = F.when(joined.rlike(_HINT) & joined.rlike(opening), each(F.transform(F.split(F.regexp_replace(joined, opening, "\n$1"), "\n"), lambda s: F.trim(s))))
        return F.when(whole.isNotNull(), F.array(whole)).when(F.size(F.coalesce(cut, F.array().cast("array<string>"))) > 0, cut).when(F.size(p) > 1, each(p)).otherwise(F.array().cast("array<string>"))

    out = out.withColumn("n_sentences", F.size(F.flatten(parts)).cast("bigint")).withColumn("sentence_ids", F.flatten(F.transform(F.flatten(F.transform(parts, ids)), lambda x: F.split(x, " ")))).drop(parts)
    out = out.withColumn(rest, F.when(F.size("sentence_ids") > 0, F.concat(F.array_join("sentence_ids", " "), F.lit(" "))).otherwise("")).withColumn(hits, F.array().cast("array<int>"))
    for i, (_, _, pattern) in enumerate(rules):
        whole = rf"(^| )(?:{pattern})"
        out = out.withColumn(hits, F.when(F.col(rest).rlike(whole), F.concat(hits, F.array(F.lit(i)))).otherwise(F.col(hits))).withColumn(rest, F.regexp_replace(rest, whole, "$1"))
    names, classes = (F.array(*[F.lit(r[k]) for r in rules]) for k in (0, 1))
    out = out.withColumn("licenses", F.transform(hits, lambda i: F.get(names, i))).withColumn("license_classes", F.array_distinct(F.transform(hits, lambda i: F.get(classes, i))))
    return out.drop(rest, hits)


def sentences(text: str) -> list[str]:
    """The joined passages of one text that end at a sentence mark: what ``scan`` sees of it."""
    marked = re.sub(r"[.!?;]+([ \t\r\n]|\Z)", "\1\n\n", text.lower())
    split = re.split("(?: ?\n ?){2,}", re.sub(r"[^a-z0-9\n\1]+", " ", re.sub(":[ \t\r]*\n", "\n\n", marked)))
    return [" ".join(x.rstrip("\1 ").split()) for x in split if x.endswith("\1")]


def learn(texts: dict[str, tuple[str, str]], least_words: int = 8) -> tuple[dict[str, str], list[tuple[str, str, str]]]:
    """(known sentences, rules) from whole licence texts: licence -> (class, text), longer licences first.

    A sentence counts if it is the same in the text as it is, with every paragraph on one line, and has ``least_words``.
    A licence is matched by the sentences that only it has, in order; a licence without any gets no rule.
    """
    own: dict[str, list[str]] = {}
    for name, (_, text) in texts.items():
        plain = {" ".join(x.split()) for x in sentences("\n\n".join(" ".join(p.split()) for p in re.split(r"\n[ \t\r]*\n", text)))}
        own[name] = list(dict.fromkeys(x for x in sentences(text) if x in plain and len(x.split()) >= least_words))
    seen: dict[str, int] = {}
    for found in own.values():
        for x in found:
            seen[x] = seen.get(x, 0) + 1
    known, rules = {}, []
    for name, found in own.items():
        slug = re.sub("[^a-z0-9]+", "-", name.lower())
        mine = [x for x in found if seen[x] == 1]
        known |= {x: f"{slug}-{i}" for i, x in enumerate(mine)}
        if mine:
            rules.append((name, texts[name][0], "".join(f"{slug}-{i} " for i in range(len(mine)))))
    return known, sorted(rules, key=lambda r: -r[2].count(" "))


def op5_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: the licences of all documents."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"), F.size("licenses").cast("bigint").alias("n_licenses"))


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def oracle() -> str:
    """The same in DuckDB SQL: the rules applied one after another."""
    known = ", ".join(f"({_sql_text(s)}, {_sql_text(i)})" for s, i in SENTENCES.items())
    steps, at = [], "base"
    for i, (_, _, pattern) in enumerate(RULES):
        whole = _sql_text(rf"(^| )(?:{pattern})")
        steps.append(f"r{i} AS (SELECT * EXCLUDE (rest), regexp_matches(rest, {whole}) AS m{i}, regexp_replace(rest, {whole}, '\\1', 'g') AS rest FROM {at})")
        at = f"r{i}"
    names = ", ".join(f"CASE WHEN m{i} THEN {_sql_text(n)} END" for i, (n, _, _) in enumerate(RULES))
    found = f"list_filter([{names}], lambda x: x IS NOT NULL)"
    return rf"""
WITH k(sentence, id) AS (VALUES {known}),
s AS (SELECT doc_id, generate_subscripts(parts, 1) AS pos, trim(unnest(parts)) AS sentence FROM (
  SELECT doc_id, regexp_split_to_array(regexp_replace(regexp_replace(lower(coalesce(text, '')), {_sql_text(_MARKS)}, chr(10), 'g'), {_sql_text(_OTHER)}, ' ', 'g'), ' ?' || chr(10) || ' ?') AS parts FROM documents)),
base AS (SELECT doc_id, count(*) FILTER (WHERE s.sentence <> '') AS n_sentences,
  coalesce(string_agg(k.id, ',' ORDER BY pos), '') AS sentence_ids, coalesce(string_agg(k.id || ' ', '' ORDER BY pos), '') AS rest
  FROM s LEFT JOIN k ON s.sentence = k.sentence GROUP BY doc_id),
{", ".join(steps)}
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, sentence_ids,
       array_to_string({found}, ',') AS licenses, CAST(len({found}) AS BIGINT) AS n_licenses
FROM {at}
"""


OP5_SQL = oracle()
