"""Licence scan in plain Columns: sentences become known identifiers, and sequences of
identifiers are matched against an ordered list of rules."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from culvert.llm.shared import fresh

# Sentences of public licence texts and notices, in normal form.
SENTENCES = [
    ("mit_title", "the mit license mit"),
    ("mit_title", "mit license"),
    ("mit_title", "the mit license"),
    ("mit_grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit_condition", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit_warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit_notice", "released under the mit license"),
    ("mit_notice", "licensed under the mit license"),
    ("mit_notice", "this project is licensed under the mit license"),
    ("apache2_notice", "licensed under the apache license version 2 0"),
    ("apache2_notice", "licensed under the apache license version 2 0 the license"),
    ("apache2_notice", "released under the apache license version 2 0"),
    ("apache2_comply", "you may not use this file except in compliance with the license"),
    ("apache2_copy", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache2_as_is", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl3_notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl3_notice", "licensed under the gnu general public license version 3"),
    ("gpl3_free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl2_free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl21_free", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl3_free", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl3_free", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl3_free", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("mpl2_terms", "this source code form is subject to the terms of the mozilla public license v"),
    ("mpl2_copy", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("mpl2_copy", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    ("isc_grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc_grant", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("epl2_terms", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    ("epl2_terms", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at http www eclipse org legal epl 2 0"),
    ("epl2_terms", "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at https www eclipse org legal epl 2 0"),
    ("unlicense_text", "this is free and unencumbered software released into the public domain"),
    ("gpl_hope", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl_details", "see the gnu general public license for more details"),
    ("bsd_grant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd_source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd_binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd_names", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("cc_by_nc_notice", "licensed under cc by nc 4 0"),
    ("cc_by_nc_notice", "this work is licensed under cc by nc 4 0"),
    ("cc_by_nc_notice", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc_by_sa_notice", "licensed under cc by sa 4 0"),
    ("cc_by_sa_notice", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc_by_notice", "licensed under cc by 4 0"),
    ("cc_by_notice", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0_notice", "released under cc0 1 0"),
    ("reserved", "all rights reserved"),
]

# Identifiers that a line "SPDX-License-Identifier: ..." may name, with their kind.
SPDX = [
    ("MIT", "permissive"),
    ("Apache-2.0", "permissive"),
    ("BSD-2-Clause", "permissive"),
    ("BSD-3-Clause", "permissive"),
    ("ISC", "permissive"),
    ("Unlicense", "permissive"),
    ("CC0-1.0", "permissive"),
    ("CC-BY-4.0", "permissive"),
    ("CC-BY-SA-4.0", "copyleft"),
    ("CC-BY-NC-4.0", "restricted"),
    ("MPL-2.0", "copyleft"),
    ("EPL-2.0", "copyleft"),
    ("GPL-2.0-only", "copyleft"),
    ("GPL-2.0-or-later", "copyleft"),
    ("GPL-3.0-only", "copyleft"),
    ("GPL-3.0-or-later", "copyleft"),
    ("LGPL-2.1-only", "copyleft"),
    ("LGPL-2.1-or-later", "copyleft"),
    ("LGPL-3.0-only", "copyleft"),
    ("LGPL-3.0-or-later", "copyleft"),
    ("AGPL-3.0-only", "copyleft"),
    ("AGPL-3.0-or-later", "copyleft"),
]
SENTENCES += [
    (f"spdx_{name}", "spdx license identifier " + re.sub("[^a-z0-9]+", " ", name.lower())) for name, _ in SPDX
]

# Rules in order. A rule that matches takes its identifiers away from
# the rules behind it, so a whole text goes before the notices it contains.
RULES = [
    ("MIT", "permissive", ["mit_title", "mit_grant", "mit_condition", "mit_warranty"]),
    ("MIT", "permissive", ["mit_grant", "mit_condition", "mit_warranty"]),
    ("MIT", "permissive", ["mit_grant", "mit_condition"]),
    ("Apache-2.0", "permissive", ["apache2_notice", "apache2_comply", "apache2_copy", "apache2_as_is"]),
    ("Apache-2.0", "permissive", ["apache2_notice", "apache2_comply"]),
    ("GPL-3.0-or-later", "copyleft", ["gpl3_free", "gpl_hope", "gpl_details"]),
    ("GPL-3.0-or-later", "copyleft", ["gpl3_free"]),
    ("GPL-2.0-or-later", "copyleft", ["gpl2_free", "gpl_hope", "gpl_details"]),
    ("GPL-2.0-or-later", "copyleft", ["gpl2_free"]),
    ("BSD-3-Clause", "permissive", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"]),
    ("BSD-2-Clause", "permissive", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("MIT", "permissive", ["mit_notice"]),
    ("MIT", "permissive", ["mit_title"]),
    ("Apache-2.0", "permissive", ["apache2_notice"]),
    ("GPL-3.0-only", "copyleft", ["gpl3_notice"]),
    ("CC-BY-NC-4.0", "restricted", ["cc_by_nc_notice"]),
    ("CC-BY-SA-4.0", "copyleft", ["cc_by_sa_notice"]),
    ("CC-BY-4.0", "permissive", ["cc_by_notice"]),
    ("CC0-1.0", "permissive", ["cc0_notice"]),
    ("LGPL-2.1-or-later", "copyleft", ["lgpl21_free"]),
    ("LGPL-3.0-or-later", "copyleft", ["lgpl3_free"]),
    ("AGPL-3.0-or-later", "copyleft", ["agpl3_free"]),
    ("MPL-2.0", "copyleft", ["mpl2_terms"]),
    ("ISC", "permissive", ["isc_grant"]),
    ("EPL-2.0", "copyleft", ["epl2_terms"]),
    ("Unlicense", "permissive", ["unlicense_text"]),
    *((name, kind, [f"spdx_{name}"]) for name, kind in SPDX),
]

#: What counts only where no rule in front of it does: most licensed texts reserve rights, too.
LAST_RULE = ("proprietary", "restricted", ["reserved"])
RULES.append(LAST_RULE)

#: What opens a line of a comment.
_LEADER = r"(?md)^[ \t]*(?:/\*+|\*+/?|#+|//+)[ \t]*"
#: Cuts of a text, from the surest to the least sure: the end of a sentence, that is a mark
#: with blanks or a line end behind it, or an empty line unless an address follows; any empty
#: line; the end of a clause; the end of a line.
_SENTENCE = r"([.!?])[ \t\n]+|\n[ \t]*\n(?![ \t\n]*+https?://)"
_EMPTY = r"()\n[ \t]*\n"
_CLAUSE = r"([:;])[ \t\n]+"
_LINE = r"()\n"
_SPLIT = "\x01"


def normal_form(text: Column) -> Column:
    """Lower case; every run of other characters than a-z and 0-9 is one blank."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def _known(sentences: Sequence[tuple[str, str]]) -> Column:
    pairs = [F.lit(x) for name, text in sentences for x in (text, name)]
    return F.create_map(*pairs)


def sentence_ids(text: Column, sentences: Sequence[tuple[str, str]] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in order.

    A sentence may run over line ends, ``;`` and ``:``, and an empty line in front of an
    address. One that is unknown as a whole is cut further, clause by clause and line by
    line, since notices stand on lines of their own behind unfinished prose. Line ends are
    those of any system; what opens the lines of a comment is no part of the text.
    """
    known = _known(sentences)
    look_up = lambda part: F.element_at(known, normal_form(part))

    def cut(part: Column, ends: str) -> Column:
        return F.split(F.regexp_replace(part, ends, f"$1{_SPLIT}"), _SPLIT)

    # A part is (text, name). Level by level, unknown parts are replaced by smaller ones.
    def named(texts: Column) -> Column:
        return F.transform(
            texts, lambda x: F.struct(x.alias("part"), look_up(x).alias("name"))
        )

    def smaller(parts: Column, ends: str) -> Column:
        def of(x: Column) -> Column:
            unknown = x["name"].isNull() & x["part"].rlike(ends)
            return F.when(unknown, named(cut(x["part"], ends))).otherwise(F.array(x))

        return F.flatten(F.transform(parts, of))

    plain = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), _LEADER, "")
    parts = named(cut(plain, _SENTENCE))
    for ends in (_EMPTY, _CLAUSE, _LINE):
        parts = smaller(parts, ends)
    return F.filter(F.transform(parts, lambda x: x["name"]), lambda x: x.isNotNull())


def matched_rules(ids: Column, rules: Sequence[tuple[str, str, list[str]]] = RULES) -> Column:
    """Array of (rule, licence, kind) in rule order; identifiers match once."""
    left = F.concat(F.lit("|"), F.array_join(ids, "||"), F.lit("|"))
    found = []
    for number, (licence, kind, sequence) in enumerate(rules):
        wanted = "".join(f"|{name}|" for name in sequence)
        found.append(
            F.when(
                F.contains(left, F.lit(wanted)),
                F.struct(
                    F.lit(number).alias("rule"),
                    F.lit(licence).alias("licence"),
                    F.lit(kind).alias("kind"),
                ),
            )
        )
        left = F.replace(left, F.lit(wanted), F.lit("/"))
    all_found = F.filter(F.array(*found), lambda x: x.isNotNull())
    last = [number for number, rule in enumerate(rules) if rule == LAST_RULE]
    if not last:
        return all_found
    others = F.filter(all_found, lambda x: x["rule"] != last[0])
    return F.when(F.size(others) > 0, others).otherwise(all_found)


def scan(
    docs: DataFrame,
    sentences: Sequence[tuple[str, str]] = SENTENCES,
    rules: Sequence[tuple[str, str, list[str]]] = RULES,
) -> DataFrame:
    """Every row of ``docs`` with ``licence_ids`` (identifiers in text order), ``licences``
    (distinct, in rule order), ``licence_rules`` (rule numbers) and ``licence_kind``:
    the strictest kind found, or null.

    Row by row, no shuffle; the lists of sentences and rules are literals of the plan.
    A null or empty text has no identifiers. Repeated rows are scanned each; own columns
    of these names are replaced. A text of any length is scanned whole, in one row. An empty
    table gives an empty result.
    """
    ids, found = fresh("ids"), fresh("found")
    kinds = F.transform(F.col(found), lambda x: x["kind"])
    strictest = F.coalesce(
        *[
            F.when(F.array_contains(kinds, kind), F.lit(kind))
            for kind in ("restricted", "copyleft", "permissive")
        ]
    )
    return (
        docs.withColumn(ids, sentence_ids(F.coalesce("text", F.lit(""))))
        .withColumn(found, F.when(F.size(ids) > 0, matched_rules(F.col(ids))).otherwise(F.array()))
        .withColumns(
            {
                "licence_ids": F.col(ids),
                "licences": F.array_distinct(F.transform(F.col(found), lambda x: x["licence"])),
                "licence_rules": F.transform(F.col(found), lambda x: x["rule"]),
                "licence_kind": strictest,
            }
        )
        .drop(ids, found)
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle(sentences=SENTENCES, rules=RULES) -> str:
    """DuckDB SQL for ``op9_licence_scan``."""
    known = ", ".join(f"({_quoted(text)}, {_quoted(name)})" for name, text in sentences)
    steps, left = [], "'|' || array_to_string(ids, '||') || '|'"
    flags, lefts = [], []
    for number, (_, _, sequence) in enumerate(rules):
        wanted = _quoted("".join(f"|{name}|" for name in sequence))
        before = "l" if number == 0 else f"l{number - 1}"
        found = f"contains({before}, {wanted})"
        if rules[number] == LAST_RULE:
            found = " AND NOT ".join([found, *(f"f{i}" for i in range(number))])
        flags.append(f"{found} AS f{number}")
        lefts.append(f"replace({before}, {wanted}, '/') AS l{number}")
        source = "start" if number == 0 else f"s{number - 1}"
        steps.append(f"s{number} AS (SELECT *, {flags[-1]}, {lefts[-1]} FROM {source})")
    last = f"s{len(rules) - 1}"
    licence = ", ".join(f"CASE WHEN f{i} THEN {_quoted(r[0])} END" for i, r in enumerate(rules))
    numbers = ", ".join(f"CASE WHEN f{i} THEN {i} END" for i in range(len(rules)))
    has = lambda kind: " OR ".join(f"f{i}" for i, r in enumerate(rules) if r[1] == kind)
    norm = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
    # An empty line in front of an address is marked by chr(2), and cuts only at the second level.
    levels = [
        r"([.!?])[ \t\n\x02]+|\n[ \t]*\n",
        r"()(?:\n[ \t]*\n|\x02)",
        r"([:;])[ \t\n\x02]+",
        r"()[\n\x02]",
    ]
    cuts = []
    for k, ends in enumerate(levels):
        source = "plain" if k == 0 else f"named{k - 1}"
        cuts.append(f"""
parts{k} AS (
  SELECT doc_id, list_append(path, generate_subscripts(s, 1)) AS path, unnest(s) AS part FROM (
    SELECT doc_id, path, CASE WHEN name IS NULL THEN
      string_split(regexp_replace(part, '{ends}', '\\1' || chr(1), 'g'), chr(1)) ELSE [part] END AS s FROM {source})),
named{k} AS (SELECT doc_id, path, part, name FROM parts{k} LEFT JOIN known ON sentence = {norm.format("part")})""")
    return f"""
WITH known(sentence, name) AS (VALUES {known}),
plain AS (
  SELECT doc_id, CAST([] AS BIGINT[]) AS path, CAST(NULL AS VARCHAR) AS name,
    regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'),
      '(?m)^[ \\t]*(?:/\\*+|\\*+/?|#+|//+)[ \\t]*', '', 'g'),
      '\\n[ \\t]*\\n[ \\t\\n]*(https?://)', chr(2) || '\\1', 'g') AS part
  FROM documents),{",".join(cuts)},
start AS (
  SELECT d.doc_id, coalesce(h.ids, []) AS ids, {left.replace("ids", "coalesce(h.ids, [])")} AS l
  FROM documents d LEFT JOIN (
    SELECT doc_id, list(name ORDER BY path) AS ids FROM named3 WHERE name IS NOT NULL GROUP BY doc_id) h
  ON d.doc_id = h.doc_id),
{", ".join(steps)},
named AS (
  SELECT doc_id, ids, list_filter([{licence}], lambda x: x IS NOT NULL) AS names,
    list_filter([{numbers}], lambda x: x IS NOT NULL) AS rules,
    CASE WHEN {has("restricted")} THEN 'restricted' WHEN {has("copyleft")} THEN 'copyleft'
      WHEN {has("permissive")} THEN 'permissive' END AS licence_kind FROM {last})
SELECT doc_id, array_to_string(ids, ',') AS licence_ids,
  array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ',') AS licences,
  array_to_string(rules, ',') AS licence_rules, licence_kind FROM named
"""
