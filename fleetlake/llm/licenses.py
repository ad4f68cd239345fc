"""Licence recognition by sentence rules, in DataFrame functions only.

Known sentences that a text wraps are put on one line first, wherever their lines break and whatever
comment marks begin them. Then the text is split into sentences, these are normalised (case, blanks,
quotes, leading comment marks, the holder of a copyright) and looked up among known licence sentences. The identifiers found, in
text order, form a sequence that is matched against ordered rules: a rule is a run of identifiers,
longer rules come first, and the identifiers a rule has used up count for no later one. What no rule
explains stays visible as ``unmatched``; sentences that speak of licences but are not known are counted.

One row per row of the input; null texts count as empty; ids may be null or repeat; other columns
are ignored. Every text is read whole. Nothing is shuffled: all of it happens inside a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import documents

# Known sentences in normalised form and their identifiers.
SENTENCES = {
    "licensed under the apache license, version 2.0": "ApacheRef",
    "licensed under the apache license, version 2.0 (the license)": "ApacheRef",
    "released under the apache license, version 2.0": "ApacheRef",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "you may obtain a copy of the license at http://www.apache.org/licenses/license-2.0": "ApacheCopy",
    "unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis, without warranties or conditions of any kind, either express or implied": "AsIsBasis",
    "see the license for the specific language governing permissions and limitations under the license": "SeeLicense",
    "released under the mit license": "MITRef",
    "licensed under the mit license": "MITRef",
    "this software is released under the mit license": "MITRef",
    "the asf licenses this file to you under the apache license, version 2.0 (the license)": "ApacheRef",
    "apache license version 2.0, january 2004": "ApacheTitle",
    "licensed to the apache software foundation (asf) under one or more contributor license agreements": "ASFGrant",
    "see the notice file distributed with this work for additional information regarding copyright ownership": "ASFNotice",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the software), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions": "MITGrant",
    "the software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement": "AsIs",
    "in no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software": "MITLiability",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the software), to deal in the software without restriction": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITNotice",
    "the software is provided as is, without warranty of any kind, express or implied": "AsIs",
    "this work is licensed under the gnu general public license, version 3": "GPL3Ref",
    "this work is licensed under the gnu general public license, version 2": "GPL2Ref",
    "licensed under the gnu general public license, version 3": "GPL3Ref",
    "licensed under the gnu general public license, version 2": "GPL2Ref",
    "this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version": "GPL3Plus",
    "this program is free software; you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation; either version 2 of the license, or (at your option) any later version": "GPL2Plus",
    "this program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose": "GPLWarranty",
    "see the gnu general public license for more details": "GPLSee",
    "gnu general public license version 3, 29 june 2007": "GPL3Title",
    "gnu general public license version 2, june 1991": "GPL2Title",
    "you should have received a copy of the gnu general public license along with this program": "GPLCopy",
    "if not, see <https://www.gnu.org/licenses/>": "GPLAddress",
    "if not, see <http://www.gnu.org/licenses/>": "GPLAddress",
    "you should have received a copy of the gnu general public license along with this program; if not, see <https://www.gnu.org/licenses/>": "GPLWrite",
    "you should have received a copy of the gnu general public license along with this program; if not, write to the free software foundation, inc., 51 franklin street, fifth floor, boston, ma 02110-1301 usa": "GPLWrite",
    "you should have received a copy of the gnu general public license along with this program; if not, write to the free software foundation, inc., 51 franklin street, fifth floor, boston, ma 02110-1301, usa": "GPLWrite",
    "you should have received a copy of the gnu general public license along with this program; if not, write to the free software foundation, inc., 59 temple place, suite 330, boston, ma 02111-1307 usa": "GPLWrite",
    "you should have received a copy of the gnu general public license along with this program; if not, write to the free software foundation, inc., 59 temple place - suite 330, boston, ma 02111-1307, usa": "GPLWrite",
    "licensed under cc by-nc 4.0": "CCBYNC4",
    "licensed under cc by 4.0": "CCBY4",
    "licensed under cc by-sa 4.0": "CCBYSA4",
    "this work is licensed under a creative commons attribution 4.0 international license": "CCBY4",
    "this work is licensed under a creative commons attribution-noncommercial 4.0 international license": "CCBYNC4",
    "this work is licensed under a creative commons attribution-sharealike 4.0 international license": "CCBYSA4",
    "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met": "BSDPre",
    "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution": "BSDBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "neither the name of <holder> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "this software is provided by <holder> as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSDAsIs",
    "in no event shall <holder> be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage": "BSDLiability",
    "this library is free software; you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation; either version 2.1 of the license, or (at your option) any later version": "LGPL21Plus",
    "this library is free software: you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version": "LGPL3Plus",
    "this program is free software: you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version": "LGPL3Plus",
    "this program is free software: you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version": "AGPL3Plus",
    "this library is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose": "GPLWarranty",
    "see the gnu lesser general public license for more details": "LGPLSee",
    "see the gnu affero general public license for more details": "AGPLSee",
    "this source code form is subject to the terms of the mozilla public license, v.2.0": "MPL2Subject",
    "if a copy of the mpl was not distributed with this file, you can obtain one at https://mozilla.org/mpl/2.0": "MPL2Copy",
    "if a copy of the mpl was not distributed with this file, you can obtain one at http://mozilla.org/mpl/2.0": "MPL2Copy",
    "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "ISCAsIs",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https://www.eclipse.org/legal/epl-2.0": "EPL2",
    "this is free and unencumbered software released into the public domain": "UnlicenseGrant",
    "to the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "CC0Grant",
    "spdx-license-identifier: mit": "SpdxMIT",
    "spdx-license-identifier: apache-2.0": "SpdxApache2",
    "spdx-license-identifier: gpl-3.0-only": "SpdxGPL3",
    "spdx-license-identifier: gpl-2.0-only": "SpdxGPL2",
    "spdx-license-identifier: bsd-3-clause": "SpdxBSD3",
    "copyright <holder>": "Copyright",
    "all rights reserved": "AllRights",
}

# Identifiers of published licences that a licence expression may name, besides the five above.
SPDX = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Artistic-2.0", "BSD-2-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0",
    "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "GPL-2.0-or-later", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MPL-2.0", "Unlicense", "WTFPL", "Zlib",
)
SPDX_LINE = "spdx-license-identifier: "

# Ordered rules, the licence of each run of identifiers.
RULES = [
    ("LGPL-2.1-or-later", ["LGPL21Plus", "GPLWarranty", "LGPLSee"]),
    ("LGPL-3.0-or-later", ["LGPL3Plus", "GPLWarranty", "LGPLSee"]),
    ("AGPL-3.0-or-later", ["AGPL3Plus", "GPLWarranty", "AGPLSee"]),
    ("MPL-2.0", ["MPL2Subject", "MPL2Copy"]),
    ("ISC", ["ISCGrant", "ISCAsIs"]),
    ("LGPL-2.1-or-later", ["LGPL21Plus"]),
    ("LGPL-3.0-or-later", ["LGPL3Plus"]),
    ("AGPL-3.0-or-later", ["AGPL3Plus"]),
    ("MPL-2.0", ["MPL2Subject"]),
    ("ISC", ["ISCGrant"]),
    ("EPL-2.0", ["EPL2"]),
    ("Unlicense", ["UnlicenseGrant"]),
    ("CC0-1.0", ["CC0Grant"]),
    *[(name, [f"Spdx-{name}"]) for name in SPDX],
    ("BSD-3-Clause", ["Copyright", "AllRights", "BSDPre", "BSDSource", "BSDBinary", "BSDEndorse", "BSDAsIs", "BSDLiability"]),
    ("BSD-3-Clause", ["BSDPre", "BSDSource", "BSDBinary", "BSDEndorse", "BSDAsIs", "BSDLiability"]),
    ("Apache-2.0", ["ASFGrant", "ASFNotice", "ApacheRef", "ApacheComply", "ApacheCopy", "AsIsBasis", "SeeLicense"]),
    ("BSD-2-Clause", ["Copyright", "AllRights", "BSDPre", "BSDSource", "BSDBinary", "BSDAsIs", "BSDLiability"]),
    ("BSD-2-Clause", ["BSDPre", "BSDSource", "BSDBinary", "BSDAsIs", "BSDLiability"]),
    ("Apache-2.0", ["ApacheRef", "ApacheComply", "ApacheCopy", "AsIsBasis", "SeeLicense"]),
    ("BSD-3-Clause", ["BSDPre", "BSDSource", "BSDBinary", "BSDEndorse"]),
    ("BSD-2-Clause", ["BSDPre", "BSDSource", "BSDBinary"]),
    ("GPL-3.0-or-later", ["GPL3Plus", "GPLWarranty", "GPLSee", "GPLCopy", "GPLAddress"]),
    ("GPL-2.0-or-later", ["GPL2Plus", "GPLWarranty", "GPLSee", "GPLCopy", "GPLAddress"]),
    ("GPL-2.0-or-later", ["GPL2Plus", "GPLWarranty", "GPLSee", "GPLWrite"]),
    ("MIT", ["MITGrant", "MITNotice", "AsIs", "MITLiability"]),
    ("MIT", ["MITGrant", "MITNotice", "AsIs"]),
    ("GPL-3.0-or-later", ["GPL3Plus", "GPLWarranty", "GPLSee"]),
    ("GPL-2.0-or-later", ["GPL2Plus", "GPLWarranty", "GPLSee"]),
    ("MIT", ["MITGrant"]),
    ("GPL-3.0-or-later", ["GPL3Plus"]),
    ("GPL-2.0-or-later", ["GPL2Plus"]),
    ("Apache-2.0", ["ApacheRef"]),
    ("Apache-2.0", ["SpdxApache2"]),
    ("Apache-2.0", ["ApacheTitle"]),
    ("MIT", ["MITRef"]),
    ("MIT", ["SpdxMIT"]),
    ("GPL-3.0", ["GPL3Ref"]),
    ("GPL-3.0", ["GPL3Title"]),
    ("GPL-2.0", ["GPL2Title"]),
    ("GPL-3.0", ["SpdxGPL3"]),
    ("GPL-2.0", ["GPL2Ref"]),
    ("GPL-2.0", ["SpdxGPL2"]),
    ("BSD-3-Clause", ["SpdxBSD3"]),
    ("CC-BY-NC-4.0", ["CCBYNC4"]),
    ("CC-BY-SA-4.0", ["CCBYSA4"]),
    ("CC-BY-4.0", ["CCBY4"]),
    ("Proprietary", ["Copyright", "AllRights"]),
]

# Every known sentence has one of these words, so a text without any needs no splitting.
TRIGGER = r"(?i)licens|licenc|permission|unencumbered|mozilla\.org|be liable|warrant|redistribut|copyright|rights reserved|free software|endorse|express or implied"
ABOUT = r"licens|licenc|copyright|spdx"


QUOTES = "[\"'`“”]*"
# Between two words of a sentence: blanks, line ends, comment marks and quotes, with one blank at least.
BETWEEN = r"[\"'`“”]*+\s[\s#*/>;\"'`“”-]*+"
# The name of whoever holds the rights, in the sentences that state it; it may break a line, too, and have full stops.
# Its length has a bound, so that a text that begins such a sentence again and again is still read in linear time.
HOLDER = r"[^;:]{1,400}?"


def wrapped(sentence: str) -> str:
    """Pattern of a sentence in normalised form as it stands in lower-case text, wrapped in any way."""

    def word(w: str) -> str:
        if w == "<holder>":
            return HOLDER
        return "".join(c if c.isalnum() else rf"\{c}{QUOTES}" if c == "(" else rf"{QUOTES}\{c}" for c in w)

    return BETWEEN.join(map(word, sentence.split(" ")))


def folds() -> list[tuple[str, str]]:
    """(pattern, replacement) pairs that put each known sentence of several words on a line."""
    out = [(wrapped(s), s) for s in SENTENCES if s.count(" ") >= 3]
    # One published sentence, known by its halves; they stand apart in the usual layout.
    comply = "you may not use this file except in compliance with the license"
    # This one has a full stop before a blank.
    mozilla = "this source code form is subject to the terms of the mozilla public license, v.2.0"
    first = [(wrapped(f"(the license); {comply}"), f"(the license).\n{comply}"), (wrapped(mozilla.replace("v.2", "v. 2")), mozilla)]
    return [*first, *out]


def sentences(text: Column) -> Column:
    """Sentences of a text, in lower case: a full stop, question or exclamation mark before a blank, or a line's end.

    Semicolons do not end a sentence. Lines that go on in lower case belong to the sentence before,
    unless that ended with a mark. Inside a known sentence every line break is joined, whatever
    follows it; elsewhere a line that begins in upper case is a sentence of its own, so that a
    heading above a licence sentence does not hide it.
    """
    joined = F.lower(F.regexp_replace(text, r"(?<![.!?;:])\n(?=[\t #*/>;-]*+[a-z])", " "))
    for pattern, line in folds():
        joined = F.regexp_replace(joined, pattern, line)
    return F.split(joined, r"\n|(?<=[.!?])[\t ]+", -1)


def normalised(sentence: Column) -> Column:
    """Lower case, without comment marks, quotes and the final stop; one name for any holder."""
    s = F.regexp_replace(F.lower(sentence), "[\"'`“”]", "")
    s = F.regexp_replace(s, r"^[\s#*/>;!-]+|[\s*/.:;!]+$", "")
    s = F.regexp_replace(s, r"\s+[#*/>;]*\s*", " ")
    return F.regexp_replace(s, r"^(?:copyright|\(c\)|©)(?: \(c\)| ©)?(?: [0-9, -]+)?(?: .+)?$", "copyright <holder>")


def identifiers(sentence: Column, known: Column) -> Column:
    """Identifiers of a normalised sentence: its own, or those of the licences that an SPDX expression names.

    An expression keeps its operators to itself: ``MIT OR Apache-2.0`` names two licences.
    """
    spdx = F.create_map(*[F.lit(x) for name in SPDX for x in (name.lower(), f"Spdx-{name}")])
    names = F.regexp_extract_all(F.substring(sentence, F.lit(len(SPDX_LINE) + 1), F.length(sentence)), F.lit(r"([a-z0-9][a-z0-9.+-]*)"), F.lit(1))
    told = F.transform(names, lambda n: F.coalesce(F.element_at(known, F.concat(F.lit(SPDX_LINE), n)), F.element_at(spdx, n)))
    own = F.array(F.element_at(known, sentence))
    return F.filter(F.when(F.startswith(sentence, F.lit(SPDX_LINE)), told).otherwise(own), lambda x: x.isNotNull())


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_known, n_unknown, sentence_ids, licenses and unmatched (comma-joined) per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    split = F.when(F.rlike(text, F.lit(TRIGGER)), F.filter(F.transform(sentences(text), normalised), lambda s: F.rlike(s, F.lit(ABOUT)) | F.rlike(s, F.lit(TRIGGER))))
    rows = docs.select("doc_id", F.inline(F.array(F.struct(F.coalesce(split, F.array().cast("array<string>")).alias("_s")))))
    found = F.transform("_s", lambda s: identifiers(s, known))
    ids = F.flatten(found)
    unknown = F.filter(F.arrays_zip(F.col("_s").alias("s"), found.alias("i")), lambda p: F.rlike(p["s"], F.lit(ABOUT)) & (F.size(p["i"]) == 0))
    rows = rows.select("doc_id", F.size(unknown).cast("long").alias("n_unknown"), F.inline(F.array(F.struct(ids.alias("_ids")))))
    # Every identifier stands between two commas of its own, so that runs can be replaced one after the other.
    sequence = F.concat_ws("", F.transform("_ids", lambda x: F.concat(F.lit(","), x, F.lit(","))))
    rows = rows.select("doc_id", "n_unknown", "_ids", F.inline(F.array(F.struct(sequence.alias("_q")))))
    rest, found = F.col("_q"), []
    for name, run in RULES:
        pattern = F.lit("".join(f",{x}," for x in run))
        found.append(F.when(F.contains(rest, pattern), F.lit(name)))
        rest = F.replace(rest, pattern, F.lit(";"))
    return rows.select(
        "doc_id",
        F.size("_ids").cast("long").alias("n_known"),
        "n_unknown",
        F.concat_ws(",", "_ids").alias("sentence_ids"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull())))).alias("licenses"),
        F.concat_ws(",", F.filter(F.split(rest, "[,;]+"), lambda x: x != "")).alias("unmatched"),
    )


def op8_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _op8_sql() -> str:
    """The same scan in SQL: sentences, normal form, identifiers, and the rules one after the other."""
    values = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in SENTENCES.items())
    steps, rest = [], "q"
    for i, (name, run) in enumerate(RULES):
        pattern = _quoted("".join(f",{x}," for x in run))
        steps.append(f"r{i} AS (SELECT *, CASE WHEN contains({rest}, {pattern}) THEN {_quoted(name)} END AS f{i}, replace({rest}, {pattern}, ';') AS q{i} FROM {'seq' if i == 0 else f'r{i - 1}'})")
        rest = f"q{i}"
    # Twice, as a match takes in the letter before the next one.
    once = r"'(^|[^.!?;:])\n([\t #*/>;-]*[a-z])', '\1 \2', 'g'"
    folded = "lower(text)"
    for pattern, line in folds():
        folded = f"regexp_replace({folded}, {_quoted(pattern.replace('*+', '*'))}, {_quoted(line)}, 'g')"
    spdx = ", ".join(f"({_quoted(n.lower())}, 'Spdx-{n}')" for n in SPDX)
    last, found = len(RULES) - 1, ", ".join(f"f{i}" for i in range(len(RULES)))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), joined AS (
  SELECT rid, regexp_replace(regexp_replace(text, {once}), {once}) AS text
  FROM d WHERE regexp_matches(text, {_quoted(TRIGGER)})
), folded AS (
  SELECT rid, {folded} AS text FROM joined
), cut AS (
  SELECT rid, string_split_regex(regexp_replace(text, '([.!?])[\t ]+', '\1' || chr(10), 'g'), '\n') AS parts FROM folded
), sent AS (
  SELECT rid, unnest(parts) AS s, generate_subscripts(parts, 1) AS pos FROM cut
), n1 AS (
  SELECT rid, pos, regexp_replace(regexp_replace(regexp_replace(lower(s), '["''`“”]', '', 'g'),
         '^[\s#*/>;!-]+|[\s*/.:;!]+$', '', 'g'), '\s+[#*/>;]*\s*', ' ', 'g') AS s FROM sent
), n2 AS (
  SELECT rid, pos, regexp_replace(s, '^(?:copyright|\(c\)|©)(?: \(c\)| ©)?(?: [0-9, -]+)?(?: .+)?$', 'copyright <holder>') AS s FROM n1
), known(s, id) AS (VALUES {values}
), spdx(n, id) AS (VALUES {spdx}
), named AS (
  SELECT rid, pos, unnest(names) AS n, generate_subscripts(names, 1) AS place
  FROM (SELECT rid, pos, regexp_extract_all(substr(s, {len(SPDX_LINE) + 1}), '[a-z0-9][a-z0-9.+-]*') AS names
        FROM n2 WHERE starts_with(s, '{SPDX_LINE}'))
), ids AS (
  SELECT rid, pos, 0 AS place, id FROM n2 JOIN known ON n2.s = known.s WHERE NOT starts_with(n2.s, '{SPDX_LINE}')
  UNION ALL
  SELECT rid, pos, place, coalesce(known.id, spdx.id) FROM named LEFT JOIN known ON known.s = '{SPDX_LINE}' || n LEFT JOIN spdx USING (n)
  WHERE coalesce(known.id, spdx.id) IS NOT NULL
), told AS (
  SELECT rid, count(*) AS n_known, string_agg(id, ',' ORDER BY pos, place) AS ids,
         string_agg(',' || id || ',', '' ORDER BY pos, place) AS q FROM ids GROUP BY rid
), missed AS (
  SELECT rid, count(*) AS n_unknown FROM n2
  WHERE regexp_matches(s, '{ABOUT}') AND NOT EXISTS (SELECT 1 FROM ids WHERE ids.rid = n2.rid AND ids.pos = n2.pos) GROUP BY rid
), agg AS (
  SELECT rid, n_known, n_unknown, ids, q FROM told FULL JOIN missed USING (rid)
), seq AS (
  SELECT doc_id, coalesce(n_known, 0) AS n_known, coalesce(n_unknown, 0) AS n_unknown, coalesce(ids, '') AS ids, coalesce(q, '') AS q
  FROM d LEFT JOIN agg USING (rid)
), {', '.join(steps)}
SELECT doc_id, n_known, n_unknown, ids AS sentence_ids,
       array_to_string(list_sort(list_distinct(list_filter([{found}], lambda x: x IS NOT NULL))), ',') AS licenses,
       array_to_string(list_filter(string_split_regex(q{last}, '[,;]+'), lambda x: x <> ''), ',') AS unmatched
FROM r{last}
"""


OP8_SQL = _op8_sql()
