"""License scans: known sentences, then ordered rules over their sequence.

A text is cut into sentences at sentence marks and empty lines; each is
normalised, without the leaders of comment lines, and every run of its lines
that is a known sentence becomes an identifier, in the order of the text, the
longest run first.  Rules, tried in order, look for runs of identifiers; what a
rule matches is used up, so the text of a licence is not also counted as its
short form.  An SPDX expression gives each licence that it names; what follows
WITH is an exception and not a licence.  Lines that speak of a licence but are
in no known sentence count as unknown.

``SENTENCES`` and ``RULES`` are those of the SQL; ``PUBLISHED`` and
``PUBLISHED_RULES`` add the notices as their licences publish them, whose
sentences the cut divides, and the titles of full texts; ``SLOTS`` adds sentences
with free parts, as the clause on names, which tells BSD-3-Clause from BSD-2-Clause
whoever is named.

Everything is an expression over the row: no shuffle and no Python.

Defined results: null or empty text has no sentences; a sentence that repeats
gives its identifier each time and a rule's licence once for each run; rows
that repeat are judged alike; an empty table gives an empty one; only id and
text are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.shared import table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LEADS = ("licensed under", "released under", "distributed under", "available under",
          "this work is licensed under", "this file is licensed under", "this software is licensed under",
          "this program is licensed under", "this project is licensed under")

#: Licence, and the names that a reference sentence may give it, normalised.
NAMES = {
    "Apache-2.0": ("the apache license version 2.0", "the apache license 2.0", "apache-2.0"),
    "MIT": ("the mit license", "mit"),
    "BSD-3-Clause": ("the bsd 3-clause license", "the 3-clause bsd license", "bsd-3-clause"),
    "BSD-2-Clause": ("the bsd 2-clause license", "the 2-clause bsd license", "bsd-2-clause"),
    "ISC": ("the isc license", "isc"),
    "MPL-2.0": ("the mozilla public license version 2.0", "mpl-2.0"),
    **{f"GPL-{v}.0": (f"the gnu general public license version {v}", f"the gnu gpl version {v}", f"gpl-{v}.0") for v in (2, 3)},
    **{f"LGPL-{v}": (f"the gnu lesser general public license version {v}", f"lgpl-{v}") for v in ("2.1", "3.0")},
    "AGPL-3.0": ("the gnu affero general public license version 3", "agpl-3.0"),
    **{f"CC-{k.upper()}-{v}": (f"cc {k} {v}", f"cc-{k}-{v}", f"a creative commons {k} {v} license")
       for k in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd") for v in ("3.0", "4.0")},
    "CC0-1.0": ("cc0 1.0", "cc0-1.0"),
    "Unlicense": ("the unlicense",),
}

#: Sentences of licence texts, normalised.
TEXTS = {
    "mit.grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "isc.grant": "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "asis": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd.grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd.source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd.binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd.names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl.free": "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl.hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "apache.comply": "you may not use this file except in compliance with the license",
    "rights": "all rights reserved",
}

#: Identifier of each known sentence.
SENTENCES = {s: i for i, s in TEXTS.items()} | {
    f"{lead} {name}": f"ref.{licence}" for licence, names in NAMES.items() for name in names for lead in _LEADS} | {
    f"spdx-license-identifier {licence.lower()}": f"ref.{licence}" for licence in NAMES}

#: Runs of identifiers and the licence they stand for; the first that fits wins.
RULES = (
    (("mit.grant", "asis"), "MIT"),
    (("isc.grant", "asis"), "ISC"),
    (("bsd.grant", "bsd.source", "bsd.binary", "bsd.names"), "BSD-3-Clause"),
    (("bsd.grant", "bsd.source", "bsd.binary"), "BSD-2-Clause"),
    (("gpl.free", "gpl.hope"), "GPL-3.0-or-later"),
    (("ref.Apache-2.0", "apache.comply"), "Apache-2.0"),
    (("mit.grant",), "MIT"),
    (("isc.grant",), "ISC"),
    (("gpl.free",), "GPL-3.0-or-later"),
    *(((f"ref.{licence}",), licence) for licence in NAMES),
    (("rights",), "All-rights-reserved"),
)

#: Licences of GNU: their names in a notice, and versions in a notice and in SPDX.
GNU = {"GPL": (("general",), {"1": "1.0", "2": "2.0", "3": "3.0"}),
       "LGPL": (("lesser general", "library general"), {"2": "2.0", "2.1": "2.1", "3": "3.0"}),
       "AGPL": (("affero general",), {"3": "3.0"})}
_SUBJECTS = ("this program", "this library", "this file", "this software", "this package")
_SPDX = "spdx-license-identifier"
_CC = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
#: Licences that SPDX lines name besides those of ``NAMES`` and of GNU.
SPDX = ("0BSD", "Apache-1.1", "Artistic-2.0", "BSL-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "MIT-0", "MPL-1.1", "PostgreSQL",
        "Python-2.0", "WTFPL", "X11", "Zlib")


def _published() -> tuple[dict[str, str], list]:
    """Identifiers of published sentences, and rules over them."""
    out = {
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit.permission",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit.notice",
        "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc.grant",
        "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted": "0bsd.grant",
        "the asf licenses this file to you under the apache license version 2.0 the license": "ref.Apache-2.0",
        "licensed to the apache software foundation asf under one or more contributor license agreements": "apache.asf",
        "you may obtain a copy of the license at": "apache.copy",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache.basis",
        "see the license for the specific language governing permissions and limitations under the license": "apache.see",
        "this source code form is subject to the terms of the mozilla public license v": "mpl.terms",     # cut before 2.0
        "this is free and unencumbered software released into the public domain": "unlicense.free",
        "without even the implied warranty of merchantability or fitness for a particular purpose": "gnu.merchant",
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib.grant",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third-parties to whom the software is furnished to do so all subject to the following": "bsl.grant",
        "the copyright notices in the software and this entire statement including the above license grant this restriction and the following disclaimer must be included in all copies of the software in whole or in part and all derivative works of the software unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor": "bsl.notice",
        "boost software license - version 1.0 - august 17th 2003": "bsl.title",
        # The titles of full texts.
        "apache license version 2.0 january 2004": "ref.Apache-2.0",
        "apache license version 2.0 january 2004 http //www.apache.org/licenses": "ref.Apache-2.0",
        "mozilla public license version 2.0": "ref.MPL-2.0",
        "gnu general public license version 2 june 1991": "ref.GPL-2.0",
        "gnu general public license version 3 29 june 2007": "ref.GPL-3.0",
        "gnu lesser general public license version 2.1 february 1999": "ref.LGPL-2.1",
        "gnu lesser general public license version 3 29 june 2007": "ref.LGPL-3.0",
        "gnu affero general public license version 3 19 november 2007": "ref.AGPL-3.0",
    }
    out |= {f"{lead} the apache license version 2.0 the license": "ref.Apache-2.0" for lead in _LEADS}
    for scheme in ("http", "https"):
        url = f"{scheme} //www.apache.org/licenses/license-2.0"
        out |= {url: "apache.url", f"you may obtain a copy of the license at {url}": "apache.copy",
                f"if not see {scheme} //www.gnu.org/licenses": "gnu.url"}
    for k, v in ((k, v) for k in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd") for v in ("3.0 unported", "4.0 international")):
        name = f"creative commons {'-'.join(_CC[x] for x in k.split('-'))} {v}"
        out |= {f"{lead} {a}{name}{b}": f"ref.CC-{k.upper()}-{v[:3]}" for lead in _LEADS for a in ("", "a ", "the ") for b in ("", " license")}
    rules = [(("mit.permission", "mit.notice", "asis"), "MIT"), (("mit.permission", "mit.notice"), "MIT"), (("mit.permission",), "MIT"),
             (("0bsd.grant",), "0BSD"), (("mpl.terms",), "MPL-2.0"), (("unlicense.free",), "Unlicense"),
             (("bsd.grant", "bsd.source", "bsd.binary", "bsd.ads", "bsd.names"), "BSD-4-Clause"),
             (("bsd.grant", "bsd.source", "bsd.binary", "bsd.ads"), "BSD-4-Clause"), (("zlib.grant",), "Zlib"),
             (("bsl.title", "bsl.grant", "bsl.notice"), "BSL-1.0"), (("bsl.grant", "bsl.notice"), "BSL-1.0"), (("bsl.grant",), "BSL-1.0")]
    spdx = {x: x for x in (*NAMES, *SPDX)}
    free = "you can redistribute it and/or modify it under the terms of the gnu"
    starts = ("", *(f"{x} is free software " for x in _SUBJECTS))
    for gnu, (kinds, versions) in GNU.items():
        for k in kinds:
            out |= {f"{s}{free} {k} public license as published by the free software foundation": f"gnu.{gnu}" for s in starts}
            out |= {f"see the gnu {k} public license for more details": "gnu.see"}
            for x in _SUBJECTS:
                copy = f"you should have received a copy of the gnu {k} public license along with {x}"
                out |= {copy: "gnu.copy", f"{x} is distributed in the hope that it will be useful but without any warranty": "gnu.hope"}
                out |= {f"{copy} if not see {scheme} //www.gnu.org/licenses": "gnu.copy" for scheme in ("http", "https")}
        for v, full in versions.items():
            later, only = f"{gnu}-{full}-or-later", f"{gnu}-{full}-only"
            ends = {f"either version {v} of the license or at your option any later version": ("later", later),
                    f"either version {v} or at your option any later version": ("later", later),
                    f"version {v} of the license": ("only", only)}
            for end, (which, licence) in ends.items():
                out[end] = f"gnu.{which}-{v}"
                out |= {f"{s}{free} {k} public license as published by the free software foundation {end}": f"gnu.{licence}"
                        for s in starts for k in kinds}
            out |= {f"{s}{free} {k} public license version {v} as published by the free software foundation": f"gnu.{only}"
                    for s in starts for k in kinds}
            for which, licence in (("later", later), ("only", only)):
                rules += [((f"gnu.{gnu}", f"gnu.{which}-{v}"), licence), ((f"gnu.{licence}",), licence), ((f"ref.{licence}",), licence)]
            spdx |= {later: later, only: only, f"{gnu}-{full}+": later}
    # A notice whose version is not in the table names its licence without one.
    rules += [((f"gnu.{gnu}",), gnu) for gnu in GNU]
    rules += [((f"ref.{x}",), x) for x in (*SPDX, "GPL-1.0", "LGPL-2.0") if x not in NAMES]
    spdx |= {"GPL-1.0": "GPL-1.0", "LGPL-2.0": "LGPL-2.0"}
    out |= {f"{_SPDX} {x.lower()}": f"ref.{licence}" for x, licence in spdx.items()}
    return out, rules


PUBLISHED, PUBLISHED_RULES = _published()
ALL_SENTENCES = PUBLISHED | SENTENCES
ALL_RULES = (*PUBLISHED_RULES, *RULES)

#: Every known sentence holds one of these patterns, in any case.
HINTS = (r"licens", r"(released|distributed|available)\W+under", r"permi", r"warrant", r"redistribution", r"reserved", r"endorse", r"spdx",
         r"unencumbered", r"later\W+version", r"acknowledgement")
_SENTENCE_END = r"[.!?;]+[\x20\x09-\x0D]|[.!?;]+\z|\n[\x20\x09]*\n"


def _lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def _trie_pattern(sentences) -> str:
    """One pattern for all sentences, whose words are parted by a space or a new line."""
    root: dict = {}
    for sentence in sentences:
        node = root
        for word in sentence.split(" "):
            node = node.setdefault(word, {})
        node[""] = {}

    def after(node: dict) -> str:
        parts = [_literal(word) + rest(child) for word, child in sorted(node.items()) if word]
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"

    def rest(node: dict) -> str:
        if not any(node):
            return ""
        more = r"[ \n]" + after(node)
        return f"(?:{more})?" if "" in node else more       # the longer sentence first

    return after(root)


def _literal(word: str) -> str:
    return re.sub(r"([.+])", r"\\\1", word)


def normalised(sentence: Column) -> Column:
    """Lower case; words, digits, dots, plus, slash and hyphen; one space or new
    line between.  Marks that begin or end a line, as of comments, are left out."""
    words = F.regexp_replace(_lower(sentence), r"[^a-z0-9./+\n-]+", " ")
    return F.regexp_replace(F.regexp_replace(words, r"(?m)^[ ./+-]+|(?:[./-]*(?: [./+-]*)+|[./-]+)$", ""), r"^\n+|\n+$|(?<=\n)\n+", "")


#: Sentences with free parts, which hold a name: identifier, and the pattern with
#: a blank for a space or a new line.  Free parts are a bounded number of words.
SLOTS = {
    # Nobody's name may be used in advertising: in whose favour and in which words, licences differ.
    "bsd.names": r"(?:(?:[0-9]+|[a-z]) )?(?:neither|nor|the names?|no names?) (?:[^ \n;]+ ){0,40}?endorse or promote products derived from(?: [^ \n;]+){1,40}",
    "bsd.ads": r"all advertising materials mentioning features or use of this software must display the following acknowledgement(?: [^ \n;]+){0,40}",
}
_SLOTTED = "|".join(p.replace(r" \n", "\0").replace(" ", r"[ \n]").replace("\0", r" \n") for p in SLOTS.values())

#: Known sentences, those with free parts, and whole SPDX lines, between line ends or sentence ends.
_KNOWN = rf"(?<![^\n;])(?:{_trie_pattern(ALL_SENTENCES)}|{_SLOTTED}|{_SPDX} [^\n;]*)(?![^\n;])"


def notices(text: Column) -> Column:
    """The normalised sentences that may be known, with ; between."""
    hint = F.lit("(?i)" + "|".join(HINTS))
    # A leading semicolon begins a comment and ends no sentence.
    cut = F.filter(F.split(F.regexp_replace(text, r"(?m)^[\x20\x09]*;+", ""), _SENTENCE_END), lambda s: F.rlike(s, hint))
    return F.when(F.rlike(text, hint), F.array_join(F.transform(cut, normalised), ";")).otherwise("")


def licence_columns(notice: Column) -> tuple[Column, Column]:
    """(sentence identifiers, unknown lines) of ``notices``: arrays of strings."""
    known = F.create_map(*[F.lit(x) for pair in ALL_SENTENCES.items() for x in pair])

    def licences(hit):
        named = F.split(F.regexp_replace(hit, r" with [^ ]+", ""), r" (?:and|or) ")
        each = F.transform(named, lambda x: F.when(x.startswith(_SPDX), x).otherwise(F.concat(F.lit(f"{_SPDX} "), x)))
        return F.when(hit.startswith(f"{_SPDX} "), each).otherwise(F.array(hit))

    hits = F.transform(F.regexp_extract_all(notice, F.lit(_KNOWN), F.lit(0)), lambda h: F.translate(h, "\n", " "))
    found = F.flatten(F.transform(hits, licences))

    def identifier(sentence):
        slotted = [F.when(F.rlike(sentence, F.lit(f"^(?:{p})$")), F.lit(i)) for i, p in SLOTS.items()]
        return F.coalesce(F.try_element_at(known, sentence), *slotted)

    ids = F.filter(F.transform(found, identifier), lambda i: i.isNotNull())
    left = F.concat(F.split(F.regexp_replace(notice, _KNOWN, ""), r"[\n;]"), F.filter(found, lambda s: identifier(s).isNull()))
    none = F.array().cast("array<string>")
    unknown = F.filter(left, lambda s: s.contains("license"))
    return F.when(notice != "", ids).otherwise(none), F.when(notice != "", unknown).otherwise(none)


def matched_rules(ids: Column) -> Column:
    """Licences of the rules that match, in the order of the rules."""
    rules = F.array(*[F.struct(F.lit("".join(f"<{i}>" for i in run)).alias("run"), F.lit(name).alias("name")) for run, name in ALL_RULES])
    start = F.struct(F.concat_ws("", F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">")))).alias("left"),
                     F.array().cast("array<string>").alias("found"))

    def apply(state, rule):
        left = F.replace(state["left"], rule["run"], F.lit("|"))
        times = ((F.length(state["left"]) - F.length(left)) / (F.length(rule["run"]) - 1)).cast("int")
        return F.struct(left.alias("left"), F.concat(state["found"], F.array_repeat(rule["name"], times)).alias("found"))

    return F.when(F.size(ids) > 0, F.aggregate(rules, start, apply, lambda s: s["found"])).otherwise(F.array().cast("array<string>"))


def scan_licences(docs: DataFrame) -> DataFrame:
    """(doc_id, sentence_ids, licences, n_unknown) of each row; the lists as arrays."""
    ids, unknown = licence_columns(F.col("notice"))
    return (docs.select("doc_id", notices(F.coalesce("text", F.lit(""))).alias("notice"))
            .select("doc_id", ids.alias("sentence_ids"), F.size(unknown).cast("long").alias("n_unknown"))
            .select("doc_id", "sentence_ids", matched_rules(F.col("sentence_ids")).alias("licences"), "n_unknown"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", " ").alias("sentence_ids"),
                        F.array_join("licences", " ").alias("licences"), "n_unknown")


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _oracle() -> str:
    """Sentences as rows, and each rule as one more step over the sequence."""
    known = ", ".join(f"({_quoted(s)}, {_quoted(i)})" for s, i in SENTENCES.items())
    steps, last = [], "seqs"
    for k, (run, name) in enumerate(RULES):
        text = _quoted("".join(f"<{i}>" for i in run))
        steps.append(f"r{k} AS (SELECT doc_id, ids, n_unknown, replace(rest, {text}, '|') AS rest, found || repeat({_quoted(name + ' ')}, "
                     f"CAST((length(rest) - length(replace(rest, {text}, ''))) / length({text}) AS INT)) AS found FROM {last})")
        last = f"r{k}"
    return rf"""
WITH known(s, id) AS (VALUES {known}),
cut AS (SELECT doc_id, unnest(parts) AS s, generate_subscripts(parts, 1) AS k FROM (SELECT doc_id, string_split(regexp_replace(
    coalesce(text, ''), '[.!?;]+[\x20\x09-\x0D]|[.!?;]+\z|\n[\x20\x09]*\n', chr(1), 'g'), chr(1)) AS parts FROM documents)),
whole AS (SELECT doc_id, k, s, trim(regexp_replace(translate(s, '{_UPPER}', '{_LOWER}'), '[^a-z0-9./+-]+', ' ', 'g'), ' ') AS n FROM cut),
rest AS (SELECT doc_id, k, unnest(string_split(s, chr(10))) AS s, generate_subscripts(string_split(s, chr(10)), 1) AS j
    FROM whole WHERE n NOT IN (SELECT s FROM known)),
norm AS (SELECT doc_id, k, 0 AS j, n AS s FROM whole WHERE n IN (SELECT s FROM known)
    UNION ALL SELECT doc_id, k, j, trim(regexp_replace(translate(s, '{_UPPER}', '{_LOWER}'), '[^a-z0-9./+-]+', ' ', 'g'), ' ') FROM rest),
hits AS (SELECT doc_id, string_agg('<' || id || '>', '' ORDER BY k, j) AS rest, string_agg(id, ' ' ORDER BY k, j) AS ids,
    count(*) FILTER (id IS NULL AND norm.s LIKE '%license%') AS n_unknown
    FROM norm LEFT JOIN known ON norm.s = known.s WHERE id IS NOT NULL OR norm.s LIKE '%license%' GROUP BY doc_id),
seqs AS (SELECT d.doc_id, coalesce(rest, '') AS rest, coalesce(ids, '') AS ids, coalesce(n_unknown, 0) AS n_unknown, '' AS found
    FROM documents d LEFT JOIN hits USING (doc_id)),
{", ".join(steps)}
SELECT doc_id, ids AS sentence_ids, trim(found, ' ') AS licences, n_unknown FROM {last}
"""


OP1_SQL = _oracle()
