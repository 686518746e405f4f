"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences, each is normalised (lower-case a-z and digits, single spaces) and looked up among
the known licence sentences. Sentences end at punctuation and blank lines (comment marks alone are blank); within
one, the longest run of whole lines that makes a known sentence counts, so wrapped texts and titles are both found. The identifiers found, in order, form the document's sequence. Rules are tried in
order, longer ones first: a rule matches where its identifiers follow one another in the sequence, and consumes
them. A sentence that no rule explains is reported as `unknown-licence-text`.

Everything happens within the row: no shuffle, no grouping and no limit on text length.

Defined cases: null and empty texts have no sentences and no licence. Repeated rows get equal results, and an
empty table an empty one. Columns of the input may have any name; only the id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import text_or_empty

# Wording of public licences and of common notices, normalised, by identifier.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-notice-licensed": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-title-mit": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-condition": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-warranty": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-terms": "see the license for the specific language governing permissions and limitations under the license",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software",
    "gpl2-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-merchant": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-notice": "licensed under the bsd license",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "cc0-notice": "licensed under cc0 1 0",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache": "spdx license identifier apache 2 0",
    "spdx-gpl3": "spdx license identifier gpl 3 0 or later",
    "spdx-bsd3": "spdx license identifier bsd 3 clause",
    "spdx-mpl": "spdx license identifier mpl 2 0",
    "proprietary": "all rights reserved",
}

#: (licence, identifiers in order); tried from the first, so longer texts come before their parts.
RULES = [
    ("MIT", ["mit-title", "mit-grant", "mit-condition", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-title-mit", "mit-grant", "mit-condition", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-condition", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-notice-licensed"]),
    ("MIT", ["spdx-mit"]),
    ("MIT", ["mit-title-mit"]),
    ("MIT", ["mit-title"]),
    ("Apache-2.0", ["apache-header", "apache-use", "apache-copy", "apache-warranty", "apache-terms"]),
    ("Apache-2.0", ["apache-header", "apache-use"]),
    ("Apache-2.0", ["apache-header"]),
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms", "gpl-warranty", "gpl-merchant", "gpl-see"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-terms", "gpl-warranty", "gpl-merchant", "gpl-see"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-terms"]),
    ("GPL-3.0-or-later", ["spdx-gpl3"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["spdx-bsd3"]),
    ("BSD", ["bsd-notice"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("MPL-2.0", ["spdx-mpl"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("proprietary", ["proprietary"]),
]
UNKNOWN = "unknown-licence-text"

_GNU = "you can redistribute it and or modify it under the terms of the gnu {} general public license as published by the free software foundation"
_LATER = "either version {} of the license or at your option any later version"
#: Further (identifier, wordings), beside SENTENCES, which the SQL has too.
MORE_SENTENCES = {
    "mit-title-full": ["the mit license mit"],
    "gpl-terms": [_GNU.format("").replace("  ", " ")],
    "agpl-terms": [_GNU.format("affero")],
    "lgpl-terms": [_GNU.format("lesser")],
    "or-later-2": [_LATER.format("2")],
    "or-later-2.1": [_LATER.format("2 1")],
    "or-later-3": [_LATER.format("3")],
    "agpl3-terms": [f"{_GNU.format('affero')} {_LATER.format('3')}"],
    "lgpl2.1-terms": [f"{_GNU.format('lesser')} {_LATER.format('2 1')}"],
    "lgpl3-terms": [f"{_GNU.format('lesser')} {_LATER.format('3')}"],
    "lgpl-free": ["this library is free software"],
    "lgpl-warranty": ["this library is distributed in the hope that it will be useful but without any warranty"],
    "lgpl-see": ["see the gnu lesser general public license for more details"],
    "agpl-see": ["see the gnu affero general public license for more details"],
    "bsd-name-org": ["neither the name of the organization nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "isc-grant": [f"permission to use copy modify {x} distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies" for x in ("and or", "and")],
    "unlicense-grant": ["this is free and unencumbered software released into the public domain"],
    "epl2-terms": [f"this program and the accompanying materials are made available under the terms of the eclipse public license {v}2 0 which is available at {w} eclipse org legal epl 2 0" for v in ("", "v ", "v") for w in ("https www", "http www")],
}
MORE_RULES = [
    ("MIT", ["mit-title-full"]),
    *[(f"{name}-or-later", [free, *terms]) for name, terms in (
        ("GPL-2.0", ["gpl-terms", "or-later-2"]), ("GPL-3.0", ["gpl-terms", "or-later-3"]), ("AGPL-3.0", ["agpl-terms", "or-later-3"]), ("AGPL-3.0", ["agpl3-terms"]),
        ("LGPL-2.1", ["lgpl-terms", "or-later-2.1"]), ("LGPL-2.1", ["lgpl2.1-terms"]), ("LGPL-3.0", ["lgpl-terms", "or-later-3"]), ("LGPL-3.0", ["lgpl3-terms"]),
    ) for free in ("gpl-free", "lgpl-free")],
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name-org"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense-grant"]),
    ("EPL-2.0", ["epl2-terms"]),
]

_GNU_TITLES = {"GPL-2.0": "gnu general public license version 2 june 1991", "GPL-3.0": "gnu general public license version 3 29 june 2007", "LGPL-2.1": "gnu lesser general public license version 2 1 february 1999", "LGPL-3.0": "gnu lesser general public license version 3 29 june 2007", "AGPL-3.0": "gnu affero general public license version 3 19 november 2007"}
_CREATIVE = {"CC-BY-4.0": "attribution", "CC-BY-SA-4.0": "attribution sharealike", "CC-BY-NC-4.0": "attribution noncommercial", "CC-BY-ND-4.0": "attribution noderivatives", "CC-BY-NC-SA-4.0": "attribution noncommercial sharealike", "CC-BY-NC-ND-4.0": "attribution noncommercial noderivatives"}
#: Titles, grants and conditions of whole licence texts, and the header of a foundation.
TEXT_SENTENCES = {
    "apache-text": [f"apache license version 2 0 january 2004{x}" for x in ("", " http www apache org licenses", " https www apache org licenses")],
    "apache-text-terms": ["terms and conditions for use reproduction and distribution"],
    "apache-text-copyright": ["subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form"],
    "asf-contributors": ["licensed to the apache software foundation asf under one or more contributor license agreements"],
    "asf-notice": ["see the notice file distributed with this work for additional information regarding copyright ownership"],
    "asf-license": ["the asf licenses this file to you under the apache license version 2 0 the license"],
    "gnu-verbatim": ["everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"],
    "gnu-preamble": [f"the gnu {x}general public license is a free copyleft license for software and other kinds of works{y}" for x, y in (("", ""), ("affero ", " specifically designed to ensure cooperation with the community in the case of network server software"))],
    "mpl-text": ["mozilla public license version 2 0"],
    "mpl-obtain": [f"if a copy of the mpl was not distributed with this file you can obtain one at {x} mozilla org mpl 2 0" for x in ("http", "https")],
    "boost-text": ["boost software license version 1 0 august 17th 2003"],
    "boost-grant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"],
    "zlib-warranty": ["this software is provided as is without any express or implied warranty"],
    "zlib-liability": ["in no event will the authors be held liable for any damages arising from the use of this software"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "zlib-origin": ["the origin of this software must not be misrepresented"],
    "zlib-claim": ["you must not claim that you wrote the original software"],
    "0bsd-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "cc0-text": ["cc0 1 0 universal"],
} | {f"{name}-text": [title] for name, title in _GNU_TITLES.items()} | {
    f"{name}-text": [f"creative commons {x} 4 0 international public license", f"under a creative commons {x} 4 0 international license", f"under the creative commons {x} 4 0 international license"] for name, x in _CREATIVE.items()
}
TEXT_RULES = [
    ("Apache-2.0", ["apache-text", "apache-text-terms", "apache-text-copyright"]),
    *[("Apache-2.0", [x]) for x in ("apache-text", "apache-text-terms", "apache-text-copyright")],
    ("Apache-2.0", ["asf-contributors", "asf-notice", "asf-license", "apache-use", "apache-copy", "apache-warranty", "apache-terms"]),
    ("Apache-2.0", ["asf-license", "apache-use", "apache-copy", "apache-warranty", "apache-terms"]),
    ("Apache-2.0", ["asf-license", "apache-use"]),
    *[(name, [f"{name}-text", *rest]) for name in _GNU_TITLES for rest in (["gnu-verbatim", "gnu-preamble"], ["gnu-verbatim"], [])],
    ("MPL-2.0", ["mpl-notice", "mpl-obtain"]),
    ("MPL-2.0", ["mpl-text"]),
    ("BSL-1.0", ["boost-text", "boost-grant"]),
    ("BSL-1.0", ["boost-grant"]),
    ("BSL-1.0", ["boost-text"]),
    ("Zlib", ["zlib-warranty", "zlib-liability", "zlib-grant", "zlib-origin", "zlib-claim"]),
    ("Zlib", ["zlib-grant", "zlib-origin", "zlib-claim"]),
    ("Zlib", ["zlib-grant"]),
    ("0BSD", ["0bsd-grant"]),
    ("CC0-1.0", ["cc0-text"]),
    *[(name, [f"{name}-text"]) for name in _CREATIVE],
]
_CLOSINGS = [[w, "gpl-merchant", see] for w in ("gpl-warranty", "lgpl-warranty") for see in ("gpl-see", "lgpl-see", "agpl-see")]
_VERSIONED = ["{} version {}", "{} v{}", "{} v {}", "{} {}"]
_NAMES = {
    "MIT": ["mit license", "mit licence"],
    "Apache-2.0": [x.format("apache license", "2 0") for x in _VERSIONED] + ["apache 2 0 license"],
    "BSD": ["bsd license"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"],
    "ISC": ["isc license"],
    "Unlicense": ["unlicense"],
    "MPL-2.0": [x.format(y, "2 0") for x in _VERSIONED for y in ("mozilla public license", "mpl")],
    "EPL-2.0": [x.format(y, "2 0") for x in _VERSIONED for y in ("eclipse public license", "epl")],
    "BSL-1.0": ["boost software license version 1 0", "boost software license"],
    "Zlib": ["zlib license", "zlib libpng license"],
    "0BSD": ["0bsd license", "zero clause bsd license"],
    "CC0-1.0": ["cc0 1 0"],
    "CC-BY-4.0": ["cc by 4 0"],
    "CC-BY-SA-4.0": ["cc by sa 4 0"],
    "CC-BY-NC-4.0": ["cc by nc 4 0"],
} | {
    f"{short}-{version}": [x.format(y, v) for x in _VERSIONED for y in (f"gnu {kind}general public license", f"gnu {short.lower()}", short.lower()) for v in {version.replace(".", " "), version.removesuffix(".0").replace(".", " ")}]
    for short, kind, version in (("GPL", "", "2.0"), ("GPL", "", "3.0"), ("LGPL", "lesser ", "2.1"), ("LGPL", "lesser ", "3.0"), ("AGPL", "affero ", "3.0"))
}
_NOUNS, _VERBS = ("software", "project", "program", "library", "package", "code", "file", "work"), ("licensed", "released", "distributed", "available")
#: Openings of a notice; where a sentence isn't one of SENTENCES they are read as `under`.
_OPENING = f"^(?:this (?:{'|'.join(_NOUNS)}) is )?(?:{'|'.join(_VERBS)}) under (?:the terms of )?(?:the )?"
_SPDX = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense", "EPL-2.0", "MPL-2.0", "BSL-1.0", "Zlib", "0BSD", "CC0-1.0", *_CREATIVE] + [f"{x}-{y}" for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for y in ("only", "or-later")]


def known_sentences() -> dict[str, str]:
    """Identifier by wording; SENTENCES go first."""
    found = {f"under {x}": f"{name}-named" for name, own in _NAMES.items() for x in own}
    found |= {f"spdx license identifier {x.lower().replace('-', ' ').replace('.', ' ')}": f"{x}-spdx" for x in _SPDX}
    found |= {text: id_ for id_, texts in (MORE_SENTENCES | TEXT_SENTENCES).items() for text in texts}
    return found | {text: id_ for id_, text in SENTENCES.items()}


def all_rules() -> list[tuple[str, list[str]]]:
    """RULES and the further ones, longer texts first where they share a beginning."""
    closed = [(name, ids + tail) for name, ids in MORE_RULES if ids[0] in ("gpl-free", "lgpl-free") for tail in _CLOSINGS]
    named = [(name, [f"{name}-named"]) for name in _NAMES] + [(x, [f"{x}-spdx"]) for x in _SPDX]
    first = [r for r in MORE_RULES if r[1][0] == "bsd-grant"] + [r for r in TEXT_RULES if r[1][0] == "mpl-notice"]
    return first + RULES + closed + MORE_RULES + TEXT_RULES + named


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Marks the end of a sentence while a text is cut.
_END = "\x02"


def sentences(text: Column) -> Column:
    """Normalised sentences, each as its lines: they end at a blank line, or at . ! ? ; : before white space."""
    lower = F.translate(text, _UPPER + _END, _LOWER + " ")
    for cut in ("spdx-license-identifier:", "license, v."):
        lower = F.when(F.contains(lower, F.lit(cut)), F.replace(lower, F.lit(cut), F.lit(cut[:-1] + " "))).otherwise(lower)
    ended = F.regexp_replace(F.regexp_replace(lower, r"[.!?;:]+(?:[ \t\r\x0B\f\n]|$)", _END), f"[^a-z0-9\n{_END}]+", " ")
    return F.split(F.regexp_replace(ended, r"\n(?: ?\n)+", _END), _END)


def _lines(sentence: Column) -> Column:
    return F.filter(F.transform(F.split(sentence, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def _wording(sentence: Column) -> Column:
    """A sentence with the openings of notices made alike."""
    return F.when(F.contains(sentence, F.lit(" under ")) & ~sentence.isin(list(SENTENCES.values())), F.regexp_replace(sentence, _OPENING, "under ")).otherwise(sentence)


def _known_runs(lines: Column, by_text: dict[str, str], known: Column) -> Column:
    """Identifiers of the runs of whole lines that are known, longest first at each line."""
    starts = sorted({" ".join(x.split(" ")[:2]) for x in by_text} | {f"{x} under" for x in _VERBS} | {f"this {x}" for x in _NOUNS})
    longest = max(len(x.split(" ")) for x in by_text)
    nothing = F.struct(F.lit(0).alias("n"), F.lit("").alias("text"))

    def step(state: Column, i: Column) -> Column:
        run = lambda n: F.struct(n.alias("n"), _wording(F.array_join(F.slice(lines, i, n), " ")).alias("text"))
        runs = F.filter(F.transform(F.sequence(F.lit(1), F.least(F.size(lines) - i + 1, F.lit(longest))), run), lambda r: r["text"].isin(list(by_text)))
        opens = (i >= state["free"]) & F.substring_index(F.array_join(F.slice(lines, i, F.lit(2)), " "), " ", 2).isin(starts)
        best = F.when(opens, F.coalesce(F.try_element_at(runs, F.lit(-1)), nothing)).otherwise(nothing)
        take = lambda b: F.when(b["n"] > 0, F.struct((i + b["n"]).alias("free"), F.array_append(state["ids"], known[b["text"]]).alias("ids"))).otherwise(state)
        return F.element_at(F.transform(F.array(best), take), 1)

    start = F.struct(F.lit(1).alias("free"), F.array().cast("array<string>").alias("ids"))
    return F.aggregate(F.sequence(F.lit(1), F.size(lines)), start, step, lambda state: state["ids"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_text: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """(doc_id, licenses, sentence_ids): the licences of each row, sorted, and the sequence of known sentences."""
    by_text, rules = by_text or known_sentences(), rules or all_rules()
    known = F.create_map(*[F.lit(x) for pair in by_text.items() for x in pair])
    # isin is a hash set, so the map is only searched for sentences that are in it.
    alone = lambda s: F.element_at(F.transform(F.array(_wording(s)), one), 1)
    one = lambda s: F.when(s.isin(list(by_text)), F.array(known[s])).otherwise(F.array().cast("array<string>"))
    wrapped = lambda s: F.flatten(F.transform(F.filter(F.array(_lines(s)), lambda x: F.size(x) > 0), lambda x: _known_runs(x, by_text, known)))
    found = F.flatten(F.transform(sentences(text_or_empty(text_col)), lambda s: F.when(F.contains(F.trim(s), F.lit("\n")), wrapped(s)).otherwise(alone(F.trim(F.replace(s, F.lit("\n"), F.lit(" ")))))))
    rows = docs.select(F.col(id_col).alias("doc_id"), found.alias("sentence_ids"))
    steps = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in ids)).alias("pattern")) for name, ids in rules])
    sequence = F.transform("sentence_ids", lambda i: F.concat(F.lit("<"), i, F.lit(">")))
    start = F.struct(F.array_join(sequence, "").alias("left"), F.array().cast("array<string>").alias("names"))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["pattern"])
        return F.struct(
            F.when(hit, F.replace(state["left"], rule["pattern"], F.lit("|"))).otherwise(state["left"]).alias("left"),
            F.when(hit, F.array_append(state["names"], rule["name"])).otherwise(state["names"]).alias("names"),
        )

    def finish(state: Column) -> Column:
        names = F.when(F.contains(state["left"], F.lit("<")), F.array_append(state["names"], F.lit(UNKNOWN))).otherwise(state["names"])
        return F.array_sort(F.array_distinct(names))

    licenses = F.when(F.size("sentence_ids") == 0, F.array().cast("array<string>")).otherwise(F.aggregate(steps, start, apply, finish))
    return rows.select("doc_id", licenses.alias("licenses"), "sentence_ids")


def oracle_sql() -> str:
    """The same in DuckDB: known runs of lines are joined, then taken in order by a fold, as are the rules."""
    by_text = known_sentences()
    starts = sorted({" ".join(x.split(" ")[:2]) for x in by_text} | {f"{x} under" for x in _VERBS} | {f"this {x}" for x in _NOUNS})
    longest = max(len(x.split(" ")) for x in by_text)
    values = ", ".join(f"('{text}', '{id_}')" for text, id_ in by_text.items())
    listed = lambda xs: ", ".join(f"'{x}'" for x in xs)
    wording = lambda x: f"CASE WHEN contains({x}, ' under ') AND {x} NOT IN ({listed(SENTENCES.values())}) THEN regexp_replace({x}, '{_OPENING}', 'under ') ELSE {x} END"
    rules = ", ".join(f"{{'rest': '', 'names': []::VARCHAR[], 'p': '{''.join(f'<{i}>' for i in ids)}', 'n': '{name}'}}" for name, ids in all_rules())
    return rf"""
    WITH known(text, id) AS (VALUES {values}),
    low AS (SELECT doc_id, replace(replace(translate(coalesce(text, ''), '{_UPPER}' || chr(2), '{_LOWER} '), 'spdx-license-identifier:', 'spdx-license-identifier '), 'license, v.', 'license, v ') AS t FROM documents),
    cut AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(regexp_replace(t, '[.!?;:]+(?:[ \t\r\x0B\f\n]|$)', chr(2), 'g'), '[^a-z0-9\n\x02]+', ' ', 'g'), '\n(?: ?\n)+', chr(2), 'g'), chr(2)) AS ss FROM low),
    parts AS (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS pos FROM cut),
    alone AS (SELECT doc_id, pos, trim(replace(s, chr(10), ' ')) AS x FROM parts WHERE NOT contains(trim(s), chr(10))),
    wrapped AS (SELECT doc_id, pos, list_filter(list_transform(string_split(s, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM parts WHERE contains(trim(s), chr(10))),
    opens AS (SELECT doc_id, pos, l, unnest(range(1, len(l) + 1)) AS i FROM wrapped),
    opened AS (SELECT * FROM opens WHERE array_to_string(string_split(array_to_string(l[i:i + 1], ' '), ' ')[1:2], ' ') IN ({listed(starts)})),
    runs AS (SELECT doc_id, pos, l, i, unnest(range(1, least(len(l) - i + 1, {longest}) + 1)) AS n FROM opened),
    worded AS (SELECT doc_id, pos, i, n, array_to_string(l[i:i + n - 1], ' ') AS x FROM runs),
    best AS (SELECT doc_id, pos, i, max(n) AS n, arg_max(id, n) AS id FROM (SELECT *, {wording('x')} AS text FROM worded) JOIN known USING (text) GROUP BY 1, 2, 3),
    taken AS (SELECT doc_id, pos, list_reduce(list({{'i': i, 'n': n, 'ids': [id]}} ORDER BY i), lambda a, b: CASE WHEN b.i >= a.i + a.n THEN {{'i': b.i, 'n': b.n, 'ids': list_concat(a.ids, b.ids)}} ELSE a END).ids AS ids FROM best GROUP BY 1, 2),
    every AS (SELECT * FROM taken UNION ALL SELECT doc_id, pos, [id] FROM (SELECT doc_id, pos, {wording('x')} AS text FROM alone) JOIN known USING (text)),
    seqs AS (SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids FROM every GROUP BY doc_id),
    ruled AS (SELECT d.doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
      list_reduce(list_prepend({{'rest': coalesce('<' || array_to_string(ids, '><') || '>', ''), 'names': []::VARCHAR[], 'p': '', 'n': ''}}, [{rules}]),
        lambda a, b: CASE WHEN contains(a.rest, b.p) THEN {{'rest': replace(a.rest, b.p, '|'), 'names': list_append(a.names, b.n), 'p': '', 'n': ''}} ELSE a END) AS r FROM documents d LEFT JOIN seqs USING (doc_id))
    SELECT doc_id, array_to_string(list_sort(list_distinct(CASE WHEN contains(r.rest, '<') THEN list_append(r.names, '{UNKNOWN}') ELSE r.names END)), ',') AS licenses, sentence_ids FROM ruled
    """
