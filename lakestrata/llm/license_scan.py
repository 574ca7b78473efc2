"""License scans: normalised sentences become identifiers, and identifier sequences match licence rules."""

from __future__ import annotations

from itertools import product

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import CAPITALS, lower_ascii, text_or_empty

# Normalised names that a grant can give a licence.
NAMES = {
    "MIT": ["mit license", "mit licence", "expat license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2", "gnu gpl v2", "gplv2"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3", "gnu gpl v3", "gplv3"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1", "gnu lesser general public license v2 1"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lesser general public license v3"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu affero general public license v3"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license v2 0", "eclipse public license 2 0"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"],
    "BSD": ["bsd license", "bsd style license"],
    "ISC": ["isc license"],
    "Zlib": ["zlib license"],
    "Unlicense": ["unlicense"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0"],
}
# The words of a Creative Commons licence for each of its short terms.
TERMS = {"by": "attribution", "nc": "noncommercial", "sa": "sharealike", "nd": "noderivatives"}
CC_KINDS = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]
CC_VERSIONS = ["2 0", "2 5", "3 0", "4 0"]
# How a grant begins and ends around a licence name.
GRANT = (
    "(?:it is |(?:this|the) (?:work|software|project|program|file|code|library|document) is )?"
    "(?:licensed|released|distributed|available|published|made available|provided) under "
    "(?:(?:the )?terms of the |the |a )?"
)
GRANT_END = " the license"
GRANT_STARTS = ["it", "this", "the", "licensed", "released", "distributed", "available", "published", "made", "provided"]
SPDX = "spdx-license-identifier:"  # its colon ends no sentence
# Known sentences of licence texts and notices.
TEXTS = {
    "reserved": ["all rights reserved"],
    "mit-grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions"
    ],
    "mit-notice": [
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software"
    ],
    "bsd-grant": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met"
    ],
    "bsd-source": [
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer"
    ],
    "bsd-binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution"
    ],
    "bsd-names": [
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission"
    ],
    "apache-use": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at"],
    "gpl-free": ["this program is free software"],
    "gpl-copy": ["you should have received a copy of the gnu general public license along with this program"],
    "isc-grant": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies"
    ],
    "mpl-notice": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "this source code form is subject to the terms of the mozilla public license version 2 0",
    ],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "public-domain": ["this work is in the public domain", "released into the public domain"],
}
# The ordered sentences of each rule over TEXTS; a grant of a named licence is a rule of its own.
RULES = [
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-notice"]),
    ("Apache-2.0", ["apache-use", "apache-copy"]),
    ("GPL", ["gpl-free", "gpl-copy"]),
    ("BSD", ["bsd-source", "bsd-binary"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("ISC", ["isc-grant"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("Unlicense", ["unlicense"]),
    ("Public-Domain", ["public-domain"]),
    ("Proprietary", ["reserved"]),
]
# A sentence ends at its mark or at a line without letters and digits; other line breaks may lie within it.
BREAK = r"""[.!?;:]+["')\]]*([ \t\r\n]+|$)|\n[^a-z0-9\n]*\n"""
OTHER = "[^a-z0-9]+"
WORDING = 100  # characters that the wording of a grant adds at most (tested)
#: Every known sentence has one of these words (tested), so texts without any are not read further.
HINTS = r"licen|rights|permission|redistribution|public|free|gpl|creative|\bcc\b"


def names() -> dict[str, list[str]]:
    """Licence names with the Creative Commons family, from its terms and versions."""
    found = dict(NAMES)
    for kind, version in product(CC_KINDS, CC_VERSIONS):
        full = " ".join(TERMS[t] for t in kind.split())
        found[f"CC-{kind.upper().replace(' ', '-')}-{version.replace(' ', '.')}"] = [
            f"cc {kind} {version}", f"cc {kind} {version} license",
            f"creative commons {full} {version}", f"creative commons {full} {version} license",
            f"creative commons {full} {version} international license",
            f"creative commons {full} {version} unported license",
        ]
    return found


def identifiers() -> list[str]:
    """Sentence kinds; a kind's place from 1 is its identifier."""
    return [*TEXTS, *(f"grant-{n}" for n in names())]


def sentences() -> dict[str, int]:
    """Identifier of each known sentence; the many wordings of a grant are known as ``grant`` and the name."""
    number = {kind: k for k, kind in enumerate(identifiers(), 1)}
    known = {s: number[kind] for kind, texts in TEXTS.items() for s in texts}
    for name, texts in names().items():
        known |= {f"grant {text}": number[f"grant-{name}"] for text in texts}
        spdx = "spdx license identifier " + regex.sub(OTHER, " ", name.lower())
        known |= {spdx + version: number[f"grant-{name}"] for version in ("", " only", " or later")}
    return known


def normal(sentence: str) -> str:
    """A grant in its one wording; any other sentence as it is."""
    start = regex.match(GRANT, sentence)
    return f"grant {sentence[start.end():].removesuffix(GRANT_END)}" if start else sentence


def rules() -> list[tuple[str, list[int]]]:
    number = {kind: k for k, kind in enumerate(identifiers(), 1)}
    return [*((n, [number[k] for k in kinds]) for n, kinds in RULES), *((n, [number[f"grant-{n}"]]) for n in names())]


def pattern(ids: list[int]) -> str:
    """The identifiers in order, others between them allowed, in text like ``,3,9,``."""
    return "".join(("" if k == 0 else "(.*,)?") + f"{i}," for k, i in enumerate(ids))


def recognised(text: str, known: dict[str, int], longest: int, starts: set[str]) -> list[int]:
    """Identifiers of the known sentences of a lower-case text, by their first line, the shorter first.

    A sentence is a run of whole lines of one paragraph; a run longer than every known sentence, or with a first word
    that is not among ``starts``, is none.
    """
    found = []
    for paragraph in regex.split(BREAK.replace("(", "(?:", 1), text):
        lines = [line for line in (regex.sub(OTHER, " ", x).strip() for x in paragraph.split("\n")) if line]
        for at in range(len(lines)):
            run = lines[at]
            if run.partition(" ")[0] not in starts:
                continue
            for line in [*lines[at + 1 :], ""]:
                sid = known.get(normal(run))
                if sid:
                    found.append(sid)
                run = f"{run} {line}"
                if len(run) > longest:
                    break
    return found


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, license, n_sentences (recognised ones): one row per document and licence found.

    Texts are whole; wrapped lines are joined and marks of comments ignored.  Null and empty texts and empty tables
    give no rows.  Each row is scanned by itself: rows of one id are not mixed, and give one row per licence with the
    most sentences; a null id is an id.  Other columns are not read.
    """
    known = sentences()
    longest = max(map(len, known)) + WORDING
    starts = {s.partition(" ")[0] for s in known} | set(GRANT_STARTS)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: recognised(t, known, longest, starts))

    body = F.replace(lower_ascii(text_or_empty(F.col(text))), F.lit(SPDX), F.lit(SPDX[:-1] + " "))
    hinted = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body")).where(F.col("body").rlike(HINTS))
    found = hinted.select("doc_id", ids("body").alias("ids")).where(F.size("ids") > 0)
    joined = F.concat(F.lit(","), F.array_join("ids", ","), F.lit(","))
    matching = [F.when(F.rlike(joined, F.lit("," + pattern(i))), F.lit(n)) for n, i in rules()]
    licenses = F.array_distinct(F.array_compact(F.array(*matching)))
    each = found.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.explode(licenses).alias("license"))
    return each.groupBy("doc_id", "license").agg(F.max("n_sentences").alias("n_sentences"))


def oracle() -> str:
    """SQL for ``scan``: here sentences are expressions over the marked text, not runs of lines looked up.

    ``/`` stands twice for a line break and ``|`` twice for the end of a sentence; all else is words.
    """
    gap = "(?: / / | )"
    kinds = [f"(?:{'|'.join(texts)})" for texts in TEXTS.values()]
    for name, texts in names().items():
        spdx = regex.sub(OTHER, " ", name.lower())
        kinds.append(f"(?:{GRANT}(?:{'|'.join(texts)})(?:{GRANT_END})?|spdx license identifier {spdx}(?: only| or later)?)")
    marks = ", ".join(f"({k}, '{kind.replace(' ', gap)}')" for k, kind in enumerate(kinds, 1))
    ruled = ", ".join(f"('{n}', ',{pattern(i)}')" for n, i in rules())
    end = BREAK.replace("'", "''").replace("(", "(?:", 1)
    return f"""
WITH low AS (
  SELECT doc_id, row_number() OVER () AS r, 
    replace(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), '{SPDX}', '{SPDX[:-1]} ') AS t
  FROM documents),
hinted AS (SELECT doc_id, r, t FROM low WHERE regexp_matches(t, '{HINTS}')),
marked AS (
  SELECT doc_id, r, replace(replace(trim(regexp_replace(replace(replace(
    regexp_replace(regexp_replace(t, '[\\x01\\x02]', ' ', 'g'), '{end}', chr(1), 'g'), chr(10), chr(2)), chr(1), chr(2) || chr(1) || chr(2)),
    '[^a-z0-9\\x01\\x02]+', ' ', 'g')), chr(1), ' | | '), chr(2), ' / / ') AS m
  FROM hinted),
plain AS (
  SELECT doc_id, r, ' / / ' || regexp_replace(regexp_replace(regexp_replace(m, ' +', ' ', 'g'),
    '/ / (?:/ / )+', '/ / ', 'g'), '(?:/ / )?(?:[|] [|] )+(?:/ / )?', '| | ', 'g') || ' / / ' AS m FROM marked),
kinds(sid, expression) AS (VALUES {marks}),
pieces AS (
  SELECT doc_id, r, sid, regexp_extract_all(m, expression) AS hit, regexp_split_to_array(m, expression) AS rest
  FROM (SELECT doc_id, r, sid, regexp_replace(m, ' +', ' ', 'g') AS m, '[/|] ' || expression || ' [/|]' AS expression
        FROM plain, kinds)),
places AS (SELECT *, unnest(range(1, len(hit) + 1)) AS j FROM pieces WHERE len(hit) > 0),
hits AS (
  SELECT doc_id, r, sid, length(hit[j]) AS size, list_sum(list_transform(rest[1:j], lambda x: length(x)))
    + coalesce(list_sum(list_transform(hit[1:j - 1], lambda x: length(x))), 0) AS pos
  FROM places),
found AS (
  SELECT doc_id, r, count(*) AS n_sentences, ',' || string_agg(sid, ',' ORDER BY pos, size) || ',' AS ids
  FROM hits GROUP BY doc_id, r),
rules(license, rule) AS (VALUES {ruled})
SELECT doc_id, license, max(n_sentences) AS n_sentences
FROM found JOIN rules ON regexp_matches(ids, rule) GROUP BY doc_id, license
"""
