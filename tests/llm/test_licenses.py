"""The license scan on usual layouts, against its SQL and literal results."""

import re
import textwrap

import duckdb
import pytest

from lakestrata.llm import license_scan

MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    'the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and '
    'to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
)
BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
]
APACHE = (
    '# Licensed under the Apache License, Version 2.0 (the "License");\n'
    "# you may not use this file except in compliance with the License.\n"
    "# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0\n"
)


def commented(text, mark, width=60):
    return "\n".join(f"{mark} {line}" for line in textwrap.wrap(text, width))


ROWS = [
    (1, textwrap.fill(MIT, 76)),
    (2, commented(MIT, " *")),
    (3, "\n".join(textwrap.fill(x, 50) for x in BSD)),
    (4, APACHE),
    (5, "some prose\nAll rights reserved.\nLicensed under CC BY-NC 4.0.\nmore prose"),
    (6, "This work is licensed under a Creative Commons Attribution-\nShareAlike 4.0 International License."),
    (7, "// SPDX-License-Identifier: GPL-3.0-or-later\n"),
    (8, "This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License."),
    (9, "\n".join([BSD[2], BSD[1]])),
    (10, "We do not say it is released under the mit license or so.\nPublic rights"),
    (11, None),
    (11, ""),
    (12, "All rights reserved.\n\n" * 2_000),
    (13, BSD[1]),
    (13, BSD[2]),
    (None, "Released under the MIT licence"),
    (14, "free\n" * 30_000 + "all\nrights\nreserved"),
]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    return {(r.doc_id, r.license, r.n_sentences) for r in license_scan.scan(docs).collect()}


def test_usual_layouts(found):
    assert found == {
        (1, "MIT", 1), (2, "MIT", 1), (3, "BSD", 3), (3, "BSD-2-Clause", 3), (4, "Apache-2.0", 3),
        (5, "Proprietary", 2), (5, "CC-BY-NC-4.0", 2), (6, "CC-BY-SA-4.0", 1), (7, "GPL-3.0", 1),
        (8, "GPL-3.0", 2), (8, "MIT", 2), (12, "Proprietary", 2_000), (14, "Proprietary", 1), (None, "MIT", 1),
    }


def test_sql_gives_the_same(found):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", ROWS)
    assert set(db.execute(license_scan.oracle()).fetchall()) == found


def test_lists_hold_what_the_scan_assumes():
    known = license_scan.sentences()
    assert all(re.search(license_scan.HINTS, s) for s in known if not s.startswith("grant "))
    assert all(re.search(license_scan.HINTS, s.removeprefix("grant ")) for s in known if s.startswith("grant "))
    widest = "the document is made available under the terms of the " + license_scan.GRANT_END
    assert len(widest) <= license_scan.WORDING


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, license int, ids int, n_sentences int")
    assert license_scan.scan(empty).count() == 0
    odd = spark.createDataFrame([(1, "Released under the MIT License", 5, 6)], "doc_id long, text string, license int, ids int")
    assert [tuple(r) for r in license_scan.scan(odd).collect()] == [(1, "MIT", 1)]
