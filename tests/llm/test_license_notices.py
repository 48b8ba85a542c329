"""Licence notices in the form in which they are published."""

import re

import duckdb

from tests.llm.conftest import frame
from tidewater.llm import license_scan

MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
APACHE = """Copyright 2020 Somebody

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License along
with this program; if not, write to the Free Software Foundation, Inc.,
51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.
"""
GPL3 = GPL2.replace("software; you", "software: you").replace("Foundation; either version 2", "Foundation, either version 3").replace(
    "; if not, write to the Free Software Foundation, Inc.,\n51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    ".  If not, see <https://www.gnu.org/licenses/>.")
LGPL = GPL2.replace("This program", "This library").replace("this program", "this library").replace(
    "General", "Lesser General").replace("version 2 ", "version 2.1 ")
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
CC = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0\nInternational License."
BSD_TERMS = """Copyright (c) 2020, Somebody
All rights are kept.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_ADS = """
3. All advertising materials mentioning features or use of this software must
   display the following acknowledgement:
   This product includes software developed by Somebody.
"""
BSD_NAMES = [f"\n3. {names} used to endorse or\n   promote products derived from this software without specific prior\n   written permission.\n" for names in (
    "Neither the name of the copyright holder nor the names of its\n   contributors may be", "Neither the name of the Example Project nor the names of its\n   contributors may be",
    "Neither the name of Example Inc. nor the names of its\n   contributors may be", "The name of the author may not be",
    "The names of its contributors may not be", "Neither the names of the University of Somewhere, Elsewhere nor\n   the names of any of its staff may be")]
BSD_END = "\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS THEY HAVE IT.\n"
ZLIB = """This software is provided 'as-is', without any express or implied
warranty.  In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software.
"""
BSL = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:

The copyright notices in the Software and this entire statement, including
the above license grant, this restriction and the following disclaimer,
must be included in all copies of the Software, in whole or in part, and
all derivative works of the Software, unless such copies or derivative
works are solely in the form of machine-executable object code generated by
a source language processor.
"""
TITLES = [("                  Apache License\n            Version 2.0, January 2004\n         http://www.apache.org/licenses/\n\n1. Definitions.\n", "Apache-2.0"),
          ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nPreamble\n", "GPL-3.0"),
          ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n\nPreamble\n", "GPL-2.0"),
          ("GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007\n\n", "AGPL-3.0")]
NOTICES = [(MIT, "MIT"), (APACHE, "Apache-2.0"), (GPL2, "GPL-2.0-or-later"), (GPL3, "GPL-3.0-or-later"),
           (LGPL, "LGPL-2.1-or-later"), (MPL, "MPL-2.0"), (CC, "CC-BY-SA-4.0"),
           (BSD_TERMS + BSD_END, "BSD-2-Clause"), *((BSD_TERMS + names + BSD_END, "BSD-3-Clause") for names in BSD_NAMES),
           (BSD_TERMS + BSD_ADS + BSD_NAMES[1] + BSD_END, "BSD-4-Clause"), (ZLIB, "Zlib"), (BSL, "BSL-1.0")]
LINES = [("GPL-2.0-only", ["GPL-2.0-only"], 0), ("LGPL-2.1-or-later", ["LGPL-2.1-or-later"], 0), ("GPL-2.0+", ["GPL-2.0-or-later"], 0),
         ("(MIT OR Apache-2.0)", ["Apache-2.0", "MIT"], 0), ("GPL-2.0-only WITH Classpath-exception-2.0", ["GPL-2.0-only"], 0),
         ("MIT AND (LGPL-2.1-or-later OR BSD-3-Clause)", ["BSD-3-Clause", "LGPL-2.1-or-later", "MIT"], 0),
         ("MIT OR LicenseRef-Own", ["MIT"], 1), ("LicenseRef-Own", [], 1)]


def _commented(text, lead):
    return "int before;\n" + "".join(f"{lead} {line}".rstrip() + "\n" for line in text.splitlines()) + "int after = 1;\n"


def _scan(spark, texts):
    rows = license_scan.scan_licences(frame(spark, list(enumerate(texts)), 2)).collect()
    return [(sorted(r.licences), r.n_unknown) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_published_notices(spark):
    forms = [lambda t: t, lambda t: _commented(t, "#"), lambda t: _commented(t, "//"), lambda t: _commented(t, ";;"),
             lambda t: _commented(t, "--"), lambda t: "/*\n" + _commented(t, " *").split("\n", 1)[1] + " */\n",
             lambda t: t.replace("\n", "\r\n"), lambda t: re.sub(r"(?<!\n)\n(?!\n)", " ", t)]
    got = _scan(spark, [form(t) for t, _ in NOTICES for form in forms])
    assert got == [([name], 0) for _, name in NOTICES for _ in forms]


def test_spdx_lines(spark):
    got = _scan(spark, [form.format(x) for x, _, _ in LINES
                        for form in ("SPDX-License-Identifier: {}", "// SPDX-License-Identifier: {}\nint x;", "/* SPDX-License-Identifier: {} */\n")])
    assert got == [(names, n) for _, names, n in LINES for _ in range(3)]


def test_titles_of_full_texts(spark):
    assert _scan(spark, [t for t, _ in TITLES]) == [([name], 0) for _, name in TITLES]


def test_free_parts_are_bounded_and_need_their_ends(spark):
    many = "Neither the name of " + "very " * 60 + "long nor another may be used to endorse or promote products derived from this"
    half = "Neither the name of the owner may be used to endorse or promote products"
    long = ("the name\n" * 50_000) + "endorse or promote products derived from it"
    rows = license_scan.scan_licences(frame(spark, list(enumerate([many, half, long])), 2)).orderBy("doc_id").collect()
    assert [r.sentence_ids for r in rows] == [[], [], ["bsd.names"]]


def test_runs_of_lines_and_lines_between(spark):
    got = _scan(spark, ["words before\nLicensed under the\nMIT License\nwords after", "a license\nReleased under\n\nMIT",
                        "Licensed under the MIT License\nand a strange license\nReleased under the ISC License"])
    assert got == [(["MIT"], 0), ([], 1), (["ISC", "MIT"], 1)]


def test_every_published_sentence_is_found_hinted_and_ruled(spark):
    known = sorted(license_scan.ALL_SENTENCES)
    assert all(any(re.search(h, s) for h in license_scan.HINTS) for s in known)
    rows = license_scan.scan_licences(frame(spark, list(enumerate(known)))).collect()
    assert {r.doc_id: (r.sentence_ids, r.n_unknown) for r in rows} == {
        i: ([license_scan.ALL_SENTENCES[s]], 0) for i, s in enumerate(known)}
    assert all(len(r.licences) == 1 for r in rows if r.sentence_ids[0].startswith("ref."))


def test_rows_equal_the_sql_on_a_larger_table(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.sql(license_scan.OP1_SQL).fetchall())
    assert sorted(tuple(r) for r in license_scan.op1_license_scan(spark, sf).collect()) == want
