"""Licences from their published notices, word for word, as files wrap and mark them."""

import duckdb
import pytest

from folioforge.llm import licenses, oracles

APACHE = """Copyright 2024 Some Body

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
MIT = """MIT License

Copyright (c) 2024 Some Body

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Copyright (c) 2024, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
ENDORSE = """
3. Neither the name of %s nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ADVERT = """
3. All advertising materials mentioning features or use of this software must
   display the following acknowledgement:
   This product includes software developed by the organization.
"""
GPL_3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
GPL_2 = """ * This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License
 * as published by the Free Software Foundation; either version 2
 * of the License, or (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
AGPL = GPL_3.replace("GNU General", "GNU Affero General")
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
EPL = """ * This program and the accompanying materials are made
 * available under the terms of the Eclipse Public License 2.0
 * which is available at https://www.eclipse.org/legal/epl-2.0/
"""
ZLIB = """  This software is provided 'as-is', without any express or implied
  warranty.  In no event will the authors be held liable for any damages
  arising from the use of this software.

  Permission is granted to anyone to use this software for any purpose,
  including commercial applications, and to alter it and redistribute it
  freely, subject to the following restrictions:
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
BOOST = """Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:
"""
UNLICENSE = "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish\n"
CC0 = "To the extent possible under law, the author(s) have dedicated all copyright\nand related and neighboring rights to this software to the public domain\nworldwide. This software is distributed without any warranty.\n"


def marked(text, mark):
    return "".join(f"{mark}{line}\n" for line in text.split("\n"))


CASES = [
    (APACHE, ["Apache-2.0"]), (marked(APACHE, "# "), ["Apache-2.0"]), (marked(APACHE, " * "), ["Apache-2.0"]), (MIT, ["MIT"]), (marked(MIT, "// "), ["MIT"]), (MIT.replace("\n", "\r\n"), ["MIT"]), (" ".join(MIT[MIT.index("Permission") :].split()), ["MIT"]),
    (MIT.replace(", subject to the following conditions:", "."), ["MIT-0"]), (BSD % "", ["BSD-2-Clause"]), (BSD % (ENDORSE % "the copyright holder"), ["BSD-3-Clause"]), (BSD % (ENDORSE % "Some Body, Inc."), ["BSD-3-Clause"]), (BSD % ADVERT, ["BSD-4-Clause"]),
    (GPL_3, ["GPL-3.0-or-later"]), (GPL_2, ["GPL-2.0-or-later"]), (GPL_2.replace("either version 2\n * of the License, or (at your option) any later version", "version 2 of the License"), ["GPL-2.0-only"]), (LGPL, ["LGPL-2.1-or-later"]), (AGPL, ["AGPL-3.0-or-later"]),
    (LGPL.replace("; either\nversion 2.1", ", either\nversion 3"), ["LGPL-3.0-or-later"]), (MPL, ["MPL-2.0"]), ("A title without an end\n" + MPL, ["MPL-2.0"]), (EPL, ["EPL-2.0"]), (ZLIB, ["Zlib"]), (ISC, ["ISC"]), (BOOST, ["BSL-1.0"]), (UNLICENSE, ["Unlicense"]), (CC0, ["CC0-1.0"]),
    (APACHE + "\n" + MIT, ["Apache-2.0", "MIT"]), (MIT + BSD % "", ["MIT", "BSD-2-Clause"]), ("words before it\n" + GPL_3 + "and words after", ["GPL-3.0-or-later"]), (" " * 300 + "Licensed under CC BY 4.0.", ["CC-BY-4.0"]),
    ("Some words.\nLicensed under the Apache License, Version 2.0.", ["Apache-2.0"]), ("Released under the MIT License.\nReleased under the MIT License.", ["MIT"]), ("x. This work is licensed under the GNU General Public License, version 3. y", ["GPL-3.0-only"]),
    ("Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", ["MIT", "CC-BY-NC-4.0"]), ("no full stop\nReleased under the MIT License\nMore words", ["MIT"]), ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", ["CC-BY-ND-4.0"]),
    ("// SPDX-License-Identifier: GPL-2.0-or-later\n#include <x>", ["GPL-2.0-or-later"]), ("# SPDX-License-Identifier: Apache-2.0\n\nimport x", ["Apache-2.0"]), ("This program is free software; nothing else.", []), ("MIT", []), ("Mit. License. MIT. ISC.", []), ("licensed under", []), (None, []), ("", []), ("a " * 100_000, []), ("A\n" * 1_000, []),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "doc_id long, text string")


def test_published_notices(table):
    got = {r.doc_id: r.licenses for r in licenses.scan(table).collect()}
    assert {i: (c[0] or "")[:60] for i, c in enumerate(CASES) if got[i] != c[1]} == {}


def test_sql_agrees_on_notices(table):
    """The SQL, whose tables are its own, on the same notices."""
    import duckdb

    from folioforge.llm import oracles

    con = duckdb.connect()
    con.register("documents", table.toPandas())
    want = {r[0]: r[1:] for r in con.execute(oracles.licensed()).fetchall()}
    got = {r.doc_id: (len(r.sentence_ids), ",".join(r.sentence_ids), ",".join(r.licenses)) for r in licenses.scan(table).collect()}
    assert got == want


def test_every_known_sentence_has_a_hint():
    assert [s for s, i in licenses.known().items() if not i.startswith("name-") and not any(h in s for h in licenses.HINTS)] == []


def test_every_raw_opening_has_a_hint():
    """Texts are sought for hints as they are, so each way to begin a notice needs one, not only the normalised one."""
    for opening in ("Licensed", "Released", "Distributed", "This work is licensed", "This program is released", "This file is distributed"):
        assert any(h in f"{opening} under MIT.".lower() for h in licenses.HINTS), opening


SHORT = [
    ("Released under MIT.", "MIT"), ("Released under 0BSD.", "0BSD"), ("Released under the ISC License.", "ISC"), ("This work is released under CC BY 4.0.", "CC-BY-4.0"), ("Distributed under Zlib.", "Zlib"),
    ("SPDX-License-Identifier: GPL-2.0+\n", "GPL-2.0-or-later"), ("// SPDX-License-Identifier: LGPL-2.1+\nint x;", "LGPL-2.1-or-later"), ("SPDX-License-Identifier: GPL-2.0\n", "GPL-2.0-only"), ("about C++ and GPL-2.0+ in general", ""),
    ("An unfinished line\n" + "\n".join("Licensed Under The Apache License Version 2.0".split(" ")), "Apache-2.0"),
]


@pytest.mark.parametrize("text, want", SHORT)
def test_short_notices_by_operator_and_sql(spark, text, want):
    """Also a notice wrapped into more lines than a few, each of which begins with a capital."""
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert ",".join(licenses.scan(df).first()["licenses"]) == want
    c = duckdb.connect()
    c.execute("CREATE TABLE documents AS SELECT 1::BIGINT AS doc_id, ? AS text", [text])
    assert c.execute(f"SELECT licenses FROM ({oracles.licensed()})").fetchone()[0] == want
