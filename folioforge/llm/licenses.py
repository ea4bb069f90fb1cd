"""Licence recognition by sentence rules, with DataFrame functions only.

A text is cut into sentences: after . ! ? ; or : before white space, at lines without a letter or digit, and after SPDX
lines; the dots of "v. 2" and of "Inc." within a sentence end none. Each is
normalised: lower case, runs of anything but letters and digits (also line breaks and comment marks) as one space. A
normalised sentence of a known licence notice maps to its identifier. If a sentence isn't known, the text before it may
lack a full stop: then it's also looked up from each line in it that begins with a capital, up to the next such lines
(as many as the longest known sentence has words). In SPDX lines a + behind a GPL's version says "or later". The identifiers of a text, in order, are matched against ordered licence rules, each a sequence of
identifiers with nothing known between them; what a rule has matched counts for no later one.

A null or empty text has no sentences and no licences. Repeated notices are counted once.
"""

from __future__ import annotations

import functools
import json

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences of published licence notices, by identifier.
NOTICES = {
    "apache-2-notice": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-0-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.',
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-endorse-author": "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-as-is": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-grant-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "free-program": "This program is free software;",
    "free-library": "This library is free software;",
    "free-file": "This file is free software;",
    "gpl-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl-2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl-3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3.",
    "gpl-2-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "gpl-3-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "lgpl-21-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-3-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation;",
    "agpl-3-later": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "version-2": "version 2 of the License.",
    "version-3": "version 3 of the License.",
    "either-2": "either version 2 of the License, or (at your option) any later version.",
    "either-21": "either version 2.1 of the License, or (at your option) any later version.",
    "either-3": "either version 3 of the License, or (at your option) any later version.",
    "gnu-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gnu-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "mpl-2-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "epl-2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl-1-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "unlicense-notice": "This is free and unencumbered software released into the public domain.",
    "cc0-dedication": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "spdx": "SPDX-License-Identifier:",
    "reserved": "All rights reserved.",
}
#: Of each licence its short names, which single-sentence notices and SPDX lines use.
NAMES = {
    "Apache-2.0": ["Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "MIT": ["MIT", "MIT License"],
    "MIT-0": ["MIT-0", "MIT No Attribution License"],
    "BSD-2-Clause": ["BSD-2-Clause", "BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD-3-Clause", "BSD 3-Clause License"],
    "ISC": ["ISC", "ISC License"],
    "0BSD": ["0BSD"],
    "GPL-2.0-only": ["GPL-2.0-only", "GPL-2.0", "GNU General Public License, version 2", "GNU General Public License v2.0"],
    "GPL-2.0-or-later": ["GPL-2.0-or-later"],
    "GPL-3.0-only": ["GPL-3.0-only", "GPL-3.0", "GNU General Public License, version 3", "GNU General Public License v3.0"],
    "GPL-3.0-or-later": ["GPL-3.0-or-later"],
    "LGPL-2.1-only": ["LGPL-2.1-only", "GNU Lesser General Public License, version 2.1"],
    "LGPL-2.1-or-later": ["LGPL-2.1-or-later"],
    "LGPL-3.0-only": ["LGPL-3.0-only", "GNU Lesser General Public License, version 3"],
    "LGPL-3.0-or-later": ["LGPL-3.0-or-later"],
    "AGPL-3.0-only": ["AGPL-3.0-only", "GNU Affero General Public License, version 3"],
    "AGPL-3.0-or-later": ["AGPL-3.0-or-later"],
    "MPL-2.0": ["MPL-2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0"],
    "EPL-1.0": ["EPL-1.0", "Eclipse Public License 1.0"],
    "EPL-2.0": ["EPL-2.0", "Eclipse Public License 2.0"],
    "Zlib": ["Zlib", "zlib License"],
    "BSL-1.0": ["BSL-1.0", "Boost Software License, Version 1.0"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0-1.0", "CC0 1.0", "Creative Commons CC0 1.0 Universal License"],
} | {
    f"CC-{code}-4.0": [f"CC-{code}-4.0", f"CC {code} 4.0", f"Creative Commons {name} 4.0 International License", f"Creative Commons {name} 4.0 International"]
    for code, name in {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}.items()
}
#: What single-sentence notices begin with, and what it is normalised to.
OPENING, OPENED = r"^(?:this (?:work|project|software|program|file) is )?(?:licensed|released|distributed) under (?:the |a )?", "licensed under "
#: Whose name may not be used differs from notice to notice.
OWNER, OWNED = r"^neither the name of .* nor the names of its contributors", "neither the name of the copyright holder nor the names of its contributors"
#: Words that a sentence may have more than in its normalised form: openings, and an owner's name.
OPENED_MORE = 12
#: Licence rules over notices, in order; the longer ones stand before those whose sentences they hold.
RULES = [
    ("Apache-2.0", ["apache-2-notice", "apache-comply"]),
    ("MIT-0", ["mit-0-grant"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-author"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-grant-and"]),
    ("0BSD", ["0bsd-grant"]),
    *((f"{family}-{number}{kind}", [free, *terms]) for free in ("free-program", "free-library", "free-file") for family, number, kind, terms in (
        ("GPL", "2.0", "-or-later", ["gpl-terms", "either-2"]), ("GPL", "2.0", "-or-later", ["gpl-2-later"]), ("GPL", "2.0", "-only", ["gpl-terms", "version-2"]), ("GPL", "2.0", "-only", ["gpl-2-terms"]),
        ("GPL", "3.0", "-or-later", ["gpl-terms", "either-3"]), ("GPL", "3.0", "-or-later", ["gpl-3-later"]), ("GPL", "3.0", "-only", ["gpl-terms", "version-3"]), ("GPL", "3.0", "-only", ["gpl-3-terms"]),
        ("LGPL", "2.1", "-or-later", ["lgpl-terms", "either-21"]), ("LGPL", "2.1", "-or-later", ["lgpl-21-later"]), ("LGPL", "3.0", "-or-later", ["lgpl-terms", "either-3"]), ("LGPL", "3.0", "-or-later", ["lgpl-3-later"]),
        ("AGPL", "3.0", "-or-later", ["agpl-terms", "either-3"]), ("AGPL", "3.0", "-or-later", ["agpl-3-later"]),
    )),
    ("MPL-2.0", ["mpl-2-terms"]),
    ("EPL-2.0", ["epl-2-terms"]),
    ("EPL-1.0", ["epl-1-terms"]),
    ("Zlib", ["zlib-as-is", "zlib-grant"]),
    ("BSL-1.0", ["boost-grant"]),
    ("Unlicense", ["unlicense-notice"]),
    ("CC0-1.0", ["cc0-dedication"]),
    *((name, ["spdx", f"name-{name}"]) for name in NAMES),
    *((name, [f"line-{name}"]) for name in NAMES),
]
#: Of these each known sentence has one; texts without any have none.
HINTS = ["licen", "software", "permission", "redistribution", "acknowledgement", "warrant", "neighboring", "reserved", "domain", "accompanying", "distributed", "released"]
_DOT, _LINE = r"\b([vV])\.(?=[ \t\n\x0b\f\r]*\d)|\b(Inc|Ltd|Corp|Co)\.(?=[ \t\n\x0b\f\r]+[a-z])", r"(SPDX-License-Identifier:[^\r\n]*)"
#: In SPDX lines: a version or a later one.
_LATER, LATER = r"\b((?:A|L)?GPL-\d\.\d)\+", "$1-or-later"
_CUT = r"(?<=[.!?;:])[ \t\n\x0b\f\r]+|\n[^\p{L}\p{N}\n]*\n[^\p{L}\p{N}]*"
_CAPITAL = r"[\r\n]+(?=[^\p{L}\p{N}\r\n]*\p{Lu})"


def known() -> dict[str, str]:
    """Normalised sentences and their identifiers."""
    plain = lambda s: regex.sub(OPENING, OPENED, regex.sub(r"[^\p{L}\p{N}]+", " ", s.lower()).strip())
    found = {plain(s): i for i, s in NOTICES.items()}
    for name, short in NAMES.items():
        for s in short:
            found |= {plain(s): f"name-{name}", plain(f"Licensed under {s}"): f"line-{name}"}
    return found


def normalised(sentence: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))
    return F.regexp_replace(F.regexp_replace(plain, OPENING, OPENED), OWNER, OWNED)


def sentence_ids(text: Column) -> Column:
    """Identifiers of a text's known licence sentences, in order.

    Only sentences with a line that begins with the first two words of some known sentence are normalised and looked up.
    """
    table = known()
    heads = "|".join(sorted({r"[^\p{L}\p{N}]+".join(s.split(" ")[:2]) for s in [*table, *(f"this {x} is" for x in ("work", "project", "software", "program", "file")), "released under", "distributed under"]}, key=lambda x: (-len(x), x)))
    begins = rf"(?:^|[\r\n])[^\p{{L}}\p{{N}}]*+(?i:{heads})(?![\p{{L}}\p{{N}}])"
    at = F.str_to_map(F.lit("|".join(f"{s}={i}" for s, i in sorted(table.items()))), F.lit("\\|"), F.lit("="))  # folded once
    look = lambda s: F.try_element_at(at, normalised(s))
    most = max(len(s.split(" ")) for s in table) + OPENED_MORE
    whole = F.coalesce(text, F.lit(""))
    has = lambda x, words: functools.reduce(lambda p, q: p | q, [x.contains(w) for w in words])
    dotted = F.when(has(whole, ["v.", "V.", "Inc.", "Ltd.", "Corp.", "Co."]), F.regexp_replace(whole, _DOT, "$1$2")).otherwise(whole)
    lined = F.when(whole.contains("SPDX"), F.regexp_replace(F.regexp_replace(dotted, _LATER, LATER), _LINE, "$1\n\n")).otherwise(dotted)
    sentences = F.filter(F.split(lined, _CUT), lambda s: s.rlike(begins))

    def lines(s: Column) -> Column:
        parts = F.split(s, _CAPITAL)
        run = lambda i, k: F.array_join(F.slice(parts, i + 1, k), " ")
        # every line has a word or more, so a known sentence is wrapped into no more lines than it has words
        counts = lambda i: F.sequence(F.lit(1), F.least(F.size(parts) - i, F.lit(most)))
        first = lambda i: F.get(F.filter(F.transform(counts(i), lambda k: look(run(i, k))), lambda x: x.isNotNull()), 0)
        return F.filter(F.transform(parts, lambda _, i: F.when(run(i, 2).rlike(begins), first(i))), lambda x: x.isNotNull())

    # each sentence's identifier is made once: transform binds it to a variable
    ids = F.flatten(F.transform(sentences, lambda s: F.transform(F.array(look(s)), lambda x: F.when(x.isNotNull(), F.array(x)).otherwise(lines(s)))[0]))
    # a short name says something on an SPDX line only
    ids = F.transform(F.array(ids), lambda own: F.filter(own, lambda x, i: ~x.startswith("name-") | F.coalesce(F.get(own, i - 1) == "spdx", F.lit(False))))[0]
    return F.when(has(F.lower(whole), HINTS), ids).otherwise(F.array().cast("array<string>"))


def licenses(ids: Column) -> Column:
    """Licences whose rule's identifiers follow one another in `ids`: distinct, in the rules' order.

    The rules are tried in order, and identifiers that one has matched are gone for the next.
    """
    rules = F.from_json(F.lit(json.dumps([{"name": name, "ids": f" {'  '.join(rule)} "} for name, rule in RULES])), "array<struct<name:string,ids:string>>")
    joined = F.array_join(F.transform(ids, lambda x: F.concat(F.lit(" "), x, F.lit(" "))), "")
    start = F.struct(joined.alias("left"), F.array().cast("array<string>").alias("found"))
    step = lambda acc, r: F.when(acc["left"].contains(r["ids"]), F.struct(F.replace(acc["left"], r["ids"], F.lit(" | ")).alias("left"), F.array_append(acc["found"], r["name"]).alias("found"))).otherwise(acc)
    return F.when(F.size(ids) > 0, F.array_distinct(F.aggregate(rules, start, step, lambda acc: acc["found"]))).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of docs and sentence_ids and licenses; no shuffle."""
    if {"sentence_ids", "licenses"} & set(docs.columns):
        raise ValueError("docs already has a column sentence_ids or licenses")
    return docs.withColumn("sentence_ids", sentence_ids(F.col(text))).withColumn("licenses", licenses(F.col("sentence_ids")))
