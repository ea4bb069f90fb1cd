"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

import re

from . import urls

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def texts(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def site_verdicts(rules: list[tuple[str, str]]) -> str:
    rows = ", ".join(f"('{verdict}', '{site}', '{site.partition('/')[0]}', '/{site.partition('/')[2]}')" for verdict, site in rules)
    return rf"""WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS s FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(s, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(s, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(verdict, rule, h, p) AS (VALUES {rows}),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(r.verdict, length(rule)) AS verdict FROM parts JOIN rules r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY 1)
SELECT a.page_id, host, path, rule, coalesce(verdict, CASE WHEN regexp_matches(host, '(^|[.-])({'|'.join(urls.SPAM_WORDS)})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict FROM parts a LEFT JOIN best b ON a.page_id = b.page_id"""


def contaminated() -> str:
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH items AS (SELECT item_id, {words} AS w FROM benchmark), docs AS (SELECT doc_id, {words} AS w FROM documents),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i + 1 : i + k], ' ') AS s FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(0, len(w) - least(13, len(w)) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (SELECT doc_id, k, i, array_to_string(w[i + 1 : i + k], ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM docs CROSS JOIN (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, p.k, item_id FROM places p JOIN windows v ON p.k = v.k AND p.s = v.s),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(d.w), false) AS contaminated
FROM docs d LEFT JOIN words w ON d.doc_id = w.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id"""


#: Known sentences as the notices print them, written down apart from the operator's table: identifier, sentence.
SENTENCES = """
apache-2-notice|Licensed under the Apache License, Version 2.0 (the "License")
apache-comply|you may not use this file except in compliance with the License
apache-copy|You may obtain a copy of the License at
apache-as-is|Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied
apache-see|See the License for the specific language governing permissions and limitations under the License
mit-grant|Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions
mit-0-grant|Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so
mit-condition|The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software
mit-as-is|THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT
mit-liability|IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE
bsd-grant|Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met
bsd-source|Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer
bsd-binary|Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution
bsd-advert|All advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-endorse|Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission
bsd-endorse-author|The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission
bsd-as-is|THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED
isc-grant|Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies
isc-grant-and|Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies
0bsd-grant|Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted
free-program|This program is free software
free-library|This library is free software
free-file|This file is free software
gpl-terms|you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation
gpl-2-terms|you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation
gpl-3-terms|you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3
gpl-2-later|you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version
gpl-3-later|you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version
lgpl-terms|you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation
lgpl-21-later|you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version
lgpl-3-later|you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version
agpl-terms|you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation
agpl-3-later|you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version
version-2|version 2 of the License
version-3|version 3 of the License
either-2|either version 2 of the License, or (at your option) any later version
either-21|either version 2.1 of the License, or (at your option) any later version
either-3|either version 3 of the License, or (at your option) any later version
gnu-hope|This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY
gnu-implied|without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE
mpl-2-terms|This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0
mpl-2-copy|If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/
epl-2-terms|This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/
epl-1-terms|This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html
zlib-as-is|This software is provided 'as-is', without any express or implied warranty
zlib-grant|Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions
boost-grant|Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following
unlicense-notice|This is free and unencumbered software released into the public domain
cc0-dedication|To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide
spdx|SPDX-License-Identifier
reserved|All rights reserved
"""
#: Short names of licences, apart from the operator's: licence, names.
SHORT = """
Apache-2.0|Apache-2.0|Apache License, Version 2.0|Apache License 2.0|Apache 2.0 License
MIT|MIT|MIT License
MIT-0|MIT-0|MIT No Attribution License
BSD-2-Clause|BSD-2-Clause|BSD 2-Clause License
BSD-3-Clause|BSD-3-Clause|BSD 3-Clause License
ISC|ISC|ISC License
0BSD|0BSD
GPL-2.0-only|GPL-2.0-only|GPL-2.0|GNU General Public License, version 2|GNU General Public License v2.0
GPL-2.0-or-later|GPL-2.0-or-later
GPL-3.0-only|GPL-3.0-only|GPL-3.0|GNU General Public License, version 3|GNU General Public License v3.0
GPL-3.0-or-later|GPL-3.0-or-later
LGPL-2.1-only|LGPL-2.1-only|GNU Lesser General Public License, version 2.1
LGPL-2.1-or-later|LGPL-2.1-or-later
LGPL-3.0-only|LGPL-3.0-only|GNU Lesser General Public License, version 3
LGPL-3.0-or-later|LGPL-3.0-or-later
AGPL-3.0-only|AGPL-3.0-only|GNU Affero General Public License, version 3
AGPL-3.0-or-later|AGPL-3.0-or-later
MPL-2.0|MPL-2.0|Mozilla Public License 2.0|Mozilla Public License, version 2.0
EPL-1.0|EPL-1.0|Eclipse Public License 1.0
EPL-2.0|EPL-2.0|Eclipse Public License 2.0
Zlib|Zlib|zlib License
BSL-1.0|BSL-1.0|Boost Software License, Version 1.0
Unlicense|Unlicense
CC0-1.0|CC0-1.0|CC0 1.0|Creative Commons CC0 1.0 Universal License
CC-BY-4.0|CC-BY-4.0|CC BY 4.0|Creative Commons Attribution 4.0 International License|Creative Commons Attribution 4.0 International
CC-BY-SA-4.0|CC-BY-SA-4.0|CC BY-SA 4.0|Creative Commons Attribution-ShareAlike 4.0 International License|Creative Commons Attribution-ShareAlike 4.0 International
CC-BY-NC-4.0|CC-BY-NC-4.0|CC BY-NC 4.0|Creative Commons Attribution-NonCommercial 4.0 International License|Creative Commons Attribution-NonCommercial 4.0 International
CC-BY-ND-4.0|CC-BY-ND-4.0|CC BY-ND 4.0|Creative Commons Attribution-NoDerivatives 4.0 International License|Creative Commons Attribution-NoDerivatives 4.0 International
CC-BY-NC-SA-4.0|CC-BY-NC-SA-4.0|CC BY-NC-SA 4.0|Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License|Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International
CC-BY-NC-ND-4.0|CC-BY-NC-ND-4.0|CC BY-NC-ND 4.0|Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License|Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International
"""
#: Rules over notices, apart from the operator's, in order: licence, identifiers; FREE stands for free-program, free-library and free-file.
SEQUENCES = """
Apache-2.0 apache-2-notice apache-comply
MIT-0 mit-0-grant
MIT mit-grant mit-condition
BSD-4-Clause bsd-grant bsd-source bsd-binary bsd-advert
BSD-3-Clause bsd-grant bsd-source bsd-binary bsd-endorse
BSD-3-Clause bsd-grant bsd-source bsd-binary bsd-endorse-author
BSD-2-Clause bsd-grant bsd-source bsd-binary
ISC isc-grant
ISC isc-grant-and
0BSD 0bsd-grant
GPL-2.0-or-later FREE gpl-terms either-2
GPL-2.0-or-later FREE gpl-2-later
GPL-2.0-only FREE gpl-terms version-2
GPL-2.0-only FREE gpl-2-terms
GPL-3.0-or-later FREE gpl-terms either-3
GPL-3.0-or-later FREE gpl-3-later
GPL-3.0-only FREE gpl-terms version-3
GPL-3.0-only FREE gpl-3-terms
LGPL-2.1-or-later FREE lgpl-terms either-21
LGPL-2.1-or-later FREE lgpl-21-later
LGPL-3.0-or-later FREE lgpl-terms either-3
LGPL-3.0-or-later FREE lgpl-3-later
AGPL-3.0-or-later FREE agpl-terms either-3
AGPL-3.0-or-later FREE agpl-3-later
MPL-2.0 mpl-2-terms
EPL-2.0 epl-2-terms
EPL-1.0 epl-1-terms
Zlib zlib-as-is zlib-grant
BSL-1.0 boost-grant
Unlicense unlicense-notice
CC0-1.0 cc0-dedication
"""


def licensed() -> str:
    """Sentences as rows, joined with the known ones; the rules one after another over each text's identifiers."""
    quote = lambda s: s.replace("'", "''")
    sentences = [line.split("|") for line in SENTENCES.strip().split("\n")]
    short = [line.split("|") for line in SHORT.strip().split("\n")]
    sentences += [(f"name-{name}", s) for name, *all_ in short for s in all_] + [(f"line-{name}", f"Licensed under {s}") for name, *all_ in short for s in all_]
    rules = []
    for line in SEQUENCES.strip().split("\n"):
        name, *ids = line.split(" ")
        rules += [(name, [free, *ids[1:]]) for free in ("free-program", "free-library", "free-file")] if ids[0] == "FREE" else [(name, ids)]
    order = {"GPL": 0, "LGPL": 0, "AGPL": 0}
    fixed = [r for r in rules if r[0].split("-")[0] not in order]
    first = next(i for i, r in enumerate(rules) if r not in fixed)
    free = [r for kind in ("free-program", "free-library", "free-file") for r in rules if r[1][0] == kind]
    rules = fixed[:first] + free + fixed[first:] + [(name, ["spdx", f"name-{name}"]) for name, *_ in short] + [(name, [f"line-{name}"]) for name, *_ in short]
    steps = ", ".join(f"'{name}={' '.join('<' + x + '>' for x in ids)}'" for name, ids in rules)
    left, found, name, ids = "split_part(acc, '#', 1)", "split_part(acc, '#', 2)", "split_part(r, '=', 1)", "split_part(r, '=', 2)"
    step = f"CASE WHEN contains({left}, {ids}) THEN replace({left}, {ids}, '|') || '#' || {found} || {name} || ',' ELSE acc END"
    space = r"[ \t\n\x0b\f\r]"
    plain = lambda x: rf"trim(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    opening = "^(this (work|project|software|program|file) is )?(licensed|released|distributed) under (the |a )?"
    whole = lambda x: f"regexp_replace(regexp_replace({plain(x)}, '{opening}', 'licensed under '), '^neither the name of .* nor the names of its contributors', 'neither the name of the copyright holder nor the names of its contributors')"
    numbered = rf"regexp_replace(regexp_replace(coalesce(text, ''), '\b([vV])\.({space}*\d)', '\1\2', 'g'), '\b(Inc|Ltd|Corp|Co)\.({space}+[a-z])', '\1\2', 'g')"
    numbered = rf"regexp_replace({numbered}, '(SPDX-License-Identifier:[^\r\n]*)', '\1' || chr(10) || chr(10), 'g')"
    numbered = rf"CASE WHEN contains(coalesce(text, ''), 'SPDX') THEN regexp_replace({numbered}, '\b((A|L)?GPL-\d\.\d)\+', '\1-or-later', 'g') ELSE {numbered} END"
    most = max(len(re.findall(r"[^\W_]+", s)) for _, s in sentences) + 12
    cut = rf"regexp_replace(regexp_replace({numbered}, '([.!?;:]){space}+', '\1' || chr(1), 'g'), '\n[^\p{{L}}\p{{N}}\n\x01]*\n[^\p{{L}}\p{{N}}\x01]*', chr(1), 'g')"
    values = ", ".join(f"('{i}', '{quote(s)}')" for i, s in sentences)
    return rf"""WITH raw(id, s) AS (VALUES {values}), known AS (SELECT DISTINCT id, {whole('s')} AS s FROM raw),
cut AS (SELECT doc_id, unnest(string_split({cut}, chr(1))) AS s, generate_subscripts(string_split({cut}, chr(1)), 1) AS i FROM documents),
complete AS (SELECT c.doc_id, c.i, 0 AS j, k.id FROM cut c JOIN known k ON {whole('c.s')} = k.s),
lines AS (SELECT doc_id, i, string_split(regexp_replace(s, '[\r\n]+([^\p{{L}}\p{{N}}\r\n]*\p{{Lu}})', chr(2) || '\1', 'g'), chr(2)) AS p FROM cut c WHERE NOT EXISTS (SELECT 1 FROM complete f WHERE f.doc_id = c.doc_id AND f.i = c.i)),
runs AS (SELECT doc_id, i, j, k, {whole("array_to_string(p[j : j + k - 1], ' ')")} AS s FROM (SELECT doc_id, i, p, j, unnest(range(1, least(len(p) - j + 1, {most}) + 1)) AS k FROM (SELECT doc_id, i, p, unnest(range(1, len(p) + 1)) AS j FROM lines))),
partial AS (SELECT doc_id, i, j, arg_min(id, k) AS id FROM runs r JOIN known USING (s) GROUP BY 1, 2, 3),
every AS (SELECT doc_id, list(id ORDER BY i, j) AS e FROM (SELECT * FROM complete UNION ALL SELECT * FROM partial) GROUP BY 1),
ids AS (SELECT doc_id, list_filter(e, lambda x, i: NOT starts_with(x, 'name-') OR coalesce(i > 1 AND e[i - 1] = 'spdx', false)) AS ids FROM every),
joined AS (SELECT doc_id, ids, array_to_string(list_transform(ids, lambda x: '<' || x || '>'), ' ') AS j0 FROM ids),
chained AS (SELECT doc_id, ids, string_split(rtrim(split_part(list_reduce([{steps}], lambda acc, r: {step}, j0 || '#'), '#', 2), ','), ',') AS f FROM joined),
named AS (SELECT doc_id, ids, array_to_string(list_filter(f, lambda x, i: list_position(f, x) = i), ',') AS licenses FROM chained)
SELECT d.doc_id, coalesce(len(ids), 0) AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(licenses, '') AS licenses FROM documents d LEFT JOIN named n ON d.doc_id = n.doc_id"""


def repaired() -> str:
    """Conversations damaged, judged and repaired: a recursion over the turns keeps the best audit that ends in each state."""
    bits = "list_reduce([xor(c, b) & 255] || [0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
    crc = f"xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(key) + 1), lambda i: ord(key[i])::BIGINT), lambda c, b: xor(c >> 8, {bits})), 4294967295)"
    return rf"""WITH RECURSIVE base AS (SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
dealt AS (SELECT *, {crc} % 20 AS d FROM base),
faulty AS (SELECT k, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE d WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM dealt WHERE d <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, row_number() OVER (PARTITION BY k, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM faulty),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'fine' END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY k ORDER BY i) || left(role, 1) AS pair FROM placed),
counted AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM judged GROUP BY k),
steps(s, letter, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserts(s, t, c, e) AS (VALUES (0, 0, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'), (1, 1, 0, ''), (1, 2, 5, 'I'), (1, 3, 10, 'II'), (2, 2, 0, ''), (2, 3, 5, 'I'), (3, 3, 0, ''), (3, 2, 5, 'I')),
kinds(initial, fault) AS (SELECT i.x, f.x FROM (VALUES ('s'), ('u'), ('a'), ('o')) AS i(x), (VALUES ('fine'), ('truncated'), ('gone')) AS f(x)),
moves AS (SELECT n.s, k.initial, k.fault, n.t, n.c + 2 AS c, n.e || 'D' AS e FROM inserts n, kinds k
  UNION ALL SELECT n.s, k.initial, k.fault, p.t, n.c + CASE k.fault WHEN 'truncated' THEN 5 ELSE 0 END, n.e || 'K' FROM inserts n JOIN steps p ON p.s = n.t JOIN kinds k ON k.initial = p.letter AND k.fault <> 'gone'
  UNION ALL SELECT n.s, k.initial, k.fault, p.t, n.c + 1 + CASE k.fault WHEN 'truncated' THEN 5 ELSE 0 END, n.e || 'R' FROM inserts n JOIN steps p ON p.s = n.t AND p.letter <> 's' JOIN kinds k ON k.fault <> 'gone'),
signs AS (SELECT k, i, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial, CASE WHEN fault IN ('blank', 'duplicate') THEN 'gone' ELSE fault END AS fault FROM judged),
best(k, i, state, way) AS (SELECT k, 0::BIGINT, 0, {{'c': 0, 'a': ''}} FROM counted
  UNION ALL SELECT b.k, b.i + 1, m.t, min({{'c': b.way.c + m.c, 'a': b.way.a || m.e}}) FROM best b JOIN signs y ON y.k = b.k AND y.i = b.i + 1 JOIN moves m ON m.s = b.state AND m.initial = y.initial AND m.fault = y.fault GROUP BY b.k, b.i + 1, m.t),
closed AS (SELECT c.k, min({{'c': b.way.c + n.c, 'a': b.way.a || n.e}}) AS way FROM counted c JOIN best b ON b.k = c.k AND b.i = c.n JOIN inserts n ON n.s = b.state AND n.t IN (0, 3) GROUP BY c.k),
edits AS (SELECT k, unnest(string_split(way.a, '')) AS e, generate_subscripts(string_split(way.a, ''), 1) AS p FROM closed),
run AS (SELECT k, e, p, sum((e <> 'I')::INT) OVER (PARTITION BY k ORDER BY p) AS i, sum((e <> 'D')::INT) OVER (PARTITION BY k ORDER BY p) AS o FROM edits),
kept AS (SELECT r.*, y.role, CASE WHEN r.e = 'I' THEN '' ELSE y.text END AS text FROM run r LEFT JOIN judged y ON y.k = r.k AND y.i = r.i WHERE r.e <> 'D'),
opening AS (SELECT k, bool_or(o = 1 AND e = 'K' AND left(role, 1) = 's')::INT AS systems FROM kept GROUP BY k),
lines AS (SELECT kept.k, p, CASE WHEN e = 'K' THEN role WHEN (o - systems) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text AS line FROM kept JOIN opening USING (k)),
hashed AS (SELECT k, sha256(string_agg(line, chr(10) ORDER BY p)) AS h FROM lines GROUP BY k),
ids AS (SELECT DISTINCT conv_id, k FROM base)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.c, 0)::BIGINT AS cost, coalesce(way.a, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM ids LEFT JOIN counted USING (k) LEFT JOIN closed USING (k) LEFT JOIN hashed USING (k)"""
