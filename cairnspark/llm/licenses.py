"""License scans: runs of lines against licence templates by Dice over word bigrams.

Texts are normalised to lower-case words of ASCII letters and digits.  A unit
is a run of consecutive lines, one line or many, so a notice is found on a
line of its own, wrapped over lines, behind comment signs, and above or below
anything else.  The distinct word bigrams of a run are compared with those of
a template.  A Dice coefficient of at least t bounds the sizes: the run's n
distinct bigrams lie between t/(2-t) and (2-t)/t of the template's, and it has
at most twice the template's bigrams, repeats counted; and the text must hold
t/(2-t) of the template's bigrams at all, which rules nearly every template
out before any run is made.  Runs start and end in lines that hold a bigram of
the template.

Runs that reach ``threshold`` overlap; one is reported if it is the best for
each of its lines: higher Dice, then fewer lines, then the earlier one, then
the smaller template id.

Edge cases: null and empty texts, and runs of under two words, match nothing;
repeated lines are each reported; repeated rows and ids are rows of their own,
each with its own result; long texts are read whole (memory grows with the
text, runs are bounded by the templates); a notice inside a line of much other
text is none; extra columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cairnspark.llm.textnum import GOLDEN, Words, mix, rows

THRESHOLD = 0.8

# Licence notices (template id, licence, notice text).
TEMPLATES = [
    (1, "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (2, "Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    (3, "MIT", "Released under the MIT License."),
    (4, "MIT", "This project is licensed under the MIT License."),
    (5, "MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    (6, "GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (7, "GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    (8, "LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    (9, "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (10, "CC-BY-4.0", "Licensed under CC BY 4.0."),
    (11, "CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (12, "CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (13, "CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    (14, "BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    (15, "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    (16, "proprietary", "All rights reserved."),
    (17, "MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    (18, "ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    (19, "BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    (20, "BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    (21, "Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    (22, "GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    (23, "zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""),
    (24, "Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
]


_U = np.uint64
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def bigrams(text: str) -> list[str]:
    w = [x.lower() for x in re.findall("[A-Za-z0-9]+", text)]
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def _pairs(data: np.ndarray, offs: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a block, the hash of the bigram that starts at each word but the last, and whether both are of one row."""
    w = Words(data, offs, _PLAIN[data])
    h = w.hashes()
    with np.errstate(over="ignore"):
        return w, mix(h[:-1] * GOLDEN + h[1:]), w.doc[1:] == w.doc[:-1]


class Templates:
    """The templates' bigrams by hash: ``keys`` sorted, ``of[i]`` the numbers of the templates that have bigram i."""

    def __init__(self, templates: list[tuple[int, str, str]], threshold: float):
        self.pct = round(threshold * 1000)
        sets = []
        for i, name, text in templates:
            raw = np.frombuffer(text.encode(), np.uint8)
            h = np.unique(_pairs(raw, np.array([0, len(raw)]))[1])
            if len(h):
                sets.append((i, name, h))
        self.names = [(i, name) for i, name, _ in sets]
        self.size = [len(h) for *_, h in sets]
        self.keys = np.unique(np.concatenate([h for *_, h in sets])) if sets else np.zeros(0, _U)
        self.has = np.array([np.isin(self.keys, h) for *_, h in sets], dtype=bool).reshape(len(sets), len(self.keys))
        self.least = [-(-n * self.pct // (2000 - self.pct)) for n in self.size]


def _runs(line: np.ndarray, gram: np.ndarray, number: np.ndarray, t: Templates, k: int):
    """(first line, last line, Dice) of the runs that reach the threshold for template ``k``.

    ``line`` is the line of each word of a text, ``gram`` the hash of the
    bigram that starts there and ``number`` its number among the templates'
    bigrams, -1 for others.
    """
    tn, pct = t.size[k], t.pct
    hit = (number >= 0) & t.has[k][np.maximum(number, 0)]
    at = np.flatnonzero(hit)
    lines = np.unique(np.concatenate([line[at], line[at + 1]]))
    first, last = np.searchsorted(line, lines), np.searchsorted(line, lines, side="right")
    gram, hit = gram.tolist(), hit.tolist()
    for i in range(len(lines)):
        seen: set = set()
        c, at = 0, int(first[i])
        for j in range(i, len(lines)):
            if last[j] - 1 - first[i] > 2 * tn:
                break
            while at < last[j] - 1:
                g = gram[at]
                if g not in seen:
                    seen.add(g)
                    c += hit[at]
                at += 1
            n = len(seen)
            if 2000 * c >= pct * (n + tn) and n * (2000 - pct) >= tn * pct and n * pct <= tn * (2000 - pct):
                yield int(lines[i]), int(lines[j]), 2.0 * c / (n + tn)


def _scan(templates: list[tuple[int, str, str]], threshold: float):
    names = ["doc_id", "first_line", "last_line", "template_id", "license", "dice"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64()]

    def run(batches):
        t = Templates(templates, threshold)
        for batch in batches:
            out = []
            for lo, _, data, offs in rows(batch, "text"):
                w, gram, joined = _pairs(data, offs)
                if not len(gram) or not len(t.keys):
                    continue
                number = np.searchsorted(t.keys, gram)
                number[(t.keys[np.minimum(number, len(t.keys) - 1)] != gram) | ~joined] = -1
                at = np.flatnonzero(number >= 0)
                doc = w.doc[at]
                if not len(at):
                    continue
                seen = np.unique(doc * len(t.keys) + number[at])  # distinct bigrams of the templates in each row
                line = np.searchsorted(np.flatnonzero(data == 0x0A), w.start)
                for d in np.unique(doc):
                    have = seen[(np.searchsorted(seen, d * len(t.keys))) : np.searchsorted(seen, (d + 1) * len(t.keys))] - d * len(t.keys)
                    few = t.has[:, have].sum(axis=1)
                    a, b = int(w.first[d]), int(w.first[d + 1])
                    base = int(np.count_nonzero(data[: offs[d]] == 0x0A)) if any(few[k] >= t.least[k] for k in range(len(few))) else 0
                    found = []
                    for k in np.flatnonzero(few >= t.least):
                        for i, j, dice in _runs(line[a:b] - base, gram[a : b - 1], number[a : b - 1], t, int(k)):
                            found.append((-dice, j - i, i, t.names[k][0], t.names[k][1]))
                    best: dict[int, tuple] = {}
                    for f in found:
                        for x in range(f[2], f[2] + f[1] + 1):
                            if x not in best or f < best[x]:
                                best[x] = f
                    ids = batch.column("doc_id")[lo + int(d)].as_py() if found else None
                    for f in sorted(set(best.values()), key=lambda f: f[2]):
                        if all(best[x] == f for x in range(f[2], f[2] + f[1] + 1)):
                            out.append((ids, f[2], f[2] + f[1], f[3], f[4], round(-f[0], 6)))
            cols = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return run


def scan(docs: DataFrame, templates: list[tuple[int, str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, first_line, last_line, template_id, license, dice) of the notices in ``docs(doc_id, text)``; lines count from 0."""
    return docs.select("doc_id", "text").mapInArrow(_scan(templates, threshold), "doc_id long, first_line int, last_line int, template_id int, license string, dice double")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_PCT = round(THRESHOLD * 1000)
_VALUES = ", ".join(f"({i}, '{name}', {len(bigrams(t))}, '{g}')" for i, name, t in TEMPLATES for g in bigrams(t))
OP3_SQL = f"""
WITH t(template_id, license, tn, bigram) AS (VALUES {_VALUES}),
tt AS (SELECT DISTINCT template_id, license, tn FROM t),
d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
li AS (SELECT rid, doc_id, unnest(range(len(ls)))::INT AS line, unnest(ls) AS x FROM d),
wl AS (SELECT rid, doc_id, line, unnest(range(len(w))) AS k, lower(unnest(w)) AS word FROM (SELECT *, regexp_extract_all(x, '[A-Za-z0-9]+') AS w FROM li)),
wo AS (SELECT rid, doc_id, line, word, row_number() OVER (PARTITION BY rid ORDER BY line, k) AS p FROM wl),
bi AS (SELECT rid, doc_id, p, line AS l1, lead(line) OVER o AS l2, word || ' ' || lead(word) OVER o AS bigram FROM wo WINDOW o AS (PARTITION BY rid ORDER BY p)),
hit AS (SELECT rid, template_id, tn, p, l1, l2, bi.bigram FROM bi JOIN t USING (bigram)),
ok AS (SELECT rid, template_id FROM hit GROUP BY ALL HAVING count(DISTINCT bigram) * {2000 - _PCT} >= {_PCT} * any_value(tn)),
hl AS (SELECT DISTINCT rid, template_id, tn, line FROM (SELECT rid, template_id, tn, l1 AS line FROM hit UNION ALL SELECT rid, template_id, tn, l2 FROM hit) SEMI JOIN ok USING (rid, template_id)),
sp AS (SELECT rid, line, min(p) AS a, max(p) AS b FROM wo GROUP BY ALL),
hs AS (SELECT hl.*, a, b FROM hl JOIN sp USING (rid, line)),
ru AS (SELECT x.rid, x.template_id, x.tn, x.line AS i, y.line AS j, x.a, y.b FROM hs x JOIN hs y ON x.rid = y.rid AND x.template_id = y.template_id AND x.line <= y.line
  AND y.b - x.a <= 2 * x.tn AND (y.b - x.a) * {2000 - _PCT} >= x.tn * {_PCT}),
co AS (SELECT ru.rid, ru.template_id, ru.tn, i, j, count(DISTINCT bi.bigram) AS n, count(DISTINCT t.bigram) AS c
  FROM ru JOIN bi ON bi.rid = ru.rid AND bi.p >= ru.a AND bi.p < ru.b LEFT JOIN t ON t.template_id = ru.template_id AND t.bigram = bi.bigram GROUP BY ALL),
qu AS (SELECT *, 2.0::DOUBLE * c / (n + tn) AS dice FROM co WHERE 2000 * c >= {_PCT} * (n + tn) AND n * {2000 - _PCT} >= tn * {_PCT} AND n * {_PCT} <= tn * {2000 - _PCT}),
ea AS (SELECT *, unnest(range(i, j + 1)) AS line FROM qu),
rk AS (SELECT *, row_number() OVER (PARTITION BY rid, line ORDER BY dice DESC, j - i, i, template_id) AS r FROM ea),
be AS (SELECT rid, template_id, i, j, dice FROM rk WHERE r = 1 GROUP BY ALL HAVING count(*) = j - i + 1)
SELECT d.doc_id, i::INT AS first_line, j::INT AS last_line, be.template_id::INT AS template_id, license, round(dice, 6) AS dice
FROM be JOIN tt USING (template_id) JOIN d USING (rid)
"""
