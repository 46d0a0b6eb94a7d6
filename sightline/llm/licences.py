"""Licence texts found by the digest of their canonical form.

Two copies of a licence differ in case, punctuation, line breaks, the copyright
line and a few spellings. The canonical form takes these away, so that a whole
text can be looked up by its digest. The same lookup is made for every single
line, which finds notices within longer documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import lower_ascii

# Equivalent spellings, as whole words: the left one becomes the right one.
# fmt: off
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("behaviour", "behavior"), ("centre", "center"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("honour", "honor"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("licences", "licenses"),
    ("licenced", "licensed"), ("merchantibility", "merchantability"), ("non commercial", "noncommercial"),
    ("noninfringment", "noninfringement"), ("organisation", "organization"), ("owner", "holder"),
    ("per cent", "percent"), ("programme", "program"), ("sublicence", "sublicense"), ("utilisation", "utilization"),
    ("owners", "holders"), ("whilst", "while"), ("wilful", "willful"),
)
# fmt: on

# A line of a copyright statement: nothing before the mark but comment signs, and a year or a short name behind it.
_COPYRIGHT = r"(?m)^[^a-z0-9\n]*(?:copyright|\(c\)|©|all rights reserved)(?:[ \t:,]*(?:\(c\)|©|copyright|[0-9]|by\b)[^\n]*|(?:[^a-z0-9\n]+[a-z0-9]+){0,4}[^a-z0-9\n]*)$"
_NOT_WORD = r"[^a-z0-9\n]+"
_EDGES = r"(?m)^ | $"

# Licences by name, whole texts, and notices of one line.
LICENCES = {
    "MIT": """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    "ISC": """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
""",
    "BSD-2-Clause": """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
""",
    "Zlib": """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution.
""",
    "Apache-2.0": """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.
""",
    "GPL-3.0-or-later": """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.
""",
}
# The title lines that files of a licence begin with.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "Zlib": ("zlib License", "The zlib/libpng License", "zlib/libpng License"),
}
NOTICES = {
    "Released under the MIT License": "MIT",
    "Licensed under the MIT License": "MIT",
    "Licensed under the Apache License, Version 2.0": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3": "GPL-3.0",
    "Licensed under the GNU General Public License, version 3": "GPL-3.0",
    "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0": "CC-BY-SA-4.0",
    "SPDX-License-Identifier: MIT": "MIT",
    "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
}


def canonical_lines(text: Column) -> Column:
    """The text's lines: A-Z in lower case, copyright lines empty, runs of other signs one blank."""
    # The other signs that end a line in Java's patterns are blanks here.
    lines = F.regexp_replace(F.translate(lower_ascii(text), "\u0085\u2028\u2029", "   "), r"\r\n?", "\n")
    return F.regexp_replace(F.regexp_replace(lines, _COPYRIGHT, ""), _NOT_WORD, " ")


def one_spelling(lines: Column) -> Column:
    """Canonical lines with equivalent spellings made one; texts without any are passed by."""
    changed = lines
    for old, new in SPELLINGS:
        changed = F.regexp_replace(changed, rf"\b{old}\b", new)
    some = lines.rlike(r"\b(?:" + "|".join(old for old, _ in SPELLINGS) + r")\b")
    return F.regexp_replace(F.when(some, changed).otherwise(lines), _EDGES, "")


def canonical(lines: Column) -> Column:
    """Canonical lines as one run of words."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def canonical_text(text: str) -> str:
    """The canonical form of a known licence; the same rules for a single string."""
    lines = text.translate({c: c + 32 for c in range(65, 91)}).replace("\r\n", "\n").replace("\r", "\n")
    lines = re.sub(_NOT_WORD, " ", re.sub(_COPYRIGHT, "", lines))
    for old, new in SPELLINGS:
        lines = re.sub(rf"\b{old}\b", new, lines, flags=re.ASCII)
    return re.sub(r"[ \n]+", " ", re.sub(_EDGES, "", lines)).strip(" ")


def shipped(licences: Mapping[str, str] = LICENCES, titles: Mapping[str, Sequence[str]] = TITLES) -> list[tuple[str, str]]:
    """(name, text) of every licence, alone and below each of its titles."""
    return [(n, "\n\n".join([*title, t])) for n, t in licences.items() for title in [[], *[[x] for x in titles.get(n, ())]]]


def known_digests(texts: Mapping[str, str]) -> dict[str, str]:
    """Digest -> name for texts given as name -> text."""
    return {hashlib.sha256(canonical_text(t).encode()).hexdigest(): name for name, t in texts.items()}


def scan(
    docs: DataFrame,
    licences: Mapping[str, str] = LICENCES,
    notices: Mapping[str, str] = NOTICES,
    titles: Mapping[str, Sequence[str]] = TITLES,
) -> DataFrame:
    """(doc_id, digest, license, notices) of every document.

    ``digest`` is the SHA-256 of the whole canonical text, ``license`` the
    known licence with that digest, alone or below one of its titles, or null, and ``notices`` the sorted names
    of known notices that stand on a line of their own. A null text has a null
    digest and no notices; an empty text, or one of copyright lines only, has
    the digest of nothing and no licence. Repeated rows repeat their result.
    The known texts are part of the program and go to every task.
    """
    spark = docs.sparkSession
    by_line = {canonical_text(line): name for line, name in notices.items()}
    texts = [*shipped(licences, titles), *((n, t) for t, n in notices.items())]
    whole = known_digests({f"{n}\n{i}": t for i, (n, t) in enumerate(texts)})
    known = spark.createDataFrame(
        [(d, n.partition("\n")[0]) for d, n in whole.items()], "digest string, license string"
    )
    lengths = sorted({len(line) for line in by_line})
    table = F.create_map(*[F.lit(x) for line, name in by_line.items() for x in (hashlib.sha256(line.encode()).hexdigest(), name)])
    rows = docs.select("doc_id", canonical_lines(F.col("text")).alias("lines")).withColumn(
        "lines", one_spelling(F.col("lines"))
    )
    # A line of another length can't be one of the notices.
    likely = F.filter(F.split("lines", "\n"), lambda s: F.char_length(s).isin(lengths))
    found = F.transform(likely, lambda s: F.element_at(table, F.sha2(s.cast("binary"), 256)))
    named = F.array_sort(F.array_distinct(F.filter(found, lambda n: n.isNotNull())))
    rows = rows.select(
        "doc_id",
        F.sha2(canonical(F.col("lines")).cast("binary"), 256).alias("digest"),
        F.coalesce(named, F.array().cast("array<string>")).alias("notices"),
    )
    return rows.join(F.broadcast(known), "digest", "left").select("doc_id", "digest", "license", "notices")
