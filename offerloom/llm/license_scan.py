"""Licence scan by canonical digests: texts are normalised, hashed and joined to the digests of known licence texts."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm.common import fresh

#: Spellings that count as equal, as whole words after normalising.
EQUIVALENT = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("licencee", "licensee"),
    ("licencees", "licensees"),
    ("licencing", "licensing"),
    ("sublicence", "sublicense"),
    ("sublicences", "sublicenses"),
    ("sublicenced", "sublicensed"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("authorised", "authorized"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
)
#: Beginnings of licence texts; a copyright notice that runs on in the same line ends before them.
OPENERS = ("permission is hereby granted", "permission is granted", "permission to use", "redistribution and use", "everyone is permitted", "this software is provided as is")

#: Texts of short public licences and usual notices.
_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_ISC_END = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_MIT_START = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so'
_UNLICENSE = 'This is free and unencumbered software released into the public domain.\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n' + _WARRANTY.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS")
_ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution."
_BOOST = 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\nThe copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
#: Licence, its usual headings, its text.
SHORT = (
    ("MIT", ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT"), _MIT_START + ", subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + _WARRANTY),
    ("MIT-0", ("MIT No Attribution", "MIT-0"), _MIT_START + ".\n" + _WARRANTY),
    ("ISC", ("ISC License", "The ISC License", "ISC"), "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_END),
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD"), "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC_END),
    ("BSD-2-Clause", ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"), _BSD_START + "\n" + _BSD_END),
    ("BSD-3-Clause", ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD License", "New BSD License", "Modified BSD License"), _BSD_START + "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n" + _BSD_END),
    ("Unlicense", ("The Unlicense", "Unlicense"), _UNLICENSE),
    ("Unlicense", ("The Unlicense", "Unlicense"), _UNLICENSE + "\nFor more information, please refer to <http://unlicense.org/>"),
    ("Unlicense", ("The Unlicense", "Unlicense"), _UNLICENSE + "\nFor more information, please refer to <https://unlicense.org/>"),
    ("Zlib", ("zlib License", "The zlib License"), _ZLIB),
    ("BSL-1.0", ("Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License 1.0"), _BOOST),
)
#: Usual notices.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "MIT License"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)
END = "END OF TERMS AND CONDITIONS"


@cache
def known_licenses() -> tuple[tuple[str, str], ...]:
    """(licence, text) of the default list: short texts with and without headings and item numbers, notices, and the files in ``licenses``.

    Files that have instructions after their terms are listed with and without these.
    """
    out = list(NOTICES)
    for name, titles, text in SHORT:
        for t in {text, re.sub(r"(?m)^[0-9]\. ", "", text)}:
            out += [(name, t), *((name, f"{title}\n{t}") for title in titles)]
    for f in sorted(Path(__file__).with_name("licenses").glob("*.txt")):
        text = f.read_text()
        out.append((f.stem, text))
        if END in text:
            out += [(f.stem, text.split(END)[0]), (f.stem, text.split(END)[0] + END)]
    return tuple(sorted(set(out)))


def _spaced(words: str) -> str:
    return words.replace(" ", "  ")


def canonical_lines(text: F.Column) -> F.Column:
    """ASCII letters and digits in lower case; words and newlines, each with a space on both sides. Other characters count as space.

    Copyright notices are left out, from their line's start or middle to its end or to the beginning of a licence text in it, and so
    are lines that begin with "all rights reserved". Equivalent spellings are made one.
    """
    t = F.translate(F.replace(text, F.lit("©"), F.lit("(c)")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    t = F.regexp_replace(F.regexp_replace(t, "[^a-z0-9\n]+", "  "), " *\n[ \n]*", "  \n  ")
    t = F.concat(F.lit(" \n  "), F.trim(t), F.lit(" "))
    t = F.regexp_replace(t, SPLIT, " \n $1")
    t = F.regexp_replace(t, NOTICE, "")
    return _one_spelling(t)


def _one_spelling(t: F.Column) -> F.Column:
    for a, b in EQUIVALENT:
        t = F.replace(t, F.lit(f" {_spaced(a)} "), F.lit(f" {_spaced(b)} "))
    return t


#: Where a line is broken (words have two spaces between them here), and lines that are left out.
SPLIT = "(  (?:copyright  (?:c |[0-9])|all  rights  reserved|" + "|".join(map(_spaced, OPENERS)) + "))"
NOTICE = "\n +(?:copyright  (?:c |[0-9])|all  rights  reserved)[^\n]*"


def whole(lines: F.Column) -> F.Column:
    """The digest of a whole normalised text; spellings are made one across its lines."""
    return F.sha2(F.trim(F.regexp_replace(_one_spelling(F.regexp_replace(lines, " *\n *", "  ")), " +", " ")), 256)


def known_digests(spark: SparkSession, known: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license, size), one row per digest, of the pairs (licence, text) of ``known`` or of the default list."""
    rows = spark.createDataFrame(list(known_licenses() if known is None else known), "license string, text string")
    lines = canonical_lines(F.col("text"))
    size = F.length(F.trim(F.regexp_replace(F.regexp_replace(lines, "\n", " "), " +", " ")))
    return rows.select(whole(lines).alias("digest"), "license", size.alias("size")).groupBy("digest").agg(F.min("license").alias("license"), F.min("size").alias("size"))


def scan_licenses(docs: DataFrame, text_col: str = "text", known: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """Every row of ``docs`` with its columns and canonical_sha256, license, notices.

    canonical_sha256 is the digest of the whole normalised text; license the known licence with that digest, else null; notices the
    sorted distinct licences that single lines of the text are equal to, joined by commas ('' for none). ``known`` are pairs (licence,
    text), by default those of :func:`known_licenses`; they come to the driver and are broadcast, so they should be a list that fits
    there. The whole texts are hash-joined to their digests; lines are looked up in the same list, inside their row.

    Null and empty texts have the digest of the empty text and no licence. Rows that repeat each get a row. An empty table gives an
    empty result. Extra columns pass through; columns with the names of the results are replaced.
    """
    docs = docs.drop("canonical_sha256", "license", "notices")
    lines, key = fresh(docs, "lines_", "digest_")
    found = known_digests(docs.sparkSession, known).where("size > 0").collect()
    rows = docs.sparkSession.createDataFrame([(r.digest, r.license) for r in found], f"{key} string, license string")
    table = F.create_map(*[F.lit(x) for r in found for x in (r.digest, r.license)]) if found else F.create_map().cast("map<string,string>")
    sizes = sorted({r["size"] for r in found})
    one = lambda x: F.trim(F.regexp_replace(x, " +", " "))
    of_line = lambda x: F.when(F.length(one(x)).isin(*sizes), F.try_element_at(table, F.sha2(one(x), 256)))
    notices = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.transform(F.split(F.col(lines), "\n"), of_line)))), ",")
    return (
        docs.withColumn(lines, canonical_lines(F.coalesce(F.col(text_col), F.lit(""))))
        .withColumns({"canonical_sha256": whole(F.col(lines)), "notices": notices})
        .drop(lines)
        .join(F.broadcast(rows), F.col("canonical_sha256") == F.col(key), "left")
        .drop(key)
    )


def oracle() -> str:
    """DuckDB SQL for doc_id, canonical_sha256, license and notices of ``documents``."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"

    def spelling(t: str) -> str:
        for a, b in EQUIVALENT:
            t = f"replace({t}, ' {_spaced(a)} ', ' {_spaced(b)} ')"
        return t

    def lines(col: str) -> str:
        t = f"translate(replace({col}, '©', '(c)'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        t = f"regexp_replace(regexp_replace({t}, '[^a-z0-9\n]+', '  ', 'g'), ' *\n[ \n]*', '  ' || chr(10) || '  ', 'g')"
        t = f"' ' || chr(10) || '  ' || trim({t}) || ' '"
        t = f"regexp_replace({t}, {quote(SPLIT)}, ' ' || chr(10) || ' \\1', 'g')"
        return spelling(f"regexp_replace({t}, {quote(NOTICE)}, '', 'g')")

    joined = spelling("regexp_replace(lines, ' *\n *', '  ', 'g')")
    digest = f"sha256(trim(regexp_replace({joined}, ' +', ' ', 'g')))"
    known = " UNION ALL ".join(f"SELECT {quote(n)} AS license, {quote(t)} AS text" for n, t in known_licenses())
    return f"""
        WITH known AS MATERIALIZED (SELECT {digest} AS digest, min(license) AS license
                       FROM (SELECT license, {lines("text")} AS lines FROM ({known})) GROUP BY 1),
             d AS MATERIALIZED (SELECT doc_id, {lines("coalesce(text, '')")} AS lines FROM documents),
             n AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
                   FROM (SELECT doc_id, sha256(trim(regexp_replace(unnest(string_split(lines, chr(10))), ' +', ' ', 'g'))) AS digest FROM d) JOIN known USING (digest) GROUP BY 1),
             w AS (SELECT doc_id, {digest} AS digest FROM d)
        SELECT w.doc_id, w.digest AS canonical_sha256, known.license, coalesce(n.notices, '') AS notices
        FROM w LEFT JOIN known ON known.digest = w.digest LEFT JOIN n ON n.doc_id = w.doc_id"""
