"""License scans by canonical digest [DataFrame functions only].

A text's canonical form has no copyright lines; the rest is lower-cased, each run of other characters
than letters and digits is one space, and equivalent spellings are written one way. Its SHA-256 is
looked up among the digests of known licences by a hash join of entire texts (`license`). The same lookup of
each line finds the notices that stand inside other texts (`notices`).

Known are the texts in `license_texts` (one file each, named by licence), each with and without what follows
its "END OF TERMS AND CONDITIONS", and the short texts and notices in `KNOWN`.

Defined cases: null and empty texts (and those of copyright lines only) have no digest and no licence;
repeated rows are looked up alike; two known texts with one canonical form count as the first by name;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings that count as equal (whole words, after lower-casing).
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("licencing", "licensing"),
    ("licencee", "licensee"),
    ("licencees", "licensees"),
    ("licencor", "licensor"),
    ("licencors", "licensors"),
    ("relicence", "relicense"),
    ("relicencing", "relicensing"),
    ("sublicences", "sublicenses"),
    ("sublicenced", "sublicensed"),
    ("sublicencing", "sublicensing"),
    ("sublicencees", "sublicensees"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("authorised", "authorized"),
    ("authorisation", "authorization"),
    ("behaviour", "behavior"),
    ("favour", "favor"),
    ("non commercial", "noncommercial"),
    ("sub license", "sublicense"),
    ("sublicence", "sublicense"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("http", "https"),
)
_MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

%sTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"
#: Known licence texts and notices, by SPDX name.
KNOWN = (
    ("0BSD", _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", _BSD % ""),
    ("BSD-3-Clause", _BSD % _THIRD),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", _ISC),
    ("ISC", "ISC License\n" + _ISC),
    ("MIT", _MIT),
    ("MIT", _MIT.partition("\n")[2]),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Zlib", _ZLIB),
)
END = "END OF TERMS AND CONDITIONS"
#: A copyright line: the word or sign, then a sign, a year or a blank to fill in; or a name with a year, or a name of
#: a few words alone; or the reservation of all rights.
COPYRIGHT = (
    r"^[^\p{L}\p{N}]*((c|C)\)[^\p{L}\p{N}]*)?(©|\(c\)|\(C\)|[Cc]opyright|COPYRIGHT)([^\p{L}\p{N}]+((c|C)\)|©|[0-9<])|$).*"
    r"|^[^\p{L}\p{N}]*[Cc]opyright +\p{Lu}[^;:]*[0-9][0-9][0-9][0-9][^\p{L}\p{N}]*$"
    r"|^[^\p{L}\p{N}]*[Cc]opyright +\p{Lu}[\p{L}.,&-]*( +[\p{L}.,&-]+)?( +[\p{L}.,&-]+)?( +[\p{L}.,&-]+)?( +[\p{L}.,&-]+)?( +[\p{L}.,&-]+)? *$"
    r"|^[^\p{L}\p{N}]*([Aa]ll [Rr]ights [Rr]eserved|ALL RIGHTS RESERVED)[^\p{L}\p{N}]*$"
)


def known_texts(folder: Path = Path(__file__).parent / "license_texts") -> tuple[tuple[str, str], ...]:
    """(licence, text) of the registry."""
    out = list(KNOWN)
    for path in sorted(folder.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        out.append((path.stem, text))
        if END in text:
            out.append((path.stem, text[: text.index(END) + len(END)]))
    return tuple(out)


def _canonical(line: Column) -> Column:
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    plain = F.regexp_replace(plain, " +", " ")
    for said, written in SPELLINGS:
        if said != written:
            plain = F.replace(plain, F.lit(f" {said} "), F.lit(f" {written} "))
    return F.trim(plain)


def canonical_lines(text: str = "text") -> Column:
    """Canonical form of each line that is neither empty nor a copyright line."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: ~x.rlike(COPYRIGHT))
    return F.filter(F.transform(lines, _canonical), lambda x: x != "")


def registry(spark, known=None) -> list[tuple[str, str]]:
    """(digest, license) of the known texts, as many as the registry has; one for each digest."""
    rows = spark.createDataFrame(list(known or known_texts()), "license string, text string")
    digests = rows.select("license", F.array_join(canonical_lines(), " ").alias("c")).where("c <> ''")
    found = digests.groupBy(F.sha2("c", 256).alias("digest")).agg(F.min("license").alias("license"))
    return sorted((r["digest"], r["license"]) for r in found.collect())


def scan(docs: DataFrame, known=None) -> DataFrame:
    """doc_id, digest, license (of the entire text) and notices (licences named by single lines)."""
    pairs = dict(registry(docs.sparkSession, known))
    found = docs.sparkSession.createDataFrame(list(pairs.items()), "digest string, license string")
    lookup = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    out = docs.select("doc_id", canonical_lines().alias("_lines"))
    out = out.select("doc_id", "_lines", F.array_join("_lines", " ").alias("_c"))
    digests = F.transform("_lines", lambda x: F.sha2(x, 256))
    notices = F.array_sort(F.array_distinct(F.transform(F.filter(digests, lambda d: d.isin(sorted(pairs))), lambda d: F.element_at(lookup, d))))
    out = out.select("doc_id", F.when(F.col("_c") != "", F.sha2("_c", 256)).alias("digest"), F.array_join(notices, ",").alias("notices"))
    return out.join(F.broadcast(found), "digest", "left").select("doc_id", "digest", "license", "notices")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def _oracle() -> str:
    def canon(x: str) -> str:
        plain = f"regexp_replace(' ' || regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' ', ' +', ' ', 'g')"
        for said, written in SPELLINGS:
            if said != written:
                plain = f"replace({plain}, ' {said} ', ' {written} ')"
        return f"trim({plain})"

    lines = lambda t: f"list_filter(list_transform(list_filter(string_split(coalesce({t}, ''), chr(10)), lambda l: NOT regexp_matches(l, '{COPYRIGHT}')), lambda l: {canon('l')}), lambda l: l <> '')"
    known = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in known_texts())
    return f"""
    WITH k AS (SELECT digest, min(license) AS license FROM (SELECT license, sha256(array_to_string({lines("t")}, ' ')) AS digest FROM (VALUES {known}) AS v(license, t)) GROUP BY digest),
    d AS (SELECT row_number() OVER () AS r, doc_id, {lines("text")} AS lines FROM documents),
    n AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM (SELECT r, unnest(lines) AS l FROM d) JOIN k ON sha256(l) = k.digest GROUP BY r)
    SELECT doc_id, CASE WHEN len(lines) > 0 THEN sha256(array_to_string(lines, ' ')) END AS digest, k.license, coalesce(notices, '') AS notices
    FROM d LEFT JOIN k ON len(lines) > 0 AND k.digest = sha256(array_to_string(lines, ' ')) LEFT JOIN n USING (r)"""


ORACLE = _oracle()
