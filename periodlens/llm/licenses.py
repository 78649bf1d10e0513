"""License scan by canonical digests.

A text is brought to a canonical form: A-Z lower-cased, copyright lines left
out, equivalent spellings replaced, punctuation and runs of white space made
one space. The SHA-256 of the whole canonical text is hash-joined with the
digests of known licences and notices; so is each single line, as a notice is
often one line of a longer text. All columns are DataFrame expressions.
"""

from __future__ import annotations

from importlib import resources
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed texts of licences and notices.
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
KNOWN_TEXTS = [
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        + _WARRANTY,
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_WARRANTY,
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted. " + _ISC_WARRANTY,
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("proprietary", "All rights reserved."),
]
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: {0}Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. {1}Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. {2}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {3} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
    "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ENDORSE = (
    "Neither the name of the copyright {} nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)
# Title lines that stand above a licence in its usual files.
_TITLES = {
    "MIT": ["MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "BSD License"],
}
_APACHE_HEADER = [
    'Licensed under the Apache License, Version 2.0 (the "License");',
    "you may not use this file except in compliance with the License.",
    "You may obtain a copy of the License at {}://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
    "language governing permissions and limitations under the License.",
]
_GNU_HEADER = (
    "This {work} is free software{stop} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public "
    "License as published by the Free Software Foundation{stop} either version {version} of the License, or (at your option) "
    "any later version. This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
    "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for "
    "more details. You should have received a copy of the GNU {kind}General Public License along with this {work}{end}"
)
_GNU = [("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3")]
_FSF = [
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
]
_END_OF_TERMS = "END OF TERMS AND CONDITIONS"
_MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not "
    "distributed with this\nfile, You can obtain one at {}://mozilla.org/MPL/2.0/."
)
_SPDX = {
    **{name: [name] for name in ("MIT", "ISC", "0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "Unlicense")},
    **{name: [name] for name in ("CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")},
    **{name: [name, f"{name}-only", f"{name}-or-later", f"{name}+"] for name, _, _ in _GNU},
}


def _from_files() -> list[tuple[str, str]]:
    """The long licences, as they are published, with and without their appendix and with other addresses and links."""
    found = []
    folder = resources.files("periodlens.llm") / "license_texts"
    for name in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"):
        text = (folder / f"{name}.txt").read_text(encoding="utf-8")
        forms = [text]
        if _END_OF_TERMS in text:
            forms.append(text[: text.index(_END_OF_TERMS) + len(_END_OF_TERMS)])
        if name == "Apache-2.0":  # once filled in, this line is a copyright line
            forms.append("\n".join(line for line in text.split("\n") if "[yyyy]" not in line))
            forms.append(text[: text.index(_END_OF_TERMS)])
        if name in ("GPL-2.0", "LGPL-2.1"):
            forms = [form.replace(_FSF[0], address) for form in forms for address in _FSF]
        forms += [form.replace("https://", "http://") for form in forms] + [
            form.replace("https://", "http://").replace("http://", "https://") for form in forms
        ]
        found += [(name, form) for form in dict.fromkeys(forms)]
    return found


def _more_texts() -> list[tuple[str, str]]:
    """Whole licences and headers in their usual forms, beside the fixed list."""
    numbers = [("1. ", "2. ", "3. "), ("", "", ""), ("(1) ", "(2) ", "(3) "), ("a. ", "b. ", "c. ")]
    whole = [(name, text) for name, text in KNOWN_TEXTS[:3]]
    for (one, two, three), holder in product(numbers, ("HOLDER", "OWNER")):
        whole.append(("BSD-2-Clause", _BSD.format(one, two, "", holder)))
        for who in ("holder", "owner"):
            whole.append(("BSD-3-Clause", _BSD.format(one, two, three + _ENDORSE.format(who), holder)))
    more = whole[3:] + [(name, f"{title}\n{text}") for name, text in whole for title in _TITLES[name]]
    for link in ("http", "https"):
        header = "\n".join(_APACHE_HEADER).format(link)
        more += [("Apache-2.0", header), ("MPL-2.0", _MPL_HEADER.format(link))]
        more.append(("MPL-2.0", _MPL_HEADER.format(link).split("\n")[2]))
        for (name, kind, version), work, stop in product(_GNU, ("program", "library"), (";", ":")):
            ends = [f". If not, see <{link}://www.gnu.org/licenses/>."]
            ends += [f"; if not, write to the Free Software Foundation, Inc., {address}." for address in _FSF]
            more += [(name, _GNU_HEADER.format(work=work, stop=stop, kind=kind, version=version, end=end)) for end in ends]
    # Lines that tell the licence by themselves.
    more += [("Apache-2.0", _APACHE_HEADER[0]), ("Apache-2.0", " ".join(_APACHE_HEADER[:2]))]
    more.append(("MPL-2.0", _MPL_HEADER.split("\n")[1]))
    more += [(name, f"SPDX-License-Identifier: {text}") for name, texts in _SPDX.items() for text in texts]
    return list(dict.fromkeys(more))


KNOWN_TEXTS += _from_files() + _more_texts()
# Fixed equivalent spellings.
SPELLINGS = [
    ("licen[cs]ed", "licensed"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("sub[- ]?licen[cs]e", "sublicense"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("whilst", "while"),
    ("non[- ]infringement", "noninfringement"),
    ("v[. ]?(2|3)", "version $1"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A copyright statement begins a line and ends with its sentence: at a full stop before a space, but not behind an initial
# or an abbreviation that goes on with a capital or a comma, nor inside a word; and before "all rights reserved".
_BEGINS = (
    r"(^|\n)[^A-Za-z0-9\n]*(?:(?i:copyright)[^A-Za-z\n]*(?:[0-9]|[(][Cc][)]|\x{00a9}|[Bb][Yy] )|[(][Cc][)] *[0-9]|\x{00a9})"
)
_RESERVED = "(?i:all rights reserved)"
_SHORT = "[A-Za-z]|Inc|Ltd|Co|Corp|Jr|Sr|Dr|St|e[.]V"
_RUN = rf"[^.\n]*?(?=[ ,;]*{_RESERVED}|[.\n]|\z)"
_GOES_ON = rf"(?:(?<=[^A-Za-z](?:{_SHORT}))[.](?= +(?!{_RESERVED})[A-Z]|,)|[.](?![\s]|\z))"
_STATEMENT = rf"{_BEGINS}{_RUN}(?:{_GOES_ON}{_RUN})*+[.]?"
_COPYRIGHT = rf"{_STATEMENT}(?:[ ,;]*{_RESERVED}[.]?)?"
_ANY_SPELLING = r"\b(" + "|".join(pattern for pattern, _ in SPELLINGS) + r")\b"
_PUNCTUATION = r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f\x{00a9}\x{2013}\x{2014}\x{2018}\x{2019}\x{201c}\x{201d}]+"


def _removed(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(_BEGINS), F.regexp_replace(text, pattern, "$1")).otherwise(text)


def _normal(text: Column) -> Column:
    low = spelled = F.translate(text, _UPPER, _LOWER)
    for pattern, replacement in SPELLINGS:
        spelled = F.regexp_replace(spelled, rf"\b{pattern}\b", replacement)
    low = F.when(low.rlike(_ANY_SPELLING), spelled).otherwise(low)
    return F.regexp_replace(low, _PUNCTUATION, " ")


def canonical_lines(text: Column) -> Column:
    """The canonical form with line breaks kept; null for null. Copyright statements go, and what reserves all rights
    right behind one; the rest of their lines stays."""
    return _normal(_removed(text, _COPYRIGHT))


def notice_lines(text: Column) -> Column:
    """As ``canonical_lines``, but only the statements themselves go."""
    return _normal(_removed(text, _STATEMENT))


def _one_line(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def scan(docs: DataFrame, known: list[tuple[str, str]] = KNOWN_TEXTS) -> DataFrame:
    """Add ``digest``, ``license`` (of the whole text, else null) and ``notices`` to every row of ``docs``.

    ``notices`` are the names of the known texts that single lines equal, each
    once, sorted, joined by commas; empty if there is none. A null text has
    null in all three; an empty one has the digest of nothing. The list of
    known texts is given by the caller, some dozens, so it is broadcast, and
    lines of other lengths than theirs need no digest. Columns of ``docs``
    with the added names are replaced.
    """
    spark = docs.sparkSession
    table = (
        spark.createDataFrame(known, "license string, text string")
        .select("license", _one_line(canonical_lines(F.col("text"))).alias("text"))
        .select("license", F.length("text").alias("size"), F.sha2("text", 256).alias("digest"))
        .dropDuplicates(["digest"])
    )
    rows = table.collect()
    names = F.create_map(*[F.lit(x) for row in rows for x in (row.digest, row.license)])
    sizes = sorted({row["size"] for row in rows})
    kept = docs.drop("digest", "license", "notices")
    lines = F.col("_canonical")
    trimmed = F.transform(F.split(lines, "\n"), lambda line: F.trim(line))
    possible = F.filter(trimmed, lambda line: F.length(line).isin(sizes))
    found = F.transform(possible, lambda line: names[F.sha2(line, 256)])
    return (
        kept.withColumn("_canonical", notice_lines(F.col("text")))
        .withColumn(
            "digest",
            F.sha2(_one_line(F.when(F.col("text").rlike(_BEGINS), canonical_lines(F.col("text"))).otherwise(lines)), 256),
        )
        .withColumn("notices", F.array_join(F.array_sort(F.array_distinct(F.array_compact(found))), ","))
        .drop("_canonical")
        .join(F.broadcast(table.select(F.col("digest").alias("_digest"), "license")), F.col("digest") == F.col("_digest"), "left")
        .select(*kept.columns, "digest", "license", "notices")
    )


def oracle_sql(known: list[tuple[str, str]] = KNOWN_TEXTS) -> str:
    """The registered query in SQL for DuckDB."""

    # Written without looking around: "all rights reserved" is one character while statements are sought.
    mark = chr(1)
    goes_on = rf"[^A-Za-z\n](?:(?:{_SHORT})[.] +)+[A-Z]|[^A-Za-z\n](?:{_SHORT})[.],|[.][^\s{mark}.]"
    statement = rf"{_BEGINS}(?:{goes_on}|[^.\n{mark}])*[.]?"

    def canonical(text: str, reserved: bool = True) -> str:
        low = f"regexp_replace({text}, '(?i)all rights reserved', '{mark}', 'g')"
        low = f"regexp_replace({low}, '{statement}{f'(?:[ ,;]*{mark}[.]?)?' if reserved else ''}', '\\1', 'g')"
        low = f"replace({low}, '{mark}', 'all rights reserved')"
        low = f"translate({low}, '{_UPPER}', '{_LOWER}')"
        for pattern, replacement in SPELLINGS:
            low = f"regexp_replace({low}, '\\b{pattern}\\b', '{replacement.replace('$', chr(92))}', 'g')"
        return f"regexp_replace({low}, '{_PUNCTUATION}', ' ', 'g')"

    def one_line(lines: str) -> str:
        return f"trim(regexp_replace({lines}, '[ \\n]+', ' ', 'g'), ' ')"

    values = ", ".join("('{}', '{}')".format(*(part.replace("'", "''") for part in row)) for row in known)
    return f"""
WITH known AS (
  SELECT any_value(license) AS license, digest FROM (
    SELECT license, sha256({one_line(canonical('text'))}) AS digest FROM (VALUES {values}) AS k(license, text))
  GROUP BY digest),
texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, {canonical('text')} AS lines, {canonical('text', False)} AS noticed FROM documents),
notices AS (
  SELECT row_no, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM (SELECT row_no, sha256(trim(unnest(string_split(noticed, chr(10))), ' ')) AS digest FROM texts) JOIN known USING (digest)
  GROUP BY row_no)
SELECT doc_id, t.digest, k.license,
       CASE WHEN t.lines IS NOT NULL THEN coalesce(n.notices, '') END AS notices
FROM (SELECT *, sha256({one_line('lines')}) AS digest FROM texts) t
LEFT JOIN known k ON k.digest = t.digest LEFT JOIN notices n USING (row_no)
"""
