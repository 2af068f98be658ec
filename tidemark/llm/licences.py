"""Licences by digest of their canonical text.

Text is made canonical: lower case, copyright lines dropped, punctuation and blanks made one space,
equivalent spellings made one. The whole text, its paragraphs and its lines are then entire texts whose
digests are hash-joined to the digests of known licences and notices, made canonical the same way. A longer
licence amid other text is found by the digests of its paragraphs, where all of them meet one after another.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import with_row

# Spellings that count as one, after punctuation became a space.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sub license": "sublicense", "sub licence": "sublicense",
    "sublicence": "sublicense", "non commercial": "noncommercial", "noninfringement": "non infringement", "https": "http",
    "acknowledgement": "acknowledgment", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "authorise": "authorize", "cancelled": "canceled", "catalogue": "catalog", "centre": "center",
    "copyright owner": "copyright holder", "copyright owners": "copyright holders", "favour": "favor", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "merchantibility": "merchantability",
    "modelling": "modeling", "offence": "offense", "optimise": "optimize", "organisation": "organization", "organise": "organize",
    "per cent": "percent", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}

# Names under which notices mention a licence.
NAMES = {
    "MIT": ("the MIT License", "MIT License", "the MIT license terms", "MIT"),
    "Apache-2.0": ("the Apache License, Version 2.0", "Apache License, Version 2.0", "the Apache License 2.0", "Apache License 2.0",
                   "the Apache 2.0 License", "Apache-2.0"),
    "GPL-2.0": ("the GNU General Public License, version 2", "the GNU General Public License version 2.0", "the GNU GPL v2",
                "GNU General Public License v2.0", "GPL-2.0"),
    "GPL-3.0": ("the GNU General Public License, version 3", "the GNU General Public License version 3.0", "the GNU GPL v3",
                "GNU General Public License v3.0", "GPL-3.0"),
    "LGPL-3.0": ("the GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPL-3.0"),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPL-3.0"),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the New BSD License", "BSD-3-Clause"),
    "ISC": ("the ISC License", "ISC License", "ISC"),
    "Zlib": ("the zlib License", "zlib License", "Zlib"),
    "Unlicense": ("the Unlicense", "Unlicense"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "CC0-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "the Creative Commons Attribution 4.0 International License", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "the Creative Commons Attribution-NoDerivatives 4.0 International License"),
}
PHRASES = ("{}", "Licensed under {}.", "Released under {}.", "Distributed under {}.", "Available under {}.", "Published under {}.",
           "SPDX-License-Identifier: {}", "License: {}", *(f"This {what} is {how} under {{}}." for how in ("licensed", "released", "distributed")
           for what in ("work", "software", "project", "program", "file", "document", "code", "library")))

_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution.
"""
# Whole licences, without their copyright lines.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": _BSD + _DISCLAIMER,
    "BSD-3-Clause": _BSD + """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
""" + _DISCLAIMER,
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute
it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License.""",
}


def known_texts() -> list[tuple[str, str]]:
    """(licence, text): notices by rule from names and phrases, and the whole licences, also under their titles."""
    notices = [(licence, phrase.format(name)) for licence, names in NAMES.items() for name in names for phrase in PHRASES
               if phrase != "{}" or " " in name]  # a bare short name may be a word of some language
    titled = [(licence, f"{NAMES[licence][0].removeprefix('the ')}\n\n{text}") for licence, text in TEXTS.items()]
    return notices + list(TEXTS.items()) + titled


TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "Zlib": ("zlib License", "The zlib License", "The zlib/libpng License"),
}
# A line of a licence in TEXTS that begins a list item.
ITEM = re.compile(r"^[0-9]\.")
# So many first characters of a paragraph are compared before its digest is made.
BEGIN = 16
# Last words of the terms; what follows tells how to apply them and is often left out.
END = "END OF TERMS AND CONDITIONS"


def _breaks(text: str) -> list[str]:
    """The text with the usual blank lines: sentences that begin a source line after a full stop or colon begin a
    paragraph; list items do too, or follow each other, or follow what leads to them."""
    joined = re.sub(r"(?<![.:])\n(?!http)", " ", text)
    lead = joined.split("\n")
    out = []
    for glue in (lambda line, before: False, lambda line, before: ITEM.match(line) and ITEM.match(before), lambda line, before: ITEM.match(line)):
        made = lead[0]
        for before, line in zip(lead, lead[1:]):
            made += ("\n" if glue(line, before) else "\n\n") + line
        out.append(made)
    return list(dict.fromkeys(out))


def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of the complete licences in the folder ``texts``, also without what follows their terms."""
    out = []
    for path in sorted((Path(__file__).parent / "texts").glob("*.txt")):
        text = path.read_text("utf-8")
        out.append((path.stem, text))
        if END in text:
            end = text.index(END)
            out += [(path.stem, text[:end]), (path.stem, text[:end + len(END)])]
    return out


def more_texts() -> list[tuple[str, str]]:
    """(licence, text): the complete licences, and the whole ones under more titles than ``known_texts`` has."""
    return full_texts() + [(licence, f"{title}\n\n{TEXTS[licence]}") for licence, titles in TITLES.items() for title in titles]


def spread_texts() -> list[tuple[str, str]]:
    """(licence, text) of several paragraphs, to be found amid other text. Of a complete licence its terms count."""
    terms = [(licence, text) for licence, text in full_texts() if END not in text]
    url = "http://www.apache.org/licenses/LICENSE-2.0"
    header = TEXTS["Apache-2.0"].replace(f" {url}", f"\n\n{url}\n").replace("Unless", "\nUnless")
    return terms + [("Apache-2.0", header)] + [(licence, t) for licence, text in TEXTS.items() if licence != "Apache-2.0" for t in _breaks(text)]


# Patterns of the canonical form; the second one matches line by line.
_STEPS = (
    (r"\r\n?", "\n"),
    (r"^[^\p{L}\p{N}\n]*(?:copyright (?:\(c\)|©|[0-9]{4}|by )|\(c\)|©|copr\. |all rights reserved).*$", "\x01"),
    (r"\x01\n?", ""),
    (r"[^\p{L}\p{N}\n]+", " "),
    (r" *\n *", "\n"),
)
_ANY = r"\b(?:" + "|".join(SPELLINGS) + r")\b"


def canonical(text: Column) -> Column:
    """The canonical form with line ends; null counts as empty."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for pattern, to in _STEPS:
        out = F.regexp_replace(out, "(?md)" + pattern, to)
    changed = out
    for old, new in SPELLINGS.items():
        changed = F.regexp_replace(changed, rf"\b{old}\b", new)
    return F.when(F.regexp_like(out, F.lit(_ANY)), changed).otherwise(out)


def _flat(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\n+", " "))


def known_digests(spark: SparkSession, known: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """(licence, digest, size) of the given texts; of equal texts the first licence by name. The list
    comes from the driver, so its size is what was handed in."""
    rows = spark.createDataFrame(known_texts() + more_texts() if known is None else list(known), "licence string, known string")
    flat = rows.select("licence", _flat(canonical(F.col("known"))).alias("flat")).where("flat <> ''")
    return flat.groupBy("flat").agg(F.min("licence").alias("licence")).select(
        "licence", F.sha2("flat", 256).alias("digest"), F.length("flat").alias("size"))


def known_paragraphs(spark: SparkSession, known: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, size, begin, licence, mine, layout, n, seq): every paragraph of the given texts of several paragraphs, ``seq`` of
    ``n``; ``mine`` is the digest of the whole text, ``layout`` that of its paragraphs."""
    rows = spark.createDataFrame(spread_texts() if known is None else list(known), "licence string, known string")
    whole = canonical(F.col("known"))
    rows = rows.select("licence", F.sha2(_flat(whole), 256).alias("mine"), _paragraphs(whole).alias("parts")).where("size(parts) > 1")
    rows = rows.groupBy("parts").agg(F.min("licence").alias("licence"), F.min("mine").alias("mine"))
    layout = F.sha2(F.array_join("parts", "\n\n"), 256).alias("layout")
    return rows.select("licence", "mine", layout, F.size("parts").alias("n"), F.posexplode("parts").alias("seq", "part")).select(
        F.sha2("part", 256).alias("digest"), F.length("part").alias("size"), F.substring("part", 1, BEGIN).alias("begin"), "licence", "mine", "layout", "n", "seq")


def _paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\n{2,}"), _flat), lambda p: p != "")


def scan(docs: DataFrame, known: Sequence[tuple[str, str]] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, licences (sorted, distinct), whole (that of the entire text),
    n_matches (licence and known text pairs). Null, empty and unmatched texts have no licences, null whole and 0.

    Only parts as long as some known text or paragraph are digested, as no other can equal one.
    """
    spark = docs.sparkSession
    digests = known_digests(spark, known).collect()  # as many rows as were handed in
    spread = known_paragraphs(spark, known).collect()  # as many rows as these have paragraphs
    sizes, lengths = sorted({r["size"] for r in digests}), sorted({r["size"] for r in spread})
    begins = sorted({r["begin"] for r in spread})
    steps_of: dict[str, list] = {}
    for r in spread:
        steps_of.setdefault(r["digest"], []).append((r["layout"], r["seq"], r["n"], r["licence"], r["mine"]))
    licence_of = {r["digest"]: r["licence"] for r in digests}
    table = spark.createDataFrame([(d, licence_of.get(d), steps_of.get(d)) for d in sorted({*licence_of, *steps_of})],
                                  "digest string, licence string, runs array<struct<layout: string, seq: int, n: int, licence: string, mine: string>>")
    rows = with_row(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    rows = rows.select("row", "doc_id", canonical(F.col("text")).alias("c"))
    rows = rows.withColumn("paragraphs", _paragraphs(F.col("c")))
    part = lambda scope, at=F.lit(-1): lambda t: F.struct(F.lit(scope).alias("scope"), t.alias("flat"), at.alias("at"))
    known_size = lambda p: F.length(p["flat"]).isin(sizes) if sizes else F.lit(False)
    known_begin = lambda p: F.length(p["flat"]).isin(lengths) & F.substring(p["flat"], 1, BEGIN).isin(begins) if lengths else F.lit(False)
    parts = F.concat(F.array(part("text")(_flat(F.col("c")))), F.transform("paragraphs", part("paragraph")),
                     F.transform(F.transform(F.split("c", r"\n+"), _flat), part("line")))
    parts = F.array_distinct(F.filter(parts, known_size))
    numbered = F.filter(F.transform("paragraphs", lambda p, i: part("run", i)(p)), known_begin)
    dealt = rows.select("row", "doc_id", F.explode_outer(F.concat(parts, numbered)).alias("p"))
    dealt = dealt.select("row", "doc_id", "p.scope", "p.at", F.sha2("p.flat", 256).alias("mine"))
    met = dealt.join(table, F.col("mine") == F.col("digest"), "left")
    hit = F.when((F.col("scope") != "run") & F.col("licence").isNotNull(), F.struct("scope", "licence", "mine"))
    steps = F.when(F.col("scope") == "run", F.transform("runs", lambda r: F.struct(
        r["layout"].alias("layout"), (F.col("at") - r["seq"]).alias("start"), r["seq"].alias("seq"), r["n"].alias("n"),
        r["licence"].alias("licence"), r["mine"].alias("mine"))))
    hits = met.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.collect_set(hit).alias("hits"), F.array_sort(F.flatten(F.collect_list(steps))).alias("steps"))

    # In this order a text whose paragraphs all meet has its first one n - 1 places before its last.
    def ends(step: Column, i: Column) -> Column:
        first = F.get("steps", i - step["n"] + 1)
        return (step["seq"] == step["n"] - 1) & (first["layout"] == step["layout"]) & (first["start"] == step["start"]) & (first["seq"] == 0)

    found = F.transform(F.filter("steps", ends), lambda s: F.struct(F.lit("run").alias("scope"), s["licence"].alias("licence"), s["mine"].alias("mine")))
    hits = hits.select("doc_id", F.concat("hits", found).alias("hits"))
    whole = F.filter("hits", lambda h: h["scope"] == "text")
    return hits.select("doc_id", F.array_sort(F.array_distinct("hits.licence")).alias("licences"),
                       F.when(F.size(whole) > 0, F.element_at(whole, 1)["licence"]).alias("whole"),
                       F.size(F.array_distinct(F.transform("hits", lambda h: F.struct(h["licence"], h["mine"])))).cast("bigint").alias("n_matches"))


def op6_licences(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text")).withColumn("licences", F.array_join("licences", ","))


def _oracle() -> str:
    """The same with the patterns on every part, joined by text instead of digest."""
    quote: Callable[[str], str] = lambda s: "'" + s.replace("'", "''") + "'"

    def form(x: str) -> str:
        x = f"lower(coalesce({x}, ''))"
        for pattern, to in _STEPS:
            x = f"regexp_replace({x}, {quote('(?m)' + pattern)}, {quote(to)}, 'g')"
        for old, new in SPELLINGS.items():
            x = rf"regexp_replace({x}, '\b{old}\b', '{new}', 'g')"
        return x

    flat: Callable[[str], str] = lambda x: rf"trim(regexp_replace({x}, '\n+', ' ', 'g'))"
    values = ", ".join(f"({quote(a)}, {quote(b)})" for a, b in known_texts())
    return f"""
WITH known AS (SELECT min(licence) AS licence, flat FROM (SELECT licence, {flat(form('t'))} AS flat FROM (VALUES {values}) v(licence, t)) GROUP BY flat),
d AS (SELECT doc_id, row_number() OVER () AS row, {form('text')} AS c FROM documents),
parts AS (
  SELECT DISTINCT row, scope, {flat('part')} AS flat FROM (
    SELECT row, 'text' AS scope, c AS part FROM d
    UNION ALL SELECT row, 'paragraph', unnest(string_split_regex(c, '\\n{{2,}}')) FROM d
    UNION ALL SELECT row, 'line', unnest(string_split_regex(c, '\\n+')) FROM d)),
hits AS (SELECT row, scope, licence, flat FROM parts JOIN known USING (flat))
SELECT doc_id, coalesce(string_agg(DISTINCT licence, ',' ORDER BY licence), '') AS licences,
       max(licence) FILTER (scope = 'text') AS whole, count(DISTINCT flat) AS n_matches
FROM d LEFT JOIN hits USING (row) GROUP BY row, doc_id
"""


ORACLE_SQL = _oracle()
