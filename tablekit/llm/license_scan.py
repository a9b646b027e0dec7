"""License scan by canonical digests (operator 7), DataFrame functions only.

A text is brought to canonical form: lines that state a copyright are left out
(not wrapped licence wording that happens to begin with the word), letters are lowered, everything but letters and digits becomes one blank, and
equivalent spellings are made one. Texts whose canonical forms have the same
SHA-256 digest are the same licence. Every whole document, and every line of it
taken as a text of its own, is hash-joined to the digests of the known licences,
which every executor holds (a fixed list of some 10,000).
Only digests and ids are joined; documents without a match cost no shuffle of
their text. The known licences are the whole texts in ``licenses/``, with and
without heading, 'All rights reserved' line and appendix, and the notices that
``notices`` builds; a GPL or LGPL text alone counts as the '-only' id.

Defined cases: null or empty text, or one with no letter or digit outside
copyright lines, has the digest of the empty text and matches nothing; of known
licences with one canonical form the least id counts; rows equal in id and text
get the same result each; a null doc_id is scanned like any other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import cache
from importlib.resources import files
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.common import table, text_hash

# Short licence notices and texts in common use, and spellings
# that matching guidelines treat as equal.
_KNOWN = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This work is licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction, including"
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the"
        " following conditions: The above copyright notice and this permission notice shall be included in all"
        " copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF"
        " ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR"
        " A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR"
        " ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,"
        " OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "GPL-2.0-only": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "GPL-3.0-only": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to"
        " this work.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "WTFPL": ["DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"],
}
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sub license": "sublicense",
    "sub licence": "sublicense", "acknowledgement": "acknowledgment", "merchantibility": "merchantability",
    "non infringement": "noninfringement", "neighbouring": "neighboring", "non commercial": "noncommercial",
    "v": "version", "https": "http",
}
#: What follows 'copyright' where a line of licence wording begins with it.
_WORDS = (r"and|are|disclaimers?|doctrines|holders?|if|interests?|laws?|licen[sc]es?|like|notices?|of|on|or|owners?"
          r"|ownership|patent|permissions?|resulting|statements?|treaty")
_WORDING = rf"(?:{_WORDS}|the(?=[ \t\r]*$|[ \t]+(?:software|library|program)))\b"
#: What makes it a statement, and what else may follow it in wording.
_STATED, _MARKS = r"[ \t,:]*(?:\(c\)|©|[\[{<]|(?:19|20)\d\d|by\b)", r"[ \t]*[.,;)\"”'/-]"
#: A line that states a copyright: 'copyright' before (c), the sign, a year, a
#: placeholder, 'by' or a name; the sign alone; (c) alone, if a year follows
#: ('(c)' also numbers paragraphs).
COPYRIGHT_LINE = (
    r"(?im)^[ \t]*(?:©"
    r"|copyright\b(?:" + _STATED + r"|(?![ \t\r]*$|" + _MARKS + r"|[ \t]+" + _WORDING + r"))"
    r"|\(c\)(?=[^\n]*(?:\b(?:19|20)\d\d\b|©|copyright)))[^\n]*$")
NOT_LETTERS = r"[^\p{L}\p{N}]+"


#: Names that notices use. Bare 'GPL-3.0', 'GPLv3' and 'GNU GPL v3' are left out:
#: the canonical form has no '+', so they would also be found in 'GPLv3+'.
_NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0", "Apache-2.0"],
    "MIT": ["MIT", "Expat"],
    "ISC": ["ISC"],
    "0BSD": ["0BSD", "Zero-Clause BSD", "BSD Zero Clause"],
    "BSD-2-Clause": ["BSD 2-Clause", "2-Clause BSD", "Simplified BSD", "FreeBSD"],
    "BSD-3-Clause": ["BSD 3-Clause", "3-Clause BSD", "New BSD", "Modified BSD", "Revised BSD"],
    "Unlicense": ["Unlicense"],
    "WTFPL": ["WTFPL", "Do What The Fuck You Want To Public"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0",
                "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL-2.0"],
    "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal", "Creative Commons CC0 1.0 Universal",
                "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication"],
}
for _id, _name, _short, _versions in (("GPL", "GNU General Public License", "GNU GPL", ("2.0", "3.0")),
                                      ("LGPL", "GNU Lesser General Public License", "GNU LGPL", ("2.1", "3.0")),
                                      ("AGPL", "GNU Affero General Public License", "GNU AGPL", ("3.0",))):
    for _v in _versions:
        _forms = [f"{n}{sep}{v}" for n, sep, v in product((_name, _short), (", version ", " v"),
                                                          sorted({_v, _v.removesuffix(".0")}))]
        _NAMES[f"{_id}-{_v}-only"] = [f"{_id}-{_v}-only", f"{_name} v{_v}", *(f for f in _forms if "version" in f),
                                      *(f"{f} only" for f in _forms)]
        _NAMES[f"{_id}-{_v}-or-later"] = [f"{_id}-{_v}-or-later", *(f"{f} or {end}" for f in _forms for end in
                                          ("later", "any later version", "(at your option) any later version"))]
for _id, _name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                   ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                   ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    _NAMES[f"CC-{_id}-4.0"] = [f"CC {_id} 4.0", f"CC {_id} 4.0 International", f"Creative Commons {_name} 4.0",
                               f"Creative Commons {_name} 4.0 International",
                               f"Creative Commons {_name} 4.0 International License (CC {_id} 4.0)",
                               f"Creative Commons {_name} 4.0 International (CC {_id} 4.0)"]
_SUBJECTS = ["", "This work is ", "This software is ", "This project is "]
_VERBS = ["licensed under ", "released under ", "distributed under ", "licensed under the terms of "]


def notices(license_id: str) -> list[str]:
    """Notice lines of a licence: every template with every name, and its SPDX line."""
    names = [f for n in _NAMES.get(license_id, []) for f in ((n,) if "License" in n or "GNU" in n else (n, f"{n} License"))]
    lines = [f"SPDX-License-Identifier: {license_id}",
             *("".join(part) for part in product(_SUBJECTS, _VERBS, ("", "the "), names))]
    return list({re.sub(r"\W+", " ", x.lower()).strip(): x for x in lines}.values())


def _text(license_id: str) -> str:
    """A stored text without the lines that state a copyright."""
    text = (files(__package__) / "licenses" / f"{license_id}.txt").read_text(encoding="utf-8")
    return re.sub(COPYRIGHT_LINE, "", text)


def _cut(text: str, start: str, end: str) -> list[str]:
    """The text with and without what comes before ``start``, and after ``end``."""
    a, b = text.index(start), text.index(end) + len(end) if end else len(text)
    return [text, text[a:], text[:b], text[a:b]]


@cache
def whole_texts() -> dict[str, list[str]]:
    """Whole licences, in the variants in common use."""
    mit, bsd3, isc = _KNOWN["MIT"][-1], _text("BSD-3-Clause"), _text("ISC")
    bsd2 = bsd3[:bsd3.index("3. Neither")] + bsd3[bsd3.index("THIS SOFTWARE"):]
    # numbered or with bullets, which have no letters or digits
    bsd = {name: [re.sub(r"(?m)^[123]\. ", mark, t).replace("COPYRIGHT HOLDER OR", f"COPYRIGHT {who} OR")
                  for mark, who in product(("", "* "), ("HOLDER", "OWNER"))]
           + [t, t.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR")]
           for name, t in (("BSD-2-Clause", bsd2), ("BSD-3-Clause", bsd3))}
    short = {
        "MIT": (["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT", "Expat License"],
                [mit, mit.replace("permission notice shall", "permission notice (including the next paragraph) shall")]),
        "BSD-2-Clause": (["BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License", "BSD License",
                          "BSD 2-Clause \"Simplified\" License"], bsd["BSD-2-Clause"]),
        "BSD-3-Clause": (["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "Modified BSD License",
                          "BSD License", "BSD 3-Clause \"New\" or \"Revised\" License"], bsd["BSD-3-Clause"]),
        "ISC": (["ISC License", "The ISC License", "ISC License (ISC)", "ISC"],
                [isc, isc.replace("and/or distribute", "and distribute")]),
        "0BSD": (["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "0BSD"], [_text("0BSD")]),
        "Unlicense": (["The Unlicense", "Unlicense"],
                      [t for u in [_text("Unlicense")] for t in (u, u.replace("http://unlicense.org/", "https://unlicense.org"))]),
    }
    found = {name: [f"{head}\n{rights}\n{body}" for head, rights, body in
                    product(["", *heads], ("", "All rights reserved."), bodies)] for name, (heads, bodies) in short.items()}
    over = "END OF TERMS AND CONDITIONS"
    apache = _text("Apache-2.0")
    found["Apache-2.0"] = [*_cut(apache, "TERMS AND CONDITIONS FOR USE", over),
                           *_cut(apache[:apache.index(over)], "TERMS AND CONDITIONS FOR USE", "")[:2]]
    for name in ("GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only"):
        found[name] = _cut(_text(name), "Everyone is permitted", over)
    found["LGPL-3.0-only"] = _cut(_text("LGPL-3.0-only"), "Everyone is permitted", "choose that version for the\nLibrary.")
    found["MPL-2.0"] = _cut(_text("MPL-2.0"), "1. Definitions", "") + [
        t for x in [_text("MPL-2.0")] for t in (x[:x.index("Exhibit A - Source")], x[x.index("1. Definitions"):x.index("Exhibit A - Source")])]
    cc0 = _text("CC0-1.0")
    found["CC0-1.0"] = [cc0, cc0[cc0.index("CC0 1.0 Universal"):], cc0[cc0.index("Statement of Purpose"):],
                        "CC0 1.0 Universal\n" + cc0[cc0.index("Statement of Purpose"):]]
    return found


@cache
def known_texts() -> dict[str, list[str]]:
    """All known texts by licence; the stored ones are read here, at first use."""
    whole = whole_texts()
    return {name: [*notices(name), *whole.get(name, []), *_KNOWN.get(name, [])] for name in sorted({*_KNOWN, *_NAMES, *whole})}


def canonical(text: Column, copyright_line: str = COPYRIGHT_LINE) -> Column:
    c = F.regexp_replace(F.coalesce(text, F.lit("")), copyright_line, "")
    c = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(c), NOT_LETTERS, " ")), F.lit(" "))
    for found, same in SPELLINGS.items():
        c = F.replace(c, F.lit(f" {found} "), F.lit(f" {same} "))
    return F.trim(c)


def known_digests(spark: SparkSession, known: dict[str, list[str]] | None = None) -> DataFrame:
    """(digest, license_id), one row a digest: about 10,000, fixed by the lists above."""
    rows = [(name, text) for name, texts in (known or known_texts()).items() for text in texts]
    return (spark.createDataFrame(rows, "license_id string, text string")
            .withColumn("form", canonical(F.col("text"))).where("form != ''")
            .groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license_id").alias("license_id")))


def scan(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """(doc_id, text_digest, license_id, n_license_lines, line_licenses) of every
    row. The known digests are a fixed list, so they are broadcast: no line is
    moved to meet them, however common it is."""
    digests = F.broadcast(digests)
    d = docs.select("doc_id", text_hash(F.col("text")).alias("th"), "text")
    whole = (d.select("doc_id", "th", F.sha2(canonical(F.col("text")), 256).alias("text_digest"))
             .join(digests.withColumnRenamed("digest", "text_digest"), "text_digest", "left"))
    lines = (d.where("text is not null")
             .select("doc_id", "th", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
             .select("doc_id", "th", "pos", F.sha2(canonical(F.col("line")), 256).alias("digest"))
             .join(digests.withColumnRenamed("license_id", "line_license"), "digest")
             # a set: rows equal in id and text name each line once
             .groupBy("doc_id", "th").agg(F.collect_set(F.struct("pos", "line_license")).alias("found"))
             .select(F.col("doc_id").alias("id"), F.col("th").alias("hash"), "found"))
    return (whole.join(lines, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("hash")), "left")
            .select("doc_id", "text_digest", "license_id",
                    F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_license_lines"),
                    F.coalesce(F.array_join(F.array_sort(F.array_distinct("found.line_license")), ","),
                               F.lit("")).alias("line_licenses")))


def op7(spark, sf_dir: str) -> DataFrame:
    """Licences that a document is, and that its lines state."""
    return scan(table(spark, sf_dir, "documents"), known_digests(spark))


def _sql_canonical(text: str) -> str:
    c = rf"' ' || trim(regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' '"
    for found, same in SPELLINGS.items():
        c = f"replace({c}, ' {found} ', ' {same} ')"
    return f"trim({c})"


def _sql_rows() -> str:
    quoted = [(n.replace("'", "''"), t.replace("'", "''")) for n, ts in known_texts().items() for t in ts]
    return ", ".join(f"('{n}', '{t}')" for n, t in quoted)


def _sql_states(line: str) -> str:
    """Whether a line states a copyright, by the rule of COPYRIGHT_LINE without look-ahead."""
    the = r"the(?:[ \t\r]*$|[ \t]+(?:software|library|program))"
    sign, stated, word, wording, marked = (rf"(?i)^[ \t]*{p}".replace("'", "''") for p in (
        "©", rf"copyright\b{_STATED}", r"copyright\b",
        rf"copyright(?:[ \t\r]*$|{_MARKS}|[ \t]+(?:(?:{_WORDS})\b|{the}))",
        r"\(c\).*(?:\b(?:19|20)\d\d\b|©|copyright)"))
    return (f"(regexp_matches({line}, '{sign}') OR regexp_matches({line}, '{stated}') OR regexp_matches({line}, '{marked}')"
            f" OR (regexp_matches({line}, '{word}') AND NOT regexp_matches({line}, '{wording}')))")


@cache
def op7_sql() -> str:
    """DuckDB SQL; reads the stored texts at first use."""
    return rf"""
WITH known AS (
  SELECT sha256(form) AS digest, min(license_id) AS license_id
  FROM (SELECT license_id, {_sql_canonical("text")} AS form FROM (VALUES {_sql_rows()}) t(license_id, text))
  WHERE form != '' GROUP BY 1
), split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), whole AS (
  SELECT doc_id, sha256({_sql_canonical(f"array_to_string([x FOR x IN ls IF NOT {_sql_states("x")}], chr(10))")}) AS text_digest
  FROM split
), lines AS (
  SELECT doc_id, CASE WHEN {_sql_states("line")} THEN '' ELSE line END AS line
  FROM (SELECT doc_id, unnest(ls) AS line FROM split)
), found AS (
  SELECT l.doc_id, count(*) AS n, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS names
  FROM (SELECT doc_id, sha256({_sql_canonical("line")}) AS digest FROM lines) l
  JOIN known k ON l.digest = k.digest GROUP BY l.doc_id
)
SELECT w.doc_id, w.text_digest, k.license_id, coalesce(f.n, 0) AS n_license_lines,
       coalesce(f.names, '') AS line_licenses
FROM whole w LEFT JOIN known k ON w.text_digest = k.digest LEFT JOIN found f ON w.doc_id = f.doc_id
"""
