"""License scans by canonical digest lookup.

A text is brought to a canonical form (lower case, copyright lines removed,
equivalent spellings unified, punctuation and white space as single blanks)
and hashed; known licence texts and notices are hashed alike, and the digests
are joined.  Looked up are the whole text of a document, each paragraph and
line of it as a text of its own, so that a notice that stands on its own line
is found, and runs of adjacent paragraphs, so that a licence of several
paragraphs inside a larger document is found, however it is parted: always by
equality of entire texts.

Every known canonical text holds one of a few anchor words, and the canonical
form never joins letters, so a text without an anchor equals none of them: an
exact shortcut that leaves most documents after one pattern test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import license_texts as whole

# Public licence notices and short licences, as (licence id, text).
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
    "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
    "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
    "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
    "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
    "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE.")
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
)


def _whole_licences() -> tuple[tuple[str, str], ...]:
    """(licence id, text) of whole licences in their usual forms."""
    def both(licence, *texts):
        return [(licence, t.replace("http://", x)) for t in texts for x in ("http://", "https://")]

    def terms(text):
        """A text without the advice that follows its terms."""
        end = "END OF TERMS AND CONDITIONS"
        return text[:text.index(end)], text[:text.index(end) + len(end)]

    out = both("Apache-2.0", whole.APACHE_2, *terms(whole.APACHE_2),
               whole.APACHE_2.replace("Copyright [yyyy] [name of copyright owner]", ""))
    for licence, text in (("GPL-2.0", whole.GPL_2), ("GPL-3.0", whole.GPL_3), ("LGPL-2.1", whole.LGPL_2_1)):
        out += both(licence, text, *terms(text))
    out += both("LGPL-3.0", whole.LGPL_3)
    # The exhibits follow the terms.
    out += both("MPL-2.0", whole.MPL_2, whole.MPL_2[:whole.MPL_2.index("Exhibit A -")])
    out += both("CC0-1.0", whole.CC0_1, whole.CC0_1[whole.CC0_1.index("CC0 1.0 Universal"):])
    out += both("Unlicense", whole.UNLICENSE)
    three = whole.BSD_REGENTS[whole.BSD_REGENTS.index("Redistribution"):]
    holder = (three.replace("REGENTS AND", "COPYRIGHT HOLDERS AND").replace("the University", "the copyright holder"))
    cut = holder.index("3. Neither")
    two = holder[:cut] + holder[holder.index("THIS SOFTWARE"):]
    for licence, title, text in (("BSD-3-Clause", "BSD 3-Clause License", holder),
                                 ("BSD-2-Clause", "BSD 2-Clause License", two)):
        for t in (text.replace("REGENTS OR", x + " OR") for x in ("COPYRIGHT HOLDER", "COPYRIGHT HOLDERS")):
            # Bulleted lists have no numbers.
            bulleted = t.replace("1. Red", "* Red").replace("2. Red", "* Red").replace("3. Nei", "* Nei")
            out += [(licence, x) for x in (t, bulleted, f"{title}\n\n{t}", f"{title}\n\n{bulleted}")]
    out.append(("BSD-3-Clause", three))
    zlib = whole.ZLIB[whole.ZLIB.index("This software is provided"):]
    zero = whole.ZERO_BSD[whole.ZERO_BSD.index("Permission to use"):]
    out += [("Zlib", zlib), ("Zlib", "zlib License\n\n" + zlib), ("0BSD", zero), ("0BSD", "BSD Zero Clause License\n\n" + zero)]
    return tuple(out)


#: Whole licences, looked up beside ``KNOWN``.
WHOLE = _whole_licences()
#: Words, one of which every canonical text above holds; checked when the table is built.
ANCHORS = ("licens", "permission", "redistribution")

PARAGRAPH = r"\n[\x20\t\r]*\n\s*"
#: Known texts of so many canonical characters are looked up in runs of paragraphs, by
#: their first characters: shorter ones are notices of one paragraph.
RUN_CHARS, HEAD_CHARS = 200, 24

#: So many known digests at most are broadcast; more are joined by key.
BROADCAST_DIGESTS = 100_000

#: A line that only states a copyright: no letters before the statement but markup.
COPYRIGHT_LINE = (r"(?m)^[^\p{L}\p{N}\n]*(?:copyright[^\p{L}\p{N}\n]*(?:\(c\)|©|[0-9]{4})[^\n]*"
                  r"|(?:\(c\)|©)[^\p{L}\n]*(?:copyright)?[^\p{L}\n]*[0-9]{4}[^\n]*|all rights reserved[^\p{L}\n]*)$")
#: Equivalent spellings, applied in this order to lower-case text with single blanks.
EQUIVALENT = (
    (r"licenc", "licens"),
    (r"\bsub licens", "sublicens"),
    (r"\bnon commercial\b", "noncommercial"),
    (r"\bnon infringement\b", "noninfringement"),
    (r"\bcopyright owner", "copyright holder"),
    (r"organisation", "organization"),
    (r"merchantibility", "merchantability"),
    (r"\bv([0-9])", "version $1"),
)


def canonical(text: Column) -> Column:
    """Canonical form of a text (null stays null)."""
    c = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    c = F.regexp_replace(c, r"&", " and ")
    c = F.trim(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " "))
    for old, new in EQUIVALENT:
        c = F.regexp_replace(c, old, new)
    return c


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``(digest, licence, head, size)`` of the known texts: their canonical form's digest,
    first characters and length; raises if a text has no anchor word."""
    rows = spark.createDataFrame(list(known), "licence string, body string")
    rows = rows.select("licence", canonical(F.col("body")).alias("body"))
    has = F.lit(False)
    for a in ANCHORS:
        has = has | F.col("body").contains(a)
    rows = rows.select("licence", F.when(has, F.sha2("body", 256)).otherwise(
        F.raise_error(F.concat(F.lit("no anchor word in: "), F.col("body")))).alias("digest"),
        F.substring("body", 1, HEAD_CHARS).alias("head"), F.length("body").alias("size"))
    return rows.groupBy("digest").agg(F.min("licence").alias("licence"), F.min("head").alias("head"),
                                      F.min("size").alias("size"))


def _run_digests(body: Column, shapes: list[tuple[str, int]]) -> Column:
    """Digests of the runs of adjacent paragraphs that begin and measure as one of the ``(head, size)``."""
    if not shapes:
        return F.array().cast("array<string>")
    heads = sorted({h for h, _ in shapes})
    known = F.array(*(F.struct(F.lit(h).alias("head"), F.lit(n).alias("size")) for h, n in sorted(shapes)))
    # A run of n characters has at most (n + 1) / 2 paragraphs.
    most = max(n for _, n in shapes) // 2 + 2

    def once(value, fn):
        """``fn`` of a value that is worked out once, not once per element."""
        return F.flatten(F.transform(F.array(value), fn))

    def at_start(paragraphs, start):
        # Sizes end where a paragraph ends.
        return once(F.array_join(F.slice(paragraphs, start["i"] + 1, most), "\n"), lambda rest: F.transform(
            F.filter(known, lambda k: (k["head"] == start["head"]) & (F.length(rest) >= k["size"])
                     & F.substring(rest, k["size"] + 1, F.lit(1)).isin("", "\n")),
            lambda k: F.sha2(F.translate(F.substring(rest, F.lit(1), k["size"]), "\n", " "), 256)))

    def starts(firsts):
        every = F.transform(firsts, lambda _, i: F.struct(
            F.substring(F.array_join(F.slice(firsts, i + 1, HEAD_CHARS // 2), " "), 1, HEAD_CHARS).alias("head"),
            i.alias("i")))
        return F.filter(every, lambda x: x["head"].isin(heads))

    paragraphs = F.filter(F.transform(F.split(body, PARAGRAPH), canonical), lambda p: p != "")
    return once(paragraphs, lambda ps: once(
        F.transform(ps, lambda p: F.substring(p, 1, HEAD_CHARS)),
        lambda firsts: F.flatten(F.transform(starts(firsts), lambda x: at_start(ps, x)))))


def _unit(part: int, unit: Column | None = None, digest: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(part).alias("part"), (none if unit is None else unit).alias("unit"),
                    (none if digest is None else digest).alias("digest"))


def license_scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, licences, whole_text, n_units)`` for every row.

    ``licences``: the known licences that the whole text, a paragraph, a line
    or a run of adjacent paragraphs equals, sorted and comma-joined (null: none); ``whole_text``: the
    licence that the whole text equals; ``n_units``: matching parts, equal
    ones counted once.  Null and empty texts match nothing; rows with equal
    id and text get the same answer; null ids are kept; an empty table gives
    an empty result; extra columns are ignored.  ``known`` without ``head`` and
    ``size`` is not looked up in runs.
    """
    known = known_digests(docs.sparkSession, (*KNOWN, *WHOLE)) if known is None else known
    shapes = []
    if {"head", "size"} <= set(known.columns):  # collected: a row per whole licence
        shapes = [tuple(r) for r in known.where(F.col("size") >= RUN_CHARS).select("head", "size").distinct().collect()]
    known = known.select("licence", "digest")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("h"), F.length(text).alias("n"),
                       text.alias("body"))
    anchor = "(?i)" + "|".join(a.replace("licens", "licen[cs]") for a in ANCHORS)
    # One row for equal (id, text), so that each is looked up once.
    likely = rows.where(F.col("body").rlike(anchor))
    units = likely.select("id", "h", "n", F.explode(F.array_distinct(F.concat(
        F.array(_unit(0, F.col("body"))),
        F.transform(F.split("body", PARAGRAPH), lambda u: _unit(1, u)),
        F.transform(F.split("body", r"\n"), lambda u: _unit(1, u)),
        F.transform(_run_digests(F.col("body"), shapes), lambda d: _unit(1, digest=d))))).alias("u"))
    units = (units.where(F.col("u.digest").isNotNull() | F.col("u.unit").rlike(anchor))
             .select("id", "h", "n", "u.part",
                     F.coalesce(F.col("u.digest"), F.sha2(canonical(F.col("u.unit")), 256)).alias("digest")))
    side = F.broadcast(known) if known.count() <= BROADCAST_DIGESTS else known
    found = (units.join(side, "digest").groupBy("id", "h", "n")
             .agg(F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"),
                  F.max(F.when(F.col("part") == 0, F.col("licence"))).alias("whole_text"),
                  F.count_distinct("digest").alias("n_units"))
             .select(F.col("id").alias("id_"), F.col("h").alias("h_"), F.col("n").alias("n_"), "licences",
                     "whole_text", "n_units"))
    every = rows.select("id", "h", "n")
    return (every.join(found, F.col("id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_"))
                       & (F.col("n") == F.col("n_")), "left")
            .select(F.col("id").alias(id_col), "licences", "whole_text",
                    F.coalesce("n_units", F.lit(0).cast("long")).alias("n_units")))
