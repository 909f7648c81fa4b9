from tidemark.llm.license_scan import KNOWN, canonical, known_digests, license_scan
from pyspark.sql import functions as F
import pytest


def test_finds_entire_texts_only(spark, docs):
    mit = KNOWN[0][1]
    rows = [(1, mit.upper().replace(" ", "\n  ")), (2, "Copyright (c) 2020 X Y\nAll rights reserved.\n\n" + KNOWN[1][1]),
            (3, "a\n  # Released under the MIT Licence!\nb"), (4, None), (5, ""), (None, "x\n\nSPDX-License-Identifier:  isc"),
            (3, "a\n  # Released under the MIT Licence!\nb"), (6, "we say Released under the MIT License. here"),
            (7, "Licensed under CC BY NC 4.0\nThis work is Licensed under the GNU general public licence, v3"),
            (8, mit + " And more."), (9, "word " * 30_000 + "\nReleased under the MIT License.")]
    got = sorted((str(r.doc_id), r.licences, r.whole_text) for r in license_scan(docs(rows)).collect())
    assert got == sorted([("1", "MIT", "MIT"), ("2", "MIT", "MIT"), ("3", "MIT", None), ("3", "MIT", None),
                          ("4", None, None), ("5", None, None), ("None", "ISC", None), ("6", None, None),
                          ("7", "CC-BY-NC-4.0,GPL-3.0", None), ("8", None, None), ("9", "MIT", None)])
    assert license_scan(docs([])).count() == 0


def test_canonical_form(spark):
    df = spark.createDataFrame([("© 2021 Someone\nThe  LICENCE & sub-licence; Non-Commercial — v2",), (None,),
                                ("The above\ncopyright notice stays",)], "t string")
    assert [r.c for r in df.select(canonical(F.col("t")).alias("c")).collect()] == [
        "the license and sublicense noncommercial version 2", None, "the above copyright notice stays"]


def test_known_texts_need_an_anchor(spark):
    with pytest.raises(Exception, match="no anchor word"):
        known_digests(spark, [("X", "do as you like")]).collect()
    assert known_digests(spark).count() <= len(KNOWN)


USUAL_MIT = KNOWN[0][1].replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")


def test_whole_licences(spark, docs):
    from tidemark.llm import license_texts as whole
    texts = {"Apache-2.0": whole.APACHE_2, "GPL-2.0": whole.GPL_2, "GPL-3.0": whole.GPL_3, "LGPL-2.1": whole.LGPL_2_1,
             "LGPL-3.0": whole.LGPL_3, "MPL-2.0": whole.MPL_2, "CC0-1.0": whole.CC0_1, "Unlicense": whole.UNLICENSE,
             "BSD-3-Clause": whole.BSD_REGENTS, "Zlib": whole.ZLIB, "0BSD": whole.ZERO_BSD}
    rows = [(i, t) for i, t in enumerate(texts.values())]
    # Inside a larger document, wrapped and parted otherwise.
    rows += [(100 + i, "A file\n\n" + t.replace("\n\n", "\n \n\n") + "\n\nThe end.\n") for i, t in rows]
    got = {r.doc_id: r for r in license_scan(docs(rows)).collect()}
    for i, name in enumerate(texts):
        assert got[i].whole_text == name and name in got[i].licences.split(",")
        assert got[100 + i].whole_text is None and name in got[100 + i].licences.split(",")


def test_runs_of_paragraphs(spark, docs):
    rows = [(1, "Intro\n\n" + USUAL_MIT + "\n\nOutro"), (2, "x\n\nMIT License\n\nCopyright (c) 2020 X\n\n" + USUAL_MIT),
            (3, "Intro\n\n" + USUAL_MIT + " And more.\n\nOutro"), (4, "we say " + USUAL_MIT),
            (5, USUAL_MIT.replace("free of charge", "at a price") + "\n\n" + "licence"),
            (6, "y\n\n" + (USUAL_MIT + "\n\nand\n\n") * 50 + "z"), (7, "\n\n".join(KNOWN[0][1].split(" ")) + "\n\nz")]
    got = sorted((r.doc_id, r.licences, r.whole_text, r.n_units) for r in license_scan(docs(rows)).collect())
    assert got == [(1, "MIT", None, 1), (2, "MIT", None, 2), (3, None, None, 0), (4, None, None, 0), (5, None, None, 0),
                   (6, "MIT", None, 1), (7, "MIT", None, 1)]
