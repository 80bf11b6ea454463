"""Full licence texts, and the query against a plain version of the method."""

import math
import os
import re
from collections import Counter

import pytest

from dinerlake.llm import licenses as L
from dinerlake.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.test_licenses import scan

CUE, COMMENT, LICENCE_FILE = re.compile(L.CUE), re.compile(L.COMMENT), re.compile(L.LICENCE_FILE)


def plain_passages(path, text):
    out, lines = [], text.split("\n")
    paragraphs = re.split(r"\n[ \t\r]*\n\s*", text)
    out += [x for x in lines if CUE.search(x)]
    for pieces, before, after in ((lines, 1, 1), (paragraphs, 0, 0), (paragraphs, 1, 0)):
        if len(pieces) > 1:
            out += [" ".join(pieces[max(0, i - before) : i + 1 + after])
                    for i, x in enumerate(pieces) if CUE.search(x)]
    run = []
    for line in [*lines, "x"]:
        if COMMENT.search(line):
            run.append(line)
            continue
        if len(run) > 1 and CUE.search(" ".join(run)):
            out.append(" ".join(run))
        run = []
    return [(x, False) for x in out] + [(text, True)] * bool(LICENCE_FILE.search(path))


def plain_own(files):
    """path -> (license, score) of the files that state one."""
    def count(text):
        return Counter(re.findall(L.TERM, text.lower()))

    found = [(p, count(x), whole) for p, t in files if t and (CUE.search(t) or LICENCE_FILE.search(p))
             for x, whole in plain_passages(p, t)]
    known = [(n, count(t), False) for n, t in L.TEMPLATES] + [(n, count(t), True) for n, t in L.full_texts()]
    df = Counter(t for _, c, _ in found + known for t in c)
    total = len(found) + len(known)

    def vector(counts):
        w = {t: (1 + math.log(n)) * (math.log((1 + total) / (1 + df[t])) + 1) for t, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    marks = [(n, vector(c), whole) for n, c, whole in known]
    best = {}
    for path, counts, whole in found:
        own = vector(counts)
        for i, (name, mark, full) in enumerate(marks):
            if full and not whole:
                continue
            score = round(sum(x * mark.get(t, 0.0) for t, x in own.items()), 6)
            if score >= (L.LEAST_TEXT if full else L.LEAST):
                best[path] = max(best.get(path, (0, 0, "")), (score, -i, name))
    return {p: (name, score) for p, (score, _, name) in best.items()}


def test_full_texts_are_recognised(spark):
    texts = [(name, text) for name, text in L.full_texts()]
    assert len(texts) > 15
    head = "Some Project\n\nCopyright (c) 2021 Some Author and others\n\n"
    rows = [(f"{i}/LICENSE", head * (i % 2) + text, 0, "") for i, (_, text) in enumerate(texts)]
    want = [(f"{i}/LICENSE", name, "own", None) for i, (name, _) in enumerate(texts)]
    assert scan(spark, rows) == sorted(want, key=str)
    # alone in the table, too
    for name in ("GPL-2.0", "MPL-2.0", "BSD-2-Clause"):
        assert scan(spark, [("COPYING", dict(texts)[name], 0, "")]) == [("COPYING", name, "own", None)]


@pytest.mark.skipif(not os.path.isdir("/usr/share/common-licenses"), reason="no licence texts on this machine")
def test_installed_licence_files(spark):
    names = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-1": "GPL-1.0",
             "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "LGPL-3": "LGPL-3.0"}
    rows = [(f"{f}/COPYING", open(f"/usr/share/common-licenses/{f}").read(), 0, "") for f in names]
    assert scan(spark, rows) == sorted(((f"{f}/COPYING", n, "own", None) for f, n in names.items()), key=str)


def test_statements_over_several_lines(spark):
    rows = [
        ("a/README", "A tool.\n\nThis program is free software; you can redistribute it and/or modify\nit under the terms of the "
         "GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License,\n"
         "or (at your option) any later version.\n\nMore words.", 0, ""),
        ("b/LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007\n\nPreamble and all the rest of it", 0, ""),
        ("c/LICENSE", "An unknown text with nothing to say about any of these terms at all", 0, ""),
    ]
    assert scan(spark, rows) == [("a/README", "GPL-2.0", "own", None), ("b/LICENSE", "AGPL-3.0", "own", None),
                                 ("c/LICENSE", None, "none", None)]


def test_query_against_plain_version(spark):
    got = QUERIES["op6_licenses"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    files = [(f"{d.doc_id // 50}/LICENSE" if d.doc_id % 50 == 0
              else f"{d.doc_id // 50}/{d.source or 'none'}/{d.doc_id}.txt", d.text) for d in docs]
    want = plain_own(files)
    own = {r.path: (r.license, r.score) for r in got if r.origin == "own"}
    assert want and {p: n for p, (n, _) in own.items()} == {p: n for p, (n, _) in want.items()}
    assert all(abs(own[p][1] - want[p][1]) < 2e-6 for p in want)
    held = {p.rsplit("/", 1)[0]: n for p, (n, _) in want.items() if p.endswith("/LICENSE")}
    for r in got:
        if r.origin != "own":
            assert r.license == held.get(r.path.split("/")[0])
