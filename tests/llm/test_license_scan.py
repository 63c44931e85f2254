import math
import re
import textwrap
from collections import Counter

import pytest

from churnlens.llm.common import read_table
from churnlens.llm.license_scan import (FULL_TEXTS, HEADERS, TEMPLATES, Matcher, full_texts, header_blocks, scan_licenses,
                                        words_of)
from churnlens.llm.queries import QUERIES

MIT = "Released under the MIT License."
APACHE = "Licensed under the Apache License, Version 2.0."
SCHEMA = "doc_id long, path string, text string"


def scan(spark, rows, **params):
    docs = spark.createDataFrame(rows, SCHEMA)
    return {r["doc_id"]: r for r in scan_licenses(docs, **params).collect()}


def test_headers_files_and_nearest_ancestor(spark):
    rows = [(1, "r/LICENSE", MIT), (2, "r/a/COPYING", APACHE), (3, "r/a/b/c/x.py", "import os"), (4, "r/z.py", "print()"),
            (5, "r/a/own.py", "code\n# " + APACHE + "\nmore code"), (6, "q/other.py", "nothing here"), (7, "r/a/b/y.py", None),
            (8, None, "no path"), (9, "top", ""), (10, "ra/x", "not below r")]
    got = scan(spark, rows)
    assert {d: (r["license"], r["license_from"], r["inherited_dir"]) for d, r in got.items()} == {
        1: ("MIT", "own", None), 2: ("Apache-2.0", "own", None), 3: ("Apache-2.0", "inherited", "r/a"), 4: ("MIT", "inherited", "r"),
        5: ("Apache-2.0", "own", None), 6: (None, None, None), 7: ("Apache-2.0", "inherited", "r/a"), 8: (None, None, None),
        9: (None, None, None), 10: (None, None, None)}
    assert [d for d, r in got.items() if r["is_license_file"]] == [1, 2]


def test_ties_repeats_root_files_and_empty_table(spark):
    rows = [(1, "LICENSE", MIT), (2, "COPYING", APACHE), (2, "COPYING", APACHE), (3, "d/e/f", "x")]
    docs = spark.createDataFrame([(*r, "y") for r in rows], SCHEMA + ", license string")
    out = scan_licenses(docs).collect()
    assert len(out) == 4 and [(r["license"], r["inherited_dir"]) for r in out if r["doc_id"] == 3] == [("Apache-2.0", "")]
    assert scan_licenses(docs.limit(0)).collect() == []


def test_cosine_by_hand():
    m = Matcher({"T": ["alpha beta beta"]}, 10, {"alpha": 4})
    alpha, beta, rare = math.log(11 / 5) + 1, math.log(11) + 1, math.log(11) + 1
    t = (alpha, (1 + math.log(2)) * beta)
    score, name = m.best(words_of("Alpha, gamma"))
    assert name == "T" and score == pytest.approx(alpha * t[0] / (math.hypot(*t) * math.hypot(alpha, rare)))
    assert m.best(["gamma"]) == (0.0, None) and m.best([]) == (0.0, None)


def wrapped(text, mark, width=72, opening="", closing=""):
    """Every paragraph filled to the width behind a comment mark, as editors do."""
    paragraphs = [" ".join(p.split()) for p in text.split("\n\n") if p.strip()]
    lines = f"\n{mark.rstrip()}\n".join("\n".join(textwrap.wrap(p, width, initial_indent=mark, subsequent_indent=mark)) for p in paragraphs)
    return opening + lines + closing


CODE = "\n" + "\n".join(f"def function_{i}(argument_{i}):\n    return value_{i} + other_{i}" for i in range(60))


@pytest.mark.parametrize("name", FULL_TEXTS)
def test_unmodified_license_files(spark, name):
    text = full_texts()[name][0]
    named = text.replace("<year>", "2019").replace("<owner>", "Jane Doe").replace("<copyright holders>", "Jane Doe and others")
    rows = [(1, "r/LICENSE", named), (2, "r/a/b/x.py", "import os"), (3, "q/y.py", wrapped(named, "# ") + CODE),
            (4, "p/z.c", wrapped(named, " * ", opening="/*\n", closing="\n */") + CODE), (5, "m/w.js", "nothing")]
    got = scan(spark, rows + [(10 + i, f"o/{i}", f"some other file {i}, the text of which is of no license") for i in range(40)])
    assert [got[d]["license"] for d in (1, 2, 3, 4, 5)] == [name] * 4 + [None]
    assert got[1]["is_license_file"] and got[2]["inherited_dir"] == "r"
    assert not any(got[d]["license"] for d in range(10, 50))


def test_wrapped_headers(spark):
    gpl3 = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\n"
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
            "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.\n\n"
            "You should have received a copy of the GNU General Public License along with this program.  If not, see "
            "<https://www.gnu.org/licenses/>.")
    mpl = ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed "
           "with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.")
    lgpl = gpl3.replace("program", "library").replace("General", "Lesser General").replace("version 3", "version 2.1")
    headers = {"GPL-3.0": gpl3, "GPL-2.0": gpl3.replace("version 3", "version 2"), "LGPL-2.1": lgpl, "MPL-2.0": mpl,
               "AGPL-3.0": gpl3.replace("General", "Affero General"), "Apache-2.0": HEADERS["Apache-2.0"][0],
               "MIT": TEMPLATES["MIT"][1], "BSD-3-Clause": TEMPLATES["BSD-3-Clause"][1]}
    rows, want = [], {}
    for name, text in headers.items():
        for copyright in ("", "Copyright (C) 2021 Jane Doe\n\n"):
            for mark, opening, closing in (("# ", "#!/bin/sh\n", ""), ("// ", "", ""), (" * ", "/*\n", "\n */"), ("", '"""', '"""'), ("", "", "\n")):
                want[len(rows)] = name
                rows.append((len(rows), f"d{len(rows)}/x", wrapped(copyright + text, mark, 60, opening, closing) + CODE))
    got = scan(spark, rows)
    assert {d: r["license"] for d, r in got.items()} == want


def test_blocks_of_lines():
    lines = ["/* a", " * b", " *", " * c */", "int x;", "// d", "// e", "", "dnl f", "g", "", "h", '"""', "i", '"""', "k"]
    bare, ranges = header_blocks(lines)
    assert ranges == {(0, 2), (0, 4), (5, 7), (9, 12)} and bare[0].strip() == "a" and bare[8].strip() == "f"
    assert header_blocks([""]) == ([""], set())


def plain_scan(files):
    """{id: (license, own score, from, directory)}, every text compared with every template, every ancestor walked."""
    words = lambda t: re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", t.lower())
    kinds = [{k: TEMPLATES.get(k, []) + HEADERS.get(k, []) for k in {**TEMPLATES, **HEADERS}}, full_texts()]
    known = {w for kind in kinds for texts in kind.values() for t in texts for w in words(t)}
    held = Counter(w for _, _, text in files for w in set(words(text)) & known)
    idf = lambda w: math.log((1 + len(files)) / (1 + held[w])) + 1

    def vector(found):
        v = {w: (1 + math.log(c)) * idf(w) for w, c in Counter(found).items()}
        return v, math.sqrt(sum(x * x for x in v.values()))

    flat = [[(name, *vector(words(t))) for name in sorted(kind) for t in kind[name]] for kind in kinds]

    def best(found, kind):
        if not known & set(found):
            return 0.0, ""
        v, size = vector(found)
        scores = [(round(sum(x * u.get(w, 0.0) for w, x in v.items()) / (size * n), 12), name) for name, u, n in flat[kind]]
        return max(scores, key=lambda x: x[0])  # the first name of equal ones

    own, folders = {}, {}
    for d, path, text in files:
        lines = text.split("\n")
        bare, ranges = header_blocks(lines)
        units = [words(text), *map(words, lines)] + [words("\n".join(bare[i:j])) for i, j in ranges if (i, j) != (0, len(lines))]
        short, full = (max(best(u, kind) for u in units) for kind in (0, 1))
        score, name = full if full[0] >= 0.75 else max(short, full)
        own[d] = (name if score >= 0.75 else None, score)
        if path is not None and max(best(units[0], 0), best(units[0], 1))[0] >= 0.75:
            folders.setdefault(path.rpartition("/")[0], []).append((-score, name))
    out = {}
    for d, path, _ in files:
        name, score = own[d]
        at, where = path.rpartition("/")[0], None
        while name is None and where is None:
            if at in folders:
                where, name = at, min(folders[at])[1]
            elif not at:
                break
            else:
                at = at.rpartition("/")[0]
        out[d] = (name, score, None if name is None else "own" if where is None else "inherited", where)
    return out


def test_query_equals_a_plain_scan(spark):
    small = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in QUERIES["op4_license_scan"](spark, small).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in read_table(spark, small, "documents").collect()}
    assert len({r["path"].count("/") for r in got.values()}) == 3
    want = plain_scan([(d, got[d]["path"], text) for d, text in texts.items()])
    assert got.keys() == want.keys() and any(name for name, *_ in want.values())
    for d, (name, score, source, where) in want.items():
        r = got[d]
        assert (r["license"], r["license_from"], r["inherited_dir"]) == (name, source, where), d
        assert r["own_score"] == pytest.approx(score, abs=1e-9)
