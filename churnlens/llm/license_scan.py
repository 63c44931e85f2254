"""License scans: sparse TF-IDF cosine to templates, then directory inheritance.

Every line of a file, every block of consecutive comment or text lines (a wrapped license
header) and the whole file (a license file) is compared with license templates as sparse
TF-IDF vectors: short notices, standard headers and the full texts of ``license_texts``.
Document frequencies of the template words come from all files. A file without a license of its own takes that of
the nearest ancestor directory that holds a license file, found by joining the
ancestor paths of such files with the directories of license files.
"""

from __future__ import annotations

import math
import pkgutil
import re
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.session import materialize

from .common import map_arrow, text_of

#: Short notices of public licenses by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."],
}
_GNU = ["This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by "
        "the Free Software Foundation, either version {2} of the License, or (at your option) any later version.",
        "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
        "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details. You should have received a "
        "copy of the GNU {1} along with this {0}. If not, see https://www.gnu.org/licenses/."]


def _gnu(work: str, name: str, version: str) -> list[str]:
    first, both = (t.format(work, name, version) for t in (_GNU[0], " ".join(_GNU)))
    return [first, both]


#: Standard headers of source files. Licenses that read nearly like another one stand here and among the
#: full texts too, so that none is taken for its neighbour.
HEADERS = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
                   "See the License for the specific language governing permissions and limitations under the License."],
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "GPL-2.0": _gnu("program", "General Public License", "2"),
    "GPL-3.0": _gnu("program", "General Public License", "3"),
    "AGPL-3.0": _gnu("program", "Affero General Public License", "3"),
    "LGPL-2.1": _gnu("library", "Lesser General Public License", "2.1"),
    "LGPL-3.0": _gnu("library", "Lesser General Public License", "3"),
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
}
FULL_TEXTS = ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "GPL-2.0",
              "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0")
_WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
_CLOSED_BY = {"/*": "*/", "<!--": "-->", '"""': '"""', "'''": "'''", "(*": "*)", "{-": "-}", "--[[": "]]"}
_START = re.compile(r"\s*(?:(/\*|<!--|\"\"\"|'''|\(\*|\{-|--\[\[)|(//|#|--|;|%|dnl\b|rem\b)?)", re.I)
_SAYS = re.compile(r"[^\W_]")


def full_texts() -> dict[str, list[str]]:
    """The whole license texts, read on the driver."""
    return {name: [pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode()] for name in FULL_TEXTS}


def header_blocks(lines: list[str]) -> tuple[list[str], set[tuple[int, int]]]:
    """(the lines without the comment marks before them, ranges [i, j) of lines that stand together): runs of
    consecutive lines of one kind (text, a line comment's mark, or inside a block comment), once up to the next
    empty line or bare mark and once across these."""
    bare, kinds, closer = [], [], None
    for line in lines:
        if closer is None:
            m = _START.match(line)
            rest = line[m.end():]
            kind = "block" if m[1] else (m[2] or "").lower()
            closer = _CLOSED_BY[m[1]] if m[1] else None
        else:
            rest, kind = line, "block"
        if closer is not None and closer in rest:
            closer = None
        bare.append(rest)
        kinds.append(kind if _SAYS.search(rest) else None)
    ranges = set()
    for across in (False, True):
        start = end = 0  # the run so far
        for i, kind in enumerate(kinds):
            if kind is None and across:
                continue
            if start < end and kind == kinds[start]:
                end = i + 1
                continue
            ranges.add((start, end))
            start, end = (i, i + 1) if kind is not None else (i, i)
        ranges.add((start, end))
    return bare, {(i, j) for i, j in ranges if j - i > 1}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def document_frequencies(files: DataFrame, text_col: str, vocabulary: frozenset[str]) -> tuple[int, dict[str, int]]:
    """(number of files, files that hold each vocabulary word), over all files. The
    vocabulary is that of the templates, so what reaches the driver is bounded by it."""
    def run(batches):
        for batch in batches:
            held: Counter = Counter()
            for text in batch.column(0):
                held.update(vocabulary.intersection(words_of(text.as_py())))
            held[""] = batch.num_rows
            yield pa.RecordBatch.from_pydict({"w": list(held), "n": pa.array(held.values(), pa.int64())})

    rows = map_arrow(files.select(text_of(text_col).alias("t")), run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    counts = {r["w"]: int(r["n"]) for r in rows.collect()}
    return counts.pop("", 0), counts


class Matcher:
    """Cosine of a text to the templates, notices and full texts apart. A word's weight is
    (1 + ln count) * (ln((1 + N) / (1 + df)) + 1); words outside the templates' vocabulary count as held by no file."""

    def __init__(self, templates: dict[str, list[str]], n_files: int, frequencies: dict[str, int],
                 full: dict[str, list[str]] | None = None):
        counts = [[(name, Counter(words_of(t))) for name in sorted(kind) for t in kind[name]] for kind in (templates, full or {})]
        self.n_short, flat = len(counts[0]), counts[0] + counts[1]
        self.names = [name for name, _ in flat]
        self.index = {w: i for i, w in enumerate(sorted({w for _, c in flat for w in c}))}
        self.vocabulary = frozenset(self.index)
        idf = [math.log((1 + n_files) / (1 + frequencies.get(w, 0))) + 1 for w in self.index]
        self.idf = np.array([*idf, math.log(1 + n_files) + 1])  # the last one is any other word's
        self.units = np.zeros((len(idf) + 1, len(flat)))
        for k, (_, c) in enumerate(flat):
            at, x = self._vector(c)
            self.units[at, k] = x / math.sqrt(x @ x)

    def _vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        at = np.fromiter(map(self.index.get, counts, repeat(len(self.index))), np.int64, len(counts))
        return at, (1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))) * self.idf[at]

    def matches(self, words: list[str]) -> list[tuple[float, str | None]]:
        """(score, name) of the best notice and of the best full text."""
        if self.vocabulary.isdisjoint(words):
            return [(0.0, None), (0.0, None)]
        at, x = self._vector(Counter(words))
        scores = np.round((x @ self.units[at]) / math.sqrt(x @ x), 12)  # ties do not hang on the order of a sum
        out = []
        for low, part in ((0, scores[: self.n_short]), (self.n_short, scores[self.n_short:])):
            k = int(part.argmax()) if len(part) else -1
            out.append((float(part[k]), self.names[low + k]) if len(part) and part[k] > 0 else (0.0, None))
        return out

    def best(self, words: list[str]) -> tuple[float, str | None]:
        return max(self.matches(words), key=lambda x: x[0])


def scan_licenses(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
                  threshold: float = 0.75, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per file: id, path, ``own_license`` and ``own_score`` (best of its lines, header blocks and whole
    text), ``is_license_file`` (the whole text reaches the threshold), ``license``, ``license_from`` ('own',
    'inherited' or null) and ``inherited_dir``.

    What reaches the threshold for a full text counts before what only matches a notice, as notices of one
    license may stand in the text of another. Own ``templates`` replace notices, headers and full texts alike.

    A path's directory is what stands before its last '/', '' without one. Of several license files
    in a directory the one of highest score counts, then the smallest license name. Null text counts
    as empty and matches nothing; a null path inherits nothing. Repeated rows are files of their own.
    An empty table gives an empty result; only the three named columns are read.
    """
    full = {}
    if templates is None:
        templates = {name: TEMPLATES.get(name, []) + HEADERS.get(name, []) for name in {**TEMPLATES, **HEADERS}}
        full = full_texts()
    vocabulary = frozenset(w for texts in [*templates.values(), *full.values()] for t in texts for w in words_of(t))
    match = Matcher(templates, *document_frequencies(files, text_col, vocabulary), full)

    def of_file(text: str) -> tuple[float, str | None, bool]:
        """(score, name, whether the whole text reaches the threshold)"""
        lines = text.split("\n")
        bare, ranges = header_blocks(lines)
        parts = {line: words_of(line) for line in lines}
        whole = [w for line in lines for w in parts[line]]
        if match.vocabulary.isdisjoint(whole):
            return 0.0, None, False
        ranges.discard((0, len(lines)))
        if ranges:
            bare = [words_of(line) for line in bare]
        units = [whole, *parts.values(), *([w for line in bare[i:j] for w in line] for i, j in sorted(ranges))]
        found = [match.matches(words) for words in units]
        is_file = max(score for score, _ in found[0]) >= threshold
        score, name = max((m for pair in found for m in pair), key=lambda x: (x[0], x[1] or ""))
        of_full = max((pair[1] for pair in found), key=lambda x: (x[0], x[1] or ""))
        return (*(of_full if of_full[0] >= threshold else (score, name)), is_file)

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for text in batch.column(2):
                score, name, is_file = of_file(text.as_py())
                for column, value in zip(out, (name if score >= threshold else None, score, is_file)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out[0], pa.string()),
                                              pa.array(out[1], pa.float64()), pa.array(out[2], pa.bool_())],
                                             names=["_id", "_path", "own_license", "own_score", "is_license_file"])

    rows = files.select(F.col(id_col).cast("long").alias("_id"), F.col(path_col).cast("string").alias("_path"),
                        text_of(text_col).alias("_text"))
    own = map_arrow(rows, run, "_id long, _path string, own_license string, own_score double, is_license_file boolean")
    own = materialize(own, "own-licenses")  # read by three branches below
    own = own.withColumn("_dir", F.when(F.instr("_path", "/") > 0, F.regexp_replace("_path", "/[^/]*$", "")).otherwise(
        F.when(F.col("_path").isNotNull(), F.lit(""))))

    best = Window.partitionBy("_at").orderBy(F.col("own_score").desc(), "own_license")
    # one license per directory; scores are first reduced per (directory, license)
    folders = (own.filter("is_license_file AND _dir IS NOT NULL").groupBy(F.col("_dir").alias("_at"), "own_license")
               .agg(F.max("own_score").alias("own_score")).withColumn("_r", F.row_number().over(best)).filter("_r = 1")
               .select("_at", F.col("own_license").alias("_license")))
    # distinct directories that need a license, each with its ancestors: files join only their own directory
    parts = F.split("_dir", "/")
    asking = own.filter("own_license IS NULL AND _dir IS NOT NULL").select("_dir").distinct()
    ancestors = asking.select("_dir", F.explode(F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("at")))).alias("_a"))
    found = (ancestors.join(folders, F.col("_a.at") == F.col("_at"))
             .groupBy(F.col("_dir").alias("_for")).agg(F.max(F.struct("_a.depth", "_license", "_at")).alias("_near")))
    # always merged: whether it is broadcast would hang on which stage ends first
    out = own.join(found.hint("merge"), (F.col("_dir") == F.col("_for")) & F.col("own_license").isNull(), "left")
    return out.select(F.col("_id").alias(id_col), F.col("_path").alias(path_col), "own_license", "own_score", "is_license_file",
                      F.coalesce("own_license", "_near._license").alias("license"),
                      F.when(F.col("own_license").isNotNull(), "own").when(F.col("_near").isNotNull(), "inherited").alias("license_from"),
                      F.when(F.col("own_license").isNull(), F.col("_near._at")).alias("inherited_dir"))
