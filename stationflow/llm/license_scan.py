"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory above.

Windows of consecutive lines of a file (headers, titles, SPDX lines) and the file as a whole (a licence file) are
vectors over the words of the templates; words outside them count towards the
length with the weight of an unseen word. Document frequencies are counted over
all files. A directory's licence is that of a licence file in it; a file without a
licence of its own takes that of its nearest directory above that has one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationflow.llm.arrowtext import NOT_ALNUM, bounded_batches, buffers, chunks, strings, word_hashes
from stationflow.session import materialise

THRESHOLD = 0.6
#: Lines of a header that are looked at together.
WINDOWS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)
BLOCK_TOKENS, BLOCK_LINES = 1 << 16, 1 << 14
_NEWLINE = 10

_GPL_TERMS = "as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."
_GPL_WARRANTY = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_FORMS = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAME = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AS_IS = '''THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'''

#: Notices, titles with version, standard headers and bodies of common licences: (licence, text). Fixed values.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", '''Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'''),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-Clause License."),
    ("BSD-2-Clause", f"{_BSD_GRANT} {_BSD_FORMS} {_BSD_AS_IS}"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD 3-Clause License."),
    ("BSD-3-Clause", f"{_BSD_GRANT} {_BSD_FORMS} {_BSD_NAME} {_BSD_AS_IS}"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    *[(spdx, f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} {_GPL_TERMS.format(v=v)} {_GPL_WARRANTY.format(name=name)}") for spdx, name, v in (
        ("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"), ("LGPL-2.1", "Lesser General Public License", "2.1"),
        ("LGPL-3.0", "Lesser General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3"),
    )],
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", '''Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'''),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]
TEMPLATES += [(spdx, f"SPDX-License-Identifier: {spdx}{more}") for spdx in sorted({name for name, _ in TEMPLATES}) for more in (("-only", "-or-later") if "GPL" in spdx else ("",))]


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    offsets, data = buffers(pa.array(texts, pa.string()))
    return word_hashes(offsets, data, NOT_ALNUM)


def _terms(templates: list[tuple[str, str]]) -> np.ndarray:
    """Hashes of the templates' words: the columns of the sparse matrix."""
    return np.unique(_words([text for _, text in templates])[0])


def _columns(words: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Each word's column, or -1."""
    at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
    return np.where(terms[at] == words, at, -1)


def _frequencies(batches: Iterator[pa.RecordBatch], templates: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """Files and, per column, files that have the word: one row per column and task."""
    terms = _terms(templates)
    files, found = 0, np.zeros(len(terms), np.int64)
    for batch in batches:
        offsets, data = buffers(strings(batch.column(0)))
        for lo, hi in chunks(offsets):
            words, counts = word_hashes(offsets[lo : hi + 1], data, NOT_ALNUM)
            column, file = _columns(words, terms), np.repeat(np.arange(hi - lo), counts)
            hit = column >= 0
            found += np.bincount(np.unique(file[hit] * len(terms) + column[hit]) % len(terms), minlength=len(terms))
            files += hi - lo
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(terms) + 1)), pa.array(np.append(found, files))], names=["term", "df"])


def _matrix(templates: list[tuple[str, str]], idf: np.ndarray) -> np.ndarray:
    """Unit vectors of the templates, one column each."""
    words, counts = _words([text for _, text in templates])
    out = np.zeros((len(idf), len(templates)))
    np.add.at(out, (_columns(words, _terms(templates)), np.repeat(np.arange(len(templates)), counts)), 1.0)
    out *= idf[:, None]
    return out / np.linalg.norm(out, axis=0)


def _lengths(group: np.ndarray, column: np.ndarray, groups: int, idf: np.ndarray, unseen: float) -> np.ndarray:
    """Squared lengths of the TF-IDF vectors of `groups` groups of words; unseen words count one by one."""
    hit = column >= 0
    keys, tf = np.unique(group[hit] * len(idf) + column[hit], return_counts=True)
    known = np.bincount(keys // len(idf), weights=(tf * idf[keys % len(idf)]) ** 2, minlength=groups)
    return known + np.bincount(group[~hit], minlength=groups) * unseen**2


def _dots(group: np.ndarray, column: np.ndarray, groups: int, weights: np.ndarray) -> np.ndarray:
    """Products of each group's vector with every template, a block of words at a time. Groups of words come in order."""
    out = np.zeros((groups, weights.shape[1]))
    hit = np.flatnonzero(column >= 0)
    for lo in range(0, len(hit), BLOCK_TOKENS):
        part = hit[lo : lo + BLOCK_TOKENS]
        of = group[part]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        out[of[first]] += np.add.reduceat(weights[column[part]], first, axis=0)
    return out


def _windows(dots: np.ndarray, column: np.ndarray, ends: np.ndarray, last: np.ndarray, idf: np.ndarray, unseen: float, threshold: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first line, lines, cosines) of every window of lines inside a file that reaches `threshold`.

    Product and a lower bound of the squared length (each word taken to occur once) add up over lines, so
    sliding sums bound every cosine from above; only windows whose bound reaches the threshold are counted out.
    `ends` are the word bounds of the lines, `last` the line after each line's file.
    """
    weight = np.where(column >= 0, idf[column], unseen) ** 2
    least = np.diff(np.concatenate([[0.0], np.cumsum(weight)])[ends])
    n = len(dots)
    for lo in range(0, n, BLOCK_LINES):
        hi = min(lo + BLOCK_LINES + max(WINDOWS), n)
        run = np.concatenate([np.zeros((1, dots.shape[1])), np.cumsum(dots[lo:hi], axis=0)])
        low = np.concatenate([[0.0], np.cumsum(least[lo:hi])])
        for size in WINDOWS:
            begin = np.arange(lo, min(lo + BLOCK_LINES, n - size + 1))
            begin = begin[begin + size <= last[begin]]
            begin = begin[ends[begin + 1] > ends[begin]] if len(begin) else begin  # a window begins with words
            if not len(begin):
                continue
            near = run[begin - lo + size] - run[begin - lo]
            bound = np.sqrt(np.maximum(low[begin - lo + size] - low[begin - lo], 1e-12))
            for k in np.flatnonzero(near.max(axis=1) >= (threshold - 1e-6) * bound):
                at = int(begin[k])
                words = column[ends[at] : ends[at + size]]
                exact = dots[at : at + size].sum(axis=0) / np.sqrt(_lengths(np.zeros(len(words), np.int64), words, 1, idf, unseen)[0])
                if exact.max() >= threshold:
                    yield at, size, exact


def _scan(batches: Iterator[pa.RecordBatch], templates: list[tuple[str, str]], idf: np.ndarray, unseen: float, threshold: float) -> Iterator[pa.RecordBatch]:
    terms, names = _terms(templates), [name for name, _ in templates]
    weights = _matrix(templates, idf) * idf[:, None]
    for batch in batches:
        offsets, data = buffers(strings(batch.column(1)))
        for lo, hi in chunks(offsets):
            at = offsets[lo : hi + 1] - offsets[lo]
            text = data[offsets[lo] : offsets[hi]]
            cuts = np.unique(np.concatenate([at, np.flatnonzero(text == _NEWLINE) + 1]))
            words, counts = word_hashes(cuts, text, NOT_ALNUM)
            column, line = _columns(words, terms), np.repeat(np.arange(len(cuts) - 1), counts)
            files = hi - lo
            file = np.searchsorted(at, cuts[:-1], "right") - 1  # the last text that begins there, so none that is empty
            dots = _dots(line, column, len(cuts) - 1, weights)
            whole = np.zeros((files, len(names)))
            np.add.at(whole, file, dots)
            size = np.sqrt(np.maximum(_lengths(file[line], column, files, idf, unseen), 1e-12))
            whole /= size[:, None]
            # Of equal cosines the template nearest to the whole file decides, so a version stated elsewhere tells titles without one apart.
            best = [(0.0, 0.0, 0, 0, "", -1, 0)] * files
            for k in np.flatnonzero(whole.max(axis=1, initial=0) >= threshold):
                t = int(whole[k].argmax())
                best[k] = (round(whole[k, t], 9), whole[k, t], 1, 0, names[t], -1, 0)
            last = np.searchsorted(cuts, at[file + 1]) if len(file) else file
            for first, n, cosine in _windows(dots, column, np.concatenate([[0], np.cumsum(counts)]), last, idf, unseen, threshold):
                k = file[first]
                begin = int(np.searchsorted(cuts, at[k]))
                for t in np.flatnonzero(cosine >= cosine.max() - 1e-9):
                    best[k] = max(best[k], (round(cosine[t], 9), whole[k, t], -n, begin - first, names[t], first - begin, n), key=lambda x: x[:4])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, files), pa.array([b[4] for b in best], pa.string()), pa.array([float(b[0]) for b in best]), pa.array([b[5] for b in best], pa.int32()), pa.array([b[6] for b in best], pa.int32())],
                names=["path", "own_license", "similarity", "line", "lines"],
            )


def own_licenses(files: DataFrame, templates: list[tuple[str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """(path, own_license, similarity, line, lines) of every row of `files` (path, text).

    The best template among all windows of lines (the first line and how many) and the whole file (line -1); an empty
    name where none reaches `threshold`. Of equal windows the template nearest to the whole file wins, then the shorter and earlier window.
    """
    bounded_batches(files.sparkSession)
    counted = files.select("text").mapInArrow(partial(_frequencies, templates=templates), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = dict(counted.collect())  # one row per word of the templates
    n = len(_terms(templates))
    total = df.get(n, 0)
    idf = np.array([math.log((total + 1) / (df.get(k, 0) + 1)) + 1 for k in range(n)])
    scan = partial(_scan, templates=templates, idf=idf, unseen=math.log(total + 1) + 1, threshold=threshold)
    return files.select("path", "text").mapInArrow(scan, "path string, own_license string, similarity double, line int, lines int")


def directory(path):
    """The directory of a path, empty at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, license_names: str = r"(?i)^(licen[sc]e|copying|notice)(\.\w+)?$") -> DataFrame:
    """(path, own_license, similarity, line, lines, license, inherited_from) of every row of `files` (path, text).

    `license` is the file's own licence or that of the nearest directory above (its own
    included) with a licence file, whose directory `inherited_from` names; both null where there
    is neither. A licence file is one whose name matches `license_names` and that has a licence;
    of several in a directory the most similar decides, then the first by path. Null
    and empty texts have no licence of their own; a null path has no directory; repeated rows come back each;
    other columns are ignored.
    """
    own = materialise(own_licenses(files, templates, threshold), "licenses")
    name = F.regexp_extract("path", r"[^/]*$", 0)
    stated = own.filter(name.rlike(license_names) & (F.col("own_license") != "")).select(directory(F.col("path")).alias("above"), "own_license", "similarity", "path")
    best = F.min_by("own_license", F.struct(-F.col("similarity"), F.col("path")))
    rules = materialise(stated.groupBy("above").agg(best.alias("found")), "rules")
    folders = own.filter("path is not null").select(directory(F.col("path")).alias("folder")).distinct()
    parts = F.split("folder", "/")
    # The root (an empty name) is above everything.
    chain = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/")))
    climbed = folders.select("folder", F.explode(F.array_distinct(chain)).alias("above")).join(rules, "above")
    nearest = climbed.groupBy("folder").agg(F.max_by(F.struct("found", "above"), F.length("above")).alias("x")).select("folder", "x.*")
    told = own.withColumn("folder", directory(F.col("path"))).join(nearest, "folder", "left")
    mine = F.col("own_license") != ""
    return told.select("path", F.when(mine, F.col("own_license")).alias("own_license"), "similarity", "line", "lines", F.when(mine, F.col("own_license")).otherwise(F.col("found")).alias("license"), F.when(~mine, F.col("above")).alias("inherited_from"))
