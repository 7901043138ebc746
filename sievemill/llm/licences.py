"""License scans: matching statistics against a suffix automaton of licence templates, chained into spans.

The templates' words form one generalised suffix automaton. A document's words are streamed through it; after
each word the automaton knows the longest suffix of the text read so far that stands in some template (the
matching statistics), and by its suffix links the longest one at every place of every template. Where such a
match cannot grow with the next word, it is a maximal match. Matches of `seed` words or more are chained, per
template, by dynamic programming: each match follows the one before in the text, after `gap` further words at most,
and in the template; what overlaps is cut from the later match. A chain that covers `coverage` of the template's
words is a found template; of chains that overlap in the text the one that covers most counts. Known phrases (the
base labels) are looked for word by word in the same pass.

Texts are cut into words by bytes, A-Z lower-cased: everything but ASCII punctuation, white space and controls
belongs to words. The automaton reads only stretches in which neighbouring words are neighbours in a template;
elsewhere no match of two words exists.

Null texts have no words. Null ids and repeated rows are scanned like any other row. Very long texts are scanned
whole; of chains that cover the same number of words the first in the text wins, then the lower template. Without
templates or phrases there are no such labels. Columns of any names may stand beside the two that are read, and
are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.llm import textbytes as tb
from sievemill.llm.workers import lean

#: Phrases and the labels that they give.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices and whole licences (without title and copyright line), by label.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ],
    "mit": [
        "Released under the MIT License",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "isc": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
        AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
        CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
        IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
        OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ],
    "zlib": [
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
        1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This
        notice may not be removed or altered from any source distribution.""",
    ],
    "unlicense": [
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
        form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software
        dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
        successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3
        of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this
        program. If not, see <https://www.gnu.org/licenses/>.""",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    ],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "reserved": ["All rights reserved"],
}


def words_of(text: str) -> list[bytes]:
    c = next(tb.chunks(pa.array([text]), tb.PUNCT, lower=True))
    return [bytes(c.buf[a:b]) for a, b in zip(c.starts, c.ends, strict=True)]


@dataclass(frozen=True, order=True)
class Match:
    start: int  # first word in the text
    at: int  # first word in the template
    length: int


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences; each state of `seed` words or more knows the template places where its words end."""

    def __init__(self, sequences: list[list[int]], seed: int):
        self.sequences, self.seed = sequences, seed
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[list[tuple[int, int]]] = [[]]
        for t, words in enumerate(sequences):
            last = 0
            for i, w in enumerate(words):
                last = self._extend(last, w, own)
                own[last].append((t, i))
        self.places: list[list[tuple[int, int]]] = [list(x) for x in own]
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[s] > 0 and self.length[self.link[s]] >= seed:
                self.places[self.link[s]].extend(self.places[s])

    def _state(self, length: int, step: dict[int, int], link: int, own: list) -> int:
        self.step.append(step), self.link.append(link), self.length.append(length), own.append([])
        return len(self.link) - 1

    def _split(self, p: int, w: int, q: int, own: list) -> int:
        clone = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q], own)
        self.link[q] = clone
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, p: int, w: int, own: list) -> int:
        q = self.step[p].get(w)
        if q is not None:
            return q if self.length[q] == self.length[p] + 1 else self._split(p, w, q, own)
        new = self._state(self.length[p] + 1, {}, 0, own)
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q, own)
        return new

    def matches(self, words: list[int]) -> dict[int, list[Match]]:
        """By template, the matches of `seed` words or more that grow neither to the left nor to the right."""
        out: dict[int, list[Match]] = defaultdict(list)
        step, link, length, seed = self.step, self.link, self.length, self.seed
        state = n = 0
        for i, w in enumerate(words):
            while state and w not in step[state]:
                state = link[state]
                n = length[state]
            if w not in step[state]:
                continue
            state, n = step[state][w], n + 1
            following = words[i + 1] if i + 1 < len(words) else None
            # shorter suffixes stand at further places
            s, m, seen = state, n, set()
            while s and m >= seed:
                for place in self.places[s]:
                    if place not in seen:
                        seen.add(place)
                        t, end = place
                        sequence = self.sequences[t]
                        if end + 1 == len(sequence) or sequence[end + 1] != following:
                            out[t].append(Match(i + 1 - m, end + 1 - m, m))
                s = link[s]
                m = length[s]
        return out


def chains(matches: list[Match], gap: int, need: float) -> list[tuple[int, int, int]]:
    """(first word, word after the last, words covered) of chains that cover `need` or more; none overlap, the longest first, then the first."""
    ordered = sorted(set(matches))
    best: list[tuple[int, int]] = []  # words covered by the best chain that ends with this match, and minus its first word
    live: list[int] = []
    for k, q in enumerate(ordered):
        live = [p for p in live if ordered[p].start + ordered[p].length + gap >= q.start]
        found = (q.length, -q.start)
        for p in live:
            m = ordered[p]
            cut = max(0, m.start + m.length - q.start, m.at + m.length - q.at)
            if cut < q.length and q.start + cut - (m.start + m.length) <= gap:
                found = max(found, (best[p][0] + q.length - cut, best[p][1]))
        best.append(found)
        live.append(k)
    ends = sorted((-n, -first, q.start + q.length) for (n, first), q in zip(best, ordered, strict=True) if n >= need)
    taken: list[tuple[int, int, int]] = []
    for n, first, end in ends:
        k = bisect.bisect_left(taken, (first,))
        if (k == 0 or taken[k - 1][1] <= first) and (k == len(taken) or taken[k][0] >= end):
            taken.insert(k, (first, end, -n))
    return taken


class Scanner:
    def __init__(self, templates: dict[str, list[str]], phrases: dict[str, str], seed: int, gap: int, coverage: float):
        self.seed, self.gap, self.coverage = seed, gap, coverage
        texts = [(label, words_of(t)) for label, ts in templates.items() for t in ts]
        texts = [(label, ws) for label, ws in texts if ws]
        self.labels = [label for label, _ in texts]
        bases = [(words_of(p), label) for p, label in phrases.items()]
        vocabulary = sorted({w for _, ws in texts for w in ws} | {w for ws, _ in bases for w in ws})
        number = {w: i for i, w in enumerate(vocabulary)}
        self.sequences = [[number[w] for w in ws] for _, ws in texts]
        self.phrases = [([number[w] for w in ws], label) for ws, label in bases if ws]
        self.size = len(vocabulary)
        c = next(tb.chunks(pa.array([" ".join(w.decode() for w in vocabulary)]), tb.SPACE))
        h = c.hashes()
        self.by_hash = np.argsort(h)
        self.hashes = h[self.by_hash]
        self.automaton = SuffixAutomaton(self.sequences, seed)
        # neighbours in some template, sorted
        self.pairs = np.array(sorted({a * self.size + b for s in self.sequences for a, b in zip(s, s[1:], strict=False)}), np.int64)

    def numbers(self, c: tb.Chunk) -> np.ndarray:
        """Each word's number in the vocabulary, or -1. The hash finds it."""
        if not self.size:
            return np.full(len(c.starts), -1)
        h = c.hashes()
        at = np.minimum(np.searchsorted(self.hashes, h), self.size - 1)
        return np.where(self.hashes[at] == h, self.by_hash[at], -1)

    def neighbours(self, ids: np.ndarray) -> np.ndarray:
        """Whether each word and the next are neighbours in some template: the only places of matches of two words."""
        out = np.zeros(len(ids), bool)
        if len(ids) > 1 and len(self.pairs):
            key = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * self.size + ids[1:], -1)
            out[:-1] = self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key
        return out

    def spans(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Found templates in one document's word numbers: (template, first word, last word, words covered)."""
        linked = self.neighbours(ids) if self.seed > 1 else ids >= 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], linked.astype(np.int8), [0]])))
        by_template: dict[int, list[Match]] = defaultdict(list)
        for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            high += self.seed > 1  # the last word has its neighbour before it
            if high - low >= self.seed:
                for t, found in self.automaton.matches(ids[low:high].tolist()).items():
                    by_template[t] += [Match(low + m.start, m.at, m.length) for m in found]
        out = [(t, first, end - 1, n) for t, ms in by_template.items() for first, end, n in chains(ms, self.gap, self.coverage * len(self.sequences[t]))]
        return sorted(out, key=lambda f: (f[1], f[0]))


def _scan(scanner: Scanner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for c in tb.chunks(batch.column("text"), tb.PUNCT, lower=True):
                ids = scanner.numbers(c)
                rows = c.word_rows()
                base: dict[int, list[tuple[int, str]]] = defaultdict(list)
                for phrase, label in scanner.phrases:
                    k = len(phrase)
                    at = np.flatnonzero(ids[: len(ids) - k + 1] == phrase[0]) if len(ids) >= k else np.zeros(0, np.int64)
                    for j in range(1, k):
                        at = at[(ids[at + j] == phrase[j]) & (rows[at + j] == rows[at])]
                    for i in at.tolist():
                        base[int(rows[i])].append((i - int(c.row_ptr[rows[i]]), label))
                rare = ids >= 0
                busy = np.bincount(rows[rare], minlength=c.rows) >= scanner.seed
                for i in range(c.rows):
                    places = base.get(i, [])
                    low, high = c.row_ptr[i], c.row_ptr[i + 1]
                    spans = scanner.spans(ids[low:high]) if busy[i] else []
                    score = max((s[3] / len(scanner.sequences[s[0]]) for s in spans), default=0.0)
                    starts = [p for p, _ in places]
                    labels = sorted({label for _, label in places})
                    more = sorted({*labels, *(scanner.labels[s[0]] for s in spans)})
                    out.append((int(high - low), len(places), min(starts, default=None), max(starts, default=None), ",".join(labels), ",".join(more), max(score, 1.0 if places else 0.0), [{"label": scanner.labels[t], "first": a, "last": b, "covered": n} for t, a, b, n in spans]))
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _SPANS]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(list(v), k) for v, k in zip(columns, kinds, strict=True))], ["id", *_NAMES])

    return lean(run)


_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.int64())]))
_SCHEMA = "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label string, first long, last long, covered long>>"


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] | None = None, phrases: dict[str, str] | None = None, seed: int = 3, gap: int = 4, coverage: float = 0.8) -> DataFrame:
    """One row per input row: the id, word count, places of the phrases, labels, score and found template spans."""
    scanner = Scanner(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases, seed, gap, coverage)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return docs.mapInArrow(_scan(scanner), _SCHEMA).withColumnRenamed("id", id_col)


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
