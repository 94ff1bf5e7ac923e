"""License scans: matching statistics of a generalised suffix automaton of licence words, chained into spans.

One automaton holds the words of every template and phrase. Each text is streamed through it once: after
each word it is in the state of the longest licence passage that ends there. Long matches of a template are
chained in order, over small gaps, into spans with the share of the template's words that they cover. A span
has its label if it covers enough of the words that tell the licence, those in no template of another family
(labels that begin alike, as cc-by and cc-by-nc, and those of the GNU licences); of overlapping spans of one family the fullest has it. Only
runs of words that licences use at all are streamed; any other word returns the automaton to its root.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import bounded_batches, pieces, read_table
from eventmart.llm.license_texts import FAMILIES, NOTICES
from eventmart.llm.words import Words

# Phrases whose every place counts, and the opening terms and whole notices of well-known licences.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
]

TEMPLATES += [(f"cc-by{short}", f"This work is licensed under a Creative Commons Attribution{name} 4.0 International License") for short, name in (("-nc", "-NonCommercial"), ("-nc-nd", "-NonCommercial-NoDerivatives"), ("-nc-sa", "-NonCommercial-ShareAlike"), ("-nd", "-NoDerivatives"), ("-sa", "-ShareAlike"))]
_AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE'
TEMPLATES += [
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _AS_IS),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/"),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE'),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
]
TEMPLATES += NOTICES

#: Words of the shortest match that counts for a template, and the longest gap within a chain.
LEAST_MATCH, LARGEST_GAP = 4, 12
#: Share of a template's words, and of those of them that tell its licence, that a chain must cover for its label.
LEAST_COVERAGE = 0.5


class SuffixAutomaton:
    """Generalised suffix automaton over lists of word numbers."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: (sequence, end) pairs of each state
        self.ends: list[set[tuple[int, int]]] = [set()]
        for k, sequence in enumerate(sequences):
            last = 0
            for end, word in enumerate(sequence, 1):
                last = self._extend(last, word)
                self.ends[last].add((k, end))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state]
        self.ends[0] = set()

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        copy = self._state(self.length[at] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while at != -1 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            target = self.next[last][word]
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new, at = self._state(self.length[last] + 1, 0, {}), last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at != -1:
            target = self.next[at][word]
            self.link[new] = target if self.length[target] == self.length[at] + 1 else self._split(at, word, target)
        return new

    def stream(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length of the longest match) after each word."""
        state, length = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield state, length


class Scanner:
    """The automaton with its labels; small and the same for every task."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        column = pa.array([t for _, t in templates] + list(phrases))
        w = Words(column)
        self.vocabulary, number = np.unique(w.hash, return_inverse=True)
        sequences = [number[a:b].tolist() for a, b in zip(w.rows[:-1], w.rows[1:], strict=True)]
        self.labels, self.sizes = [label for label, _ in templates] + list(phrases.values()), [len(s) for s in sequences]
        self.first_phrase = len(templates)
        self.family = [FAMILIES.get(first, first) for first in (label.split("-")[0] for label in self.labels)]
        #: of each template, how many of its first words tell its licence
        self.telling = []
        for k in range(self.first_phrase):
            others = {x for j in range(self.first_phrase) if self.family[j] != self.family[k] for x in sequences[j]}
            self.telling.append(np.cumsum([0, *(x not in others for x in sequences[k])]).tolist())
        self.automaton = SuffixAutomaton(sequences)
        #: phrases that end where a state's passages end, with their sizes: its own and those of its suffix link
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in self.automaton.ends]
        for state in sorted(range(1, len(self.phrases)), key=lambda s: self.automaton.length[s]):
            own = [(k, self.sizes[k]) for k, end in self.automaton.ends[state] if k >= self.first_phrase and end == self.sizes[k] <= self.automaton.length[state]]
            self.phrases[state] = sorted({*own, *self.phrases[self.automaton.link[state]]})

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, -1 for words of no licence."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def run(self, words: list[int], first: int, places: list, matches: list) -> None:
        """Adds phrase places (phrase, word) and ended matches (template, first word, first template word, words)."""
        before = (0, 0)
        for at, now in enumerate([*self.automaton.stream(words), (0, 0)], first):
            state, length = before
            if length >= LEAST_MATCH and now[1] <= length:
                matches += [(k, at - length, end - length, length) for k, end in self.automaton.ends[state] if k < self.first_phrase and end >= length]
            for k, size in self.phrases[now[0]]:
                if now[1] >= size:
                    places.append((k, at - size + 1))
            before = now

    def spans(self, matches: list) -> list[dict]:
        """Chains: of each template, matches in order in text and template with small gaps between them, each joined to the chain that
        covers most so far; labelled
        are those that tell their licence and are the fullest of their family where they stand."""
        chains: list[list] = []  # template, first word, stop, template stop, covered words, covered words that tell
        near: list[list] = []
        for k, word, place, size in sorted(matches, key=lambda m: m[1:]):
            near = [c for c in near if word - c[2] <= LARGEST_GAP]
            fits = [c for c in near if c[0] == k and c[2] <= word and 0 <= place - c[3] <= LARGEST_GAP]
            told = self.telling[k][place + size] - self.telling[k][place]
            if fits:
                best = max(fits, key=lambda c: c[4])
                best[2:] = [word + size, place + size, best[4] + size, best[5] + told]
            else:
                chains.append([k, word, word + size, place + size, size, told])
                near.append(chains[-1])
        labelled: set[int] = set()
        stretches: dict[str, dict[str, Stretches]] = {}  # of what is labelled, by family and label
        for i, c in sorted(enumerate(chains), key=lambda x: (-x[1][4], -x[1][4] / self.sizes[x[1][0]], x[1])):
            k = c[0]
            tells = c[5] > 0 or self.telling[k][-1] == 0
            if tells and c[4] >= LEAST_COVERAGE * self.sizes[k] and c[5] >= LEAST_COVERAGE * self.telling[k][-1]:
                own = stretches.setdefault(self.family[k], {})
                if not any(other.meets(c[1], c[2]) for label, other in own.items() if label != self.labels[k]):
                    labelled.add(i)
                    own.setdefault(self.labels[k], Stretches()).add(c[1], c[2])
        return [{"label": self.labels[c[0]], "first": c[1], "stop": c[2], "coverage": c[4] / self.sizes[c[0]], "labelled": i in labelled} for i, c in enumerate(chains)]


class Stretches:
    """A set of word places as sorted stretches that do not touch."""

    def __init__(self):
        self.firsts: list[int] = []
        self.stops: list[int] = []

    def meets(self, first: int, stop: int) -> bool:
        """Whether any place of [first, stop) is in the set."""
        at = bisect_right(self.stops, first)
        return at < len(self.firsts) and self.firsts[at] < stop

    def add(self, first: int, stop: int) -> None:
        a, b = bisect_left(self.stops, first), bisect_right(self.firsts, stop)
        if a < b:
            first, stop = min(first, self.firsts[a]), max(stop, self.stops[b - 1])
        self.firsts[a:b], self.stops[a:b] = [first], [stop]


def license_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Per row of docs: key, n_words, places (label, word) of the phrases and spans (label, first, stop, coverage, labelled) of the templates."""
    bounded_batches(docs.sparkSession)
    scanner = Scanner(templates, phrases)
    shortest = min(scanner.sizes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            w = Words(batch.column("text"))
            number = scanner.numbers(w.hash)
            known = number >= 0
            edge = np.zeros(len(w) + 1, bool)
            edge[w.rows] = True
            first, last = known.copy(), known.copy()
            first[1:] &= ~known[:-1] | edge[1:-1]
            last[:-1] &= ~known[1:] | edge[1:-1]
            starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
            long = stops - starts >= shortest
            starts, stops = starts[long], stops[long]
            row = np.searchsorted(w.rows, starts, "right") - 1
            places: list[list] = [[] for _ in range(batch.num_rows)]
            matches: list[list] = [[] for _ in range(batch.num_rows)]
            for a, b, r, base in zip(starts.tolist(), stops.tolist(), row.tolist(), w.rows[row].tolist(), strict=True):
                scanner.run(number[a:b].tolist(), a - base, places[r], matches[r])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(np.diff(w.rows)),
                    pa.array([[{"label": scanner.labels[k], "word": at} for k, at in p] for p in places], pa.list_(pa.struct({"label": pa.string(), "word": pa.int64()}))),
                    pa.array([scanner.spans(m) for m in matches], pa.list_(pa.struct({"label": pa.string(), "first": pa.int64(), "stop": pa.int64(), "coverage": pa.float64(), "labelled": pa.bool_()}))),
                ],
                ["key", "n_words", "places", "spans"],
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_words long, places array<struct<label: string, word: long>>, spans array<struct<label: string, first: long, stop: long, coverage: double, labelled: boolean>>"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(scan, schema).withColumnRenamed("key", key)


def license_labels(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words, no labels and score 0. score is 1 where a phrase stands, else the
    largest share of a template that a chain covers. Repeated rows are scanned one by one, an empty table
    gives an empty result, and other columns are not read.
    """
    found = license_spans(docs, key, text)
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    long = F.filter("spans", lambda s: s["labelled"])
    best = F.coalesce(F.array_max(F.col("spans.coverage")), F.lit(0.0))
    return found.select(
        key,
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.col("places.word")).alias("first_word"),
        F.array_max(F.col("places.word")).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(F.col("places.label"), F.transform(long, lambda s: s["label"]))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.least(F.lit(1.0), best)).alias("score"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(read_table(spark, sf_dir, "documents"))
