"""Licence texts in documents, by a generalised suffix automaton of the templates' words.

The automaton holds every word sequence that occurs in some template. A document
streams through it: after each word it knows the longest suffix of what was read
that occurs in a template (the matching statistics). Where a match of `MIN_MATCH`
words or more ends, it is located in its templates. Per template, matches in
rising order whose gaps stay below `MAX_GAP` words on both sides are chained to a
span; one that covers `MIN_COVER` of its template (and a whole match at least)
gives the template's label. Of spans that overlap, the one with most covered words stays (then the
larger share of its template, the earlier, the first label), as notices of one family differ in a word or two.

A template is a paragraph, so any whole paragraph of a licence suffices. Held are the whole texts of MIT, ISC, the
BSD licences of two and three clauses; two paragraphs of the Unlicense; the notices of Apache 2.0, GPL, LGPL, AGPL, MPL 2.0 and EPL 2.0; and
lines for Creative Commons. The bodies of the long licences are not.

Words are runs of letters and digits (and all characters beyond ASCII) after A-Z are
lower-cased. NULL counts as empty text, which has no words and no labels.
Documents are independent, so ties and repeated rows need no rule.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.arrow import map_texts

MIN_MATCH, MAX_GAP, MIN_COVER = 4, 8, 0.6

# The phrases and labels of the base scan.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public licence wordings and notices.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
            "of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License "
               "is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
               "implied. See the License for the specific language governing permissions and limitations under the "
               "License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("mit", "and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software"),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
            "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
            "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
            "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
            "THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
            "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
            "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
            "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission"),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
            "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
            "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
            "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
            "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
            "POSSIBILITY OF SUCH DAMAGE"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
                  "compiled binary, for any purpose, commercial or non-commercial, and by any means"),
    ("unlicense", "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any "
                  "and all copyright interest in the software to the public domain. We make this dedication for the "
                  "benefit of the public at large and to the detriment of our heirs and successors. We intend this "
                  "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
                  "this software under copyright law"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
            "for more details"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
             "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
             "License for more details"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation"),
    ("agpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
             "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public "
             "License for more details"),
    ("mpl", "If a copy of the MPL was not distributed with this file, You can obtain one at "
            "https://mozilla.org/MPL/2.0/"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
            "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
)

# Separators become spaces, A-Z become a-z; bytes of characters beyond ASCII stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


class SuffixAutomaton:
    """Of several word sequences; `ends[state]` lists (template, last word's index) of its occurrences."""

    def __init__(self, sequences: list[list[int]]):
        self.step, self.link, self.size, self.ends = [{}], [-1], [0], [[]]
        for number, words in enumerate(sequences):
            last = 0
            for at, w in enumerate(words):
                last = self._extend(last, w)
                self.ends[last].append((number, at))
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]
        self.ends = [sorted(set(e)) for e in self.ends]

    def _new(self, size: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.size.append(size)
        self.link.append(link)
        self.ends.append([])
        return len(self.size) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """A copy of q for the sequences that end p plus w."""
        copy = self._new(self.size[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        q = self.step[last].get(w)
        if q is not None:  # an earlier template holds this sequence
            return q if self.size[q] == self.size[last] + 1 else self._split(last, q, w)
        new = self._new(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, w)
        return new

    def statistics(self, words):
        """After each word: (state, length) of the longest suffix that occurs in a template."""
        state = length = 0
        for w in words:
            while state and w not in self.step[state]:
                state = self.link[state]
                length = self.size[state]
            if w in self.step[state]:
                state = self.step[state][w]
                length += 1
            yield state, length


class LicenceScanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        split = [words_of(t) for _, t in templates]
        self.labels = [label for label, _ in templates]
        self.sizes = [len(s) for s in split]
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        known = sorted({w for s in split for w in s} | {w for p, _ in self.phrases for w in p})
        self.vocabulary = {w: n for n, w in enumerate(known)}
        self.automaton = SuffixAutomaton([[self.vocabulary[w] for w in s] for s in split])
        self.phrase_ids = [([self.vocabulary[w] for w in p], label) for p, label in self.phrases]

    def scan(self, text: str) -> tuple[int, list[tuple], list[tuple]]:
        """(number of words, base places (label, start), spans (label, start, end, covered share))."""
        words = words_of(text)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int32, len(words))
        places = []
        for phrase, label in self.phrase_ids:
            hits = np.flatnonzero(ids[:len(ids) - len(phrase) + 1] == phrase[0]) if len(ids) >= len(phrase) else ()
            places += [(label, int(h)) for h in hits if ids[h:h + len(phrase)].tolist() == phrase]
        return len(words), sorted(places, key=lambda p: (p[1], p[0])), self._spans(ids)

    def _spans(self, ids: np.ndarray) -> list[tuple]:
        inside = np.concatenate(([0], ids >= 0, [0]))
        edges = np.flatnonzero(np.diff(inside))
        matches = []  # (start, end, state)
        for start, end in zip(edges[::2], edges[1::2]):
            if end - start < MIN_MATCH:
                continue
            seen = list(self.automaton.statistics(ids[start:end].tolist()))
            for n, (state, length) in enumerate(seen):
                ends = n + 1 == len(seen) or seen[n + 1][1] <= length
                if ends and length >= MIN_MATCH:
                    matches.append((int(start) + n + 1 - length, int(start) + n + 1, state))
        return self._chain(matches) if matches else []

    def _chain(self, matches: list[tuple]) -> list[tuple]:
        open_chains: dict[int, list] = {}  # template: [start, end, next template word, covered]
        spans = []

        def close(template: int) -> None:
            start, end, _, covered = open_chains.pop(template)
            if covered >= MIN_COVER * self.sizes[template]:
                spans.append((covered, start, self.labels[template], end, covered / self.sizes[template]))

        for start, end, state in sorted(matches):
            places: dict[int, list[int]] = {}
            for template, last in self.automaton.ends[state]:
                places.setdefault(template, []).append(last + 1)
            for template, stops in places.items():
                chain = open_chains.get(template)
                if chain is not None:
                    new = [s for s in stops if 0 < s - chain[2] <= end - start + MAX_GAP]
                    if start - chain[1] <= MAX_GAP and end > chain[1] and new:
                        chain[3] += min(end - max(start, chain[1]), new[0] - chain[2])
                        chain[1], chain[2] = end, new[0]
                        continue
                    if chain[3] >= end - start and start < chain[1]:
                        continue  # part of what is chained already
                    close(template)
                open_chains[template] = [start, end, stops[0], end - start]
        for template in list(open_chains):
            close(template)
        return _apart(spans)


def _apart(spans: list[tuple]) -> list[tuple]:
    """Of (covered words, start, label, end, share), the strongest that do not overlap: (label, start, end, share) in order."""
    starts, kept = [], []
    for _, start, label, end, share in sorted(spans, key=lambda s: (-s[0], -s[4], *s[1:4])):
        at = bisect_left(starts, start)
        if (at == 0 or kept[at - 1][2] <= start) and (at == len(kept) or kept[at][1] >= end):
            starts.insert(at, start)
            kept.insert(at, (label, start, end, share))
    return kept


def scan(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: (id, n_words, places, spans).

    `places` are the base phrases (label, start), `spans` the chained matches
    (label, start, end, covered), all in words from 0.
    """
    def start():
        scanner = LicenceScanner(templates)

        def work(texts: list[str]) -> list[list]:
            found = [scanner.scan(t) for t in texts]
            return [[f[0] for f in found], [[dict(zip(("label", "start"), p)) for p in f[1]] for f in found],
                    [[dict(zip(("label", "start", "end", "covered"), s)) for s in f[2]] for f in found]]

        return work

    place = pa.struct([("label", pa.string()), ("start", pa.int64())])
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())])
    made = {"n_words": (pa.int64(), "long"),
            "places": (pa.list_(place), "array<struct<label:string,start:long>>"),
            "spans": (pa.list_(span), "array<struct<label:string,start:long,end:long,covered:double>>")}
    return map_texts(docs, text_col, {id_col: id_col}, made, start)
