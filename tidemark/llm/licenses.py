"""Licence scans with a generalised suffix automaton of licence texts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ALNUM, texts

# Phrases that always label, by the contract.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of well-known public licences and notices, by the label that a long enough match of it gives.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            "Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
            "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may "
               "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
               "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
               "implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
            "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
            "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
            "PURPOSE. See the GNU General Public License for more details."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
            "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
            "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, "
                  "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
                  "any means."),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising "
             "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
             "alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not "
             "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
             "appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
             "software. This notice may not be removed or altered from any source distribution."),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
              "covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative "
              "works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright "
              "notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be "
              "included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works "
              "are solely in the form of machine-executable object code generated by a source language processor."),
    ("cc", "Licensed under CC BY 4.0."),
    ("cc", "Licensed under CC BY-NC 4.0."),
    ("cc", "Licensed under CC BY-SA 4.0."),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means "
                    "without the prior written permission of the publisher."),
]
MATCH = 3  # words from which a match counts as long
COVER = 0.6  # share of a template that a chain must cover to give its label
SHORT = 16  # words below which a chain must cover the licence's name (and version) in the template as well
NAMES = {"gpl": [{b"gnu"}], "cc": [{b"cc", b"creative"}, {b"4"}]}  # a word of each set names the licence of a short template
GAP = 8  # words of a document that may lie between chained matches


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM).split()


class SuffixAutomaton:
    """Automaton of all word sequences inside the templates, built over them one after another.

    ``end`` of a state is a template and the place after the last word of one occurrence there.
    """

    def __init__(self, templates: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [[]]
        for t, words in enumerate(templates):
            last = 0
            for i, w in enumerate(words):
                last = self._extend(last, w)
                self.ends[last].append((t, i + 1))
        # Places pass to the shorter sequences that end there as well.
        for s in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.ends[self.link[s]].extend(self.ends[s])
        self.ends = [sorted(set(e)) for e in self.ends]

    def _state(self, length: int, nexts: dict[bytes, int], link: int) -> int:
        self.next.append(nexts)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.length) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def matches(self, words: list[bytes], least: int):
        """Maximal matches of ``least`` words or more, as ``(stop, length, state)``: where the next word ends the longest match."""
        state, n, nexts = 0, 0, self.next
        root = nexts[0]
        for i, w in enumerate(words):
            if not n and w not in root:  # most words of most texts
                continue
            if w in nexts[state]:
                state, n = nexts[state][w], n + 1
                continue
            if n >= least:
                yield i, n, state
            while state and w not in nexts[state]:
                state = self.link[state]
                n = self.length[state]
            if w in nexts[state]:
                state, n = nexts[state][w], n + 1
            else:
                n = 0
        if n >= least:
            yield len(words), n, state


class Scanner:
    """Phrases and templates made ready; sent to the tasks once (its size is that of the licence texts)."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.words = [words_of(t.encode()) for _, t in templates]
        self.labels = [label for label, _ in templates]
        self.named = [[{i for i, x in enumerate(w) if x in names} for names in NAMES.get(label, ())] if len(w) < SHORT else [] for label, w in zip(self.labels, self.words)]
        self.automaton = SuffixAutomaton(self.words)
        self.phrases = [(words_of(p.encode()), label) for p, label in phrases.items()]
        self.keys = {p[-1] for p, _ in self.phrases}

    def base(self, words: list[bytes]) -> list[tuple[int, str]]:
        places = []
        if not self.keys.isdisjoint(words):
            for p, label in self.phrases:
                at = -1
                while True:
                    try:
                        at = words.index(p[0], at + 1)
                    except ValueError:
                        break
                    if words[at : at + len(p)] == p:
                        places.append((at, label))
        return sorted(places)

    def chains(self, words: list[bytes]) -> list[tuple[int, int, str, float]]:
        """Covered template spans ``(start, stop, label, covered share)`` of the document.

        Matches of one template that follow each other in the document and in the template, at most ``GAP`` words
        apart, form a chain; its share is the template's words that it covers. Of several places of a match the first behind
        the chain counts. Short templates share their beginning with common prose, so a chain of one counts only with the
        licence's name, and its version where it has one.
        """
        open_: dict[int, tuple] = {}  # template -> start, stop in the document, stop in the template, covered words, its names that are covered
        done = []

        def close(t):
            a, z, _, covered, names = open_.pop(t)
            if len(names) == len(self.named[t]):
                done.append((a, z, self.labels[t], min(1.0, covered / len(self.words[t]))))

        for stop, n, state in self.automaton.matches(words, MATCH):
            start = stop - n
            places: dict[int, list[int]] = {}
            for t, end in self.automaton.ends[state]:
                places.setdefault(t, []).append(end)
            for t, ends in places.items():
                c = open_.get(t)
                later = [e for e in ends if e > c[2]] if c and start - c[1] <= GAP else []
                if c and not later:
                    close(t)
                # The first place that lies wholly behind the chain, else the one that adds most to it.
                end = next((e for e in later if e - n >= c[2]), later[-1]) if later else ends[0]
                names = {i for i, places_of in enumerate(self.named[t]) if any(end - n <= x < end for x in places_of)}
                open_[t] = (c[0], stop, end, c[3] + min(n, end - c[2]), c[4] | names) if later else (start, stop, end, n, names)
        for t in list(open_):
            close(t)
        return sorted(done)


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, cover: float = COVER) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans)`` per row of ``docs``.

    Words are runs of ASCII letters and digits and any other non-ASCII characters, lower-cased in A-Z. ``n_base``
    counts the places where a phrase's words stand one after another, ``first_word`` and ``last_word`` are the least
    and greatest start of one (null if none). Every text is streamed through a suffix automaton of all templates,
    which gives at each word the longest sequence that ends there and occurs in some template; maximal matches of
    ``MATCH`` words or more are chained per template. A chain that covers ``cover`` of its template adds the
    template's label; base labels stay. A chain of a template below ``SHORT`` words counts only with the words of
    ``NAMES`` in it. ``score`` is 1 with a base place, else the largest covered share of any template. ``spans`` lists the chains
    that give a label. Label lists are distinct, sorted and comma-joined, empty if there is none.

    A null or empty text has no words, no label and score 0. Rows are judged one by one, so repeated rows agree;
    other columns are not read; an empty table gives no rows.
    """
    schema = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
              "spans array<struct<start:int,stop:int,label:string,share:double>>")
    shared = docs.sparkSession.sparkContext.broadcast(Scanner(templates, phrases))
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("label", pa.string()), ("share", pa.float64())])

    def run(parts):
        scanner = shared.value
        for b in parts:
            out = []
            for t in texts(b):
                words = words_of(t)
                places = scanner.base(words)
                chains = scanner.chains(words)
                long = [c for c in chains if c[3] >= cover]
                base = {label for _, label in places}
                out.append((
                    len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(base)),
                    ",".join(sorted(base | {c[2] for c in long})), 1.0 if places else max((c[3] for c in chains), default=0.0),
                    [{"start": a, "stop": z, "label": label, "share": s} for a, z, label, s in long],
                ))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
