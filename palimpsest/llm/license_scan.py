"""License scans with a generalised suffix automaton.

The automaton holds the tokens of all license templates. A file's tokens are
streamed through it, which gives at each place the length of the longest run that
ends there and stands in some template (matching statistics). Runs that can't
grow and are long enough are placed in their templates and chained in order, the best
chain to each being found exactly; a chain that covers enough of a template is a span of that license.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices that the licenses themselves ask for, by label.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "The Software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the Software or the use or other dealings in the Software."),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
]

#: Bytes of words, lower-cased; all others part words.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32) for b in range(256))
#: Tokens that a match must have, words that a chain may jump, and share of a template that makes its label.
MIN_MATCH, MAX_GAP, MIN_COVER = 4, 12, 0.6
SPANS = "doc_id long, n_words long, spans array<struct<label:string,start:long,stop:long,cover:double,phrase:boolean>>"


def words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton over template tokens; a state knows one place where its runs end."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.labels = [label for label, _ in templates] + list(phrases.values())
        self.bodies = [words(text) for _, text in templates] + [words(p) for p in phrases]
        self.first_phrase = len(templates)
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len, self.ends = [-1], [0], [[]]
        for k, body in enumerate(self.bodies):
            last = 0
            for at, word in enumerate(body):
                last = self._extend(last, self.ids.setdefault(word, len(self.ids)))
                self.ends[last].append((k, at + 1))
        # places of a state: its own and those of the states whose suffix it is
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.link[v] > 0:
                self.ends[self.link[v]] += self.ends[v]
        self.ends = [sorted(set(e)) for e in self.ends]
        self.tokens = [tuple(self.ids[w] for w in body) for body in self.bodies]
        self.phrase_of_last: dict[int, list[tuple[tuple, str]]] = {}
        for t, label in zip(self.tokens[self.first_phrase :], self.labels[self.first_phrase :], strict=True):
            self.phrase_of_last.setdefault(t[-1], []).append((t, label))

    def _state(self, length: int, nxt: dict, link: int) -> int:
        self.next.append(nxt), self.link.append(link), self.len.append(length), self.ends.append([])
        return len(self.len) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """The state of the runs of q that p's runs followed by c make."""
        if self.len[q] == self.len[p] + 1:
            return q
        clone = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, self.next[last][c], c)
        new, p = self._state(self.len[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][c], c)
        return new

    def statistics(self, tokens: list[int]):
        """(length, state) at each place of the stream."""
        state, length = 0, 0
        for c in tokens:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.len[state]
            if c in self.next[state]:
                state, length = self.next[state][c], length + 1
            yield length, state

    def scan(self, text: str) -> tuple[int, list[tuple[str, int, int, float, bool]]]:
        """Number of words; spans (label, start, stop, cover, is_phrase) in words."""
        all_words = words(text)
        get = self.ids.get
        ids = np.fromiter((get(w, -1) for w in all_words), np.int32, len(all_words))
        edge = np.flatnonzero(np.diff(np.r_[False, ids >= 0, False].astype(np.int8)))
        spans: list[tuple[str, int, int, float, bool]] = []
        matches: list[tuple[int, int, int, int]] = []
        for a, z in edge.reshape(-1, 2):
            if z - a < 2:
                continue
            run = ids[a:z].tolist()
            stats = list(self.statistics(run))
            for i, (length, state) in enumerate(stats):
                for phrase, label in self.phrase_of_last.get(run[i], ()):
                    n = len(phrase)
                    if length >= n and tuple(run[i + 1 - n : i + 1]) == phrase:
                        spans.append((label, int(a) + i + 1 - n, int(a) + i + 1, 1.0, True))
                if length >= MIN_MATCH and (i + 1 == len(stats) or stats[i + 1][0] <= length):
                    for k, end in self.ends[state]:
                        if k < self.first_phrase and end >= length:
                            matches.append((k, int(a) + i + 1 - length, end - length, length))
        return len(all_words), spans + self._chains(matches)

    def _chains(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float, bool]]:
        """The best chains of each template whose cover is enough, those with the largest cover first where they overlap in the file."""
        found = []
        of: dict[int, list[tuple[int, int, int]]] = {}
        for k, at, place, n in sorted(set(matches)):
            of.setdefault(k, []).append((at, place, n))
        for k, mine in of.items():
            least = MIN_COVER * len(self.bodies[k])
            if sum(n for _, _, n in mine) < least:
                continue
            taken: list[tuple[int, int]] = []
            for covered, start, stop in sorted(best_chains(mine), key=lambda c: (-c[0], c[1], c[2])):
                if covered < least:
                    break
                if not any(start < z and a < stop for a, z in taken):
                    taken.append((start, stop))
                    found.append((self.labels[k], start, stop, covered / len(self.bodies[k]), False))
        return sorted(found, key=lambda f: (f[1], f[2], f[0]))


def best_chains(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(covered, start, stop) of the best chain that ends in each match (at, place, n), given in order of their places in the file.

    A match goes on from one before it whose end in the file is at most MAX_GAP words
    back and whose ends, in file and template, it passes; what it shares with that one
    is cut from its front. Matches further back can't be reached again and are passed over.
    """
    out: list[tuple[int, int, int]] = []
    reach = 0  # matches before it end too far back
    ends = [at + n for at, _, n in matches]
    last = list(accumulate(ends, max))
    for i, (at, place, n) in enumerate(matches):
        while reach < i and last[reach] < at - MAX_GAP:
            reach += 1
        best = (n, at)
        for j in range(reach, i):
            a, p, m = matches[j]
            if ends[j] >= at - MAX_GAP and at >= a:
                rest = n - max(0, ends[j] - at, p + m - place)
                if rest > 0:
                    best = max(best, (out[j][0] + rest, out[j][1]), key=lambda b: (b[0], -b[1]))
        out.append((*best, at + n))
    return out


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_words and the spans of licenses of every row.

    Whole texts are streamed, one document at a time. A null or empty text has no
    words and no spans; repeated rows answer each for itself; extra columns are
    ignored. ``phrase`` spans are the places where a phrase's words stand
    consecutively, overlapping ones included.
    """

    def run(batches):
        auto = Automaton(templates, phrases)
        names = ["label", "start", "stop", "cover", "phrase"]
        kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("cover", pa.float64()), ("phrase", pa.bool_())]))
        for batch in batches:
            n, spans = [], []
            for t in batch["t"]:
                count, found = auto.scan(t.as_py() or "")
                n.append(count)
                spans.append([dict(zip(names, s, strict=True)) for s in found])
            yield pa.RecordBatch.from_arrays([batch["k"], pa.array(n, pa.int64()), pa.array(spans, kind)], names=["doc_id", "n_words", "spans"])

    return docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, SPANS)


def summary(scanned: DataFrame) -> DataFrame:
    """The digest of a scan: base places, labels and score. The score is the largest covered share of a phrase or template."""
    base = F.filter("spans", lambda s: s["phrase"])
    starts = F.transform(base, lambda s: s["start"])
    join = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        join(base).alias("base_labels"),
        join(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0)).alias("score"),
    )
