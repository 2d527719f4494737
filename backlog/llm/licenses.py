"""Licence notices and mentions in whole texts, by a positional index of templates looked up by their rarest words.

How rare a licence word is, is counted over all documents. For every template, a text's rarest words that the
template holds are looked up; each of their places, less the word's place in the template, says where the template
would begin. Beginnings that enough of the words agree on are candidates; there all mandatory key phrases must
stand, and the share of the template's words (weighted by rarity) found in place is the score. A phrase is a
template without slack: all its words agree on one beginning, or it is not there.

A null text is empty, and has no words and no labels. Texts are searched whole, however long. Repeated rows get a
row each, rows without doc_id too. Words equally rare are looked up in bytewise order. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backlog.llm.common import arrow_map

#: Bytes between words, 0x00-0x2F, 0x3A-0x60 but A-Z, and 0x7B-0x7F, become blanks, A-Z become a-z.
FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() else b | 0x20 if chr(b).isalpha() else 0x20 for b in range(256))

# Phrases and their labels as the contract names them.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Further phrases that name a licence.
PHRASES = {
    "apache license version 2 0": "apache-2.0",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "2 clause bsd license": "bsd-2-clause",
    "bsd 2 clause license": "bsd-2-clause",
    "3 clause bsd license": "bsd-3-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "cc by 4 0": "cc-by-4.0",
    "cc by sa 4 0": "cc-by-sa-4.0",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by nd 4 0": "cc-by-nd-4.0",
    "cc by nc sa 4 0": "cc-by-nc-sa-4.0",
    "cc by nc nd 4 0": "cc-by-nc-nd-4.0",
    "cc0 1 0": "cc0-1.0",
}

# Public licence notices, the phrases of each that must stand, and its label.
NOTICES = [
    (
        "mit-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
        " (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do"
        " so, subject to the following conditions",
        ["hereby granted free of charge", "deal in the software without restriction"],
    ),
    (
        "apache-2.0-notice",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under"
        " the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        ["except in compliance with the license", "warranties or conditions of any kind"],
    ),
    (
        "gpl-notice",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software"
        " Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it"
        " will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
        ["under the terms of the gnu general public license", "published by the free software foundation"],
    ),
    (
        "bsd-notice",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer",
        ["redistribution and use in source and binary forms", "retain the above copyright notice"],
    ),
    (
        "isc-notice",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided"
        " that the above copyright notice and this permission notice appear in all copies",
        ["permission to use copy modify", "with or without fee is hereby granted"],
    ),
    (
        "mpl-2.0-notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with"
        " this file, You can obtain one at https://mozilla.org/MPL/2.0/",
        ["source code form is subject to the terms", "mozilla public license"],
    ),
    (
        "unlicense-notice",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,"
        " sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or"
        " non-commercial, and by any means",
        ["free and unencumbered software", "into the public domain"],
    ),
]


@dataclass(frozen=True)
class Settings:
    """Words looked up per notice, and how many of them must agree; by how many words places may be shifted
    against a notice; least score of a notice."""

    looked_up: int = 8
    agree: int = 4
    slack: int = 12
    least_score: float = 0.6


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits and letters, A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


@dataclass(frozen=True)
class Template:
    """A notice or a phrase; `keys` are its mandatory phrases with their places, `base` a phrase of the contract."""

    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[int, tuple[bytes, ...]], ...]
    slack: int
    base: bool = False
    required: frozenset = field(default=frozenset())


def templates(settings: Settings = Settings()) -> list[Template]:
    out = []
    for phrases, base in ((BASE, True), (PHRASES, False)):
        for phrase, label in phrases.items():
            words = tuple(words_of(phrase))
            out.append(Template(label, words, ((0, words),), 0, base, frozenset(words)))
    for label, notice, phrases in NOTICES:
        words, keys = tuple(words_of(notice)), []
        for phrase in phrases:
            key = tuple(words_of(phrase))
            at = next(k for k in range(len(words)) if words[k:k + len(key)] == key)
            keys.append((at, key))
        out.append(Template(label, words, tuple(keys), settings.slack, False, frozenset(w for _, key in keys for w in key)))
    return out


def vocabulary(known: list[Template]) -> frozenset[bytes]:
    return frozenset(w for t in known for w in t.words)


def rarity(docs: DataFrame, known: list[Template]) -> dict[bytes, float]:
    """The inverse document frequency of each licence word, over all documents. As many rows as there are such words."""
    wanted = vocabulary(known)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        found, rows = Counter(), 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column(0).to_pylist():
                found.update(wanted.intersection(words_of(text)))
        # No word is empty: its count is that of the documents.
        yield {"word": [*found, b""], "n": [*found.values(), rows]}

    counted = arrow_map(docs.select(F.col("text").cast("string")), run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {bytes(r["word"]): r["n"] for r in counted.collect()}
    total = counts.get(b"", 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) + 1 for w in wanted}


class Index:
    """Template words by rarity, and their places in each template."""

    def __init__(self, idf: dict[bytes, float], settings: Settings = Settings()):
        self.settings = settings
        self.known = templates(settings)
        self.words = vocabulary(self.known)
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for number, template in enumerate(self.known):
            for place, word in enumerate(template.words):
                self.postings.setdefault(word, []).append((number, place))
        self.idf = idf
        self.rarest = [sorted(set(t.words), key=lambda w: (-idf[w], w)) for t in self.known]

    def found(self, words: list[bytes]) -> list[tuple[Template, int, float]]:
        """(template, first word, score) of all places where a template stands."""
        present = self.words.intersection(words)
        chosen, lookups = {}, set()
        for number, template in enumerate(self.known):
            if not template.required <= present:
                continue  # a mandatory phrase can't stand
            most = None if template.slack == 0 else self.settings.looked_up
            chosen[number] = [w for w in self.rarest[number] if w in present][:most]
            lookups.update(chosen[number])
        if not chosen:
            return []
        needed = {w for number in chosen for w in self.known[number].words} & present
        places: dict[bytes, list[int]] = {w: [] for w in needed}
        for k, word in enumerate(words):
            if word in needed:
                places[word].append(k)
        begins: dict[int, list[tuple[bytes, set[int]]]] = {number: [] for number in chosen}
        for word in sorted(lookups, key=lambda w: (-self.idf[w], w)):
            by_template: dict[int, set[int]] = {}
            for number, at in self.postings[word]:
                if number not in chosen or word not in chosen[number]:
                    continue
                here = by_template.get(number)
                starts = {k - at for k in places[word]}
                # A word that a phrase holds twice must stand at both places.
                by_template[number] = starts if here is None else here & starts if self.known[number].slack == 0 else here | starts
            for number, starts in by_template.items():
                begins[number].append((word, starts))
        out = []
        for number, votes in begins.items():
            template = self.known[number]
            if template.slack == 0:
                at = set.intersection(*(starts for _, starts in votes))
                out += [(template, k, 1.0) for k in sorted(at) if tuple(words[k:k + len(template.words)]) == template.words]
            else:
                out += [(template, *hit) for low, high in self._agreed(votes) if (hit := self._verified(template, low, high, words, places))]
        return out

    def _agreed(self, votes: list[tuple[bytes, set[int]]]) -> Iterator[tuple[int, int]]:
        """(low, high) of the stretches of beginnings, within the slack, that enough of the words agree on."""
        points = sorted((start, k) for k, (_, starts) in enumerate(votes) for start in starts)
        need, first, inside = min(self.settings.agree, len(votes)), 0, Counter()
        low = high = None
        for start, k in points:
            inside[k] += 1
            while points[first][0] < start - self.settings.slack:
                gone = points[first][1]
                inside[gone] -= 1
                if not inside[gone]:
                    del inside[gone]
                first += 1
            if len(inside) < need:
                continue
            if low is not None and points[first][0] <= high:
                high = start
                continue
            if low is not None:
                yield low, high
            low, high = points[first][0], start
        if low is not None:
            yield low, high

    def _verified(self, template: Template, low: int, high: int, words: list[bytes], places: dict[bytes, list[int]]) -> tuple[int, float] | None:
        """(first word, score) if all mandatory phrases stand and enough words are in place."""
        slack = template.slack
        for at, key in template.keys:
            known = places[key[0]]
            for k in range(bisect_left(known, low + at - slack), len(known)):
                if known[k] > high + at + slack:
                    return None
                if tuple(words[known[k]:known[k] + len(key)]) == key:
                    break
            else:
                return None
        total = here = 0.0
        first = None
        for at, word in enumerate(template.words):
            known = places.get(word, ())
            k = bisect_left(known, low + at - slack)
            total += self.idf[word]
            if k < len(known) and known[k] <= high + at + slack:
                here += self.idf[word]
                first = known[k] if first is None else min(first, known[k])
        score = here / total
        return (first, score) if score >= self.settings.least_score else None


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places) of every row.

    `places`: label, first word and score of all that was found; `score`: the best of these, else 0.
    """
    idf = rarity(docs, templates(settings))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        index = Index(idf, settings)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                found = index.found(words)
                base = [k for t, k, _ in found if t.base]
                places = sorted({(t.label, k, score) for t, k, score in found}, key=lambda p: (p[1], p[0]))
                rows.append((
                    len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted({t.label for t, _, _ in found if t.base})),
                    ",".join(sorted({t.label for t, _, _ in found})), max((score for _, _, score in found), default=0.0),
                    [dict(zip(("label", "word", "score"), p)) for p in places],
                ))
            if rows:
                names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places")
                yield {"doc_id": batch.column(0)} | dict(zip(names, map(list, zip(*rows))))

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
        " places array<struct<label: string, word: long, score: double>>"
    )
    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema)
