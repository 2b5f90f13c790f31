"""Licence scan: matching statistics of texts against licence templates, chained into spans.

A suffix automaton of the templates' words gives, at each word of a text, the longest run that
ends there and stands in some template. Runs of at least SEED words that can't be extended are
seeds, one for each place that the run has in a template. Seeds of one template that follow each
other in text and template, with at most GAP words between, are chained; a chain's coverage is the
share of the template's words that its seeds hold. Chains that cover COVERED of their template, or
hold LONG words, are spans, best first and without overlap within a template, so a text may hold a
template several times; their templates label the text.

Words are as in the query's contract: runs of ASCII letters and digits and of everything beyond
ASCII, A-Z lower-cased. A null or empty text has no words, counts and labels. Extra columns are
ignored, repeated rows give a row each.
"""

import bisect
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm.bytes_text import ALNUM, find_words, text_slices, word_hashes
from touchline.llm.suffix_automaton import SuffixAutomaton, Vocabulary

#: Base phrases and the licences they name.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Opening or operative passages of public licences.
TEMPLATES = {
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache-text": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-notice": "Licensed under the GNU General Public License, version 3.",
    "mit-notice": "Released under the MIT License.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-notice": "All rights reserved.",
}

SEED = 3
GAP = 8
COVERED = 0.7
LONG = 30

OUTPUT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<template: string, first: long, last: long, coverage: double>>"


def _words_of(text: str) -> np.ndarray:
    batch = pa.RecordBatch.from_arrays([pa.array([text])], ["text"])
    _, buf, offsets = next(text_slices([batch]))
    return word_hashes(find_words(buf, offsets, ALNUM))


class Scanner:
    """Automaton, vocabulary and phrases; made once per worker."""

    def __init__(self, templates: dict[str, str], base: dict[str, str], seed: int, gap: int):
        self.names, self.seed, self.gap = list(templates), seed, gap
        sequences = [_words_of(t) for t in templates.values()]
        self.vocabulary = Vocabulary(sequences)
        self.automaton = SuffixAutomaton([s.tolist() for s in self.vocabulary.numbered])
        self.ends = self.automaton.ends()
        self.sizes = [len(s) for s in sequences]
        self.phrases = [(_words_of(p), label) for p, label in base.items()]

    def base(self, words, hashes: np.ndarray) -> dict[int, list[tuple[int, str]]]:
        """By text: where a base phrase starts, and its label."""
        found = defaultdict(list)
        for phrase, label in self.phrases:
            n = len(phrase)
            at = np.flatnonzero(hashes[: max(0, len(hashes) - n + 1)] == phrase[0])
            for k in range(1, n):
                at = at[hashes[at + k] == phrase[k]]
            text = np.searchsorted(words.first, at, "right") - 1
            inside = at + n <= words.first[text + 1]
            for i, start in zip(text[inside].tolist(), (at - words.first[text])[inside].tolist(), strict=True):
                found[i].append((start, label))
        return found

    def spans(self, words, hashes: np.ndarray, covered: float, long: int) -> dict[int, list[tuple[str, int, int, float]]]:
        """By text: the chains that are spans, as template, first and last word, coverage."""
        seeds, numbers = defaultdict(list), self.vocabulary.numbers(hashes)
        for a, b in self.vocabulary.stretches(numbers, words.first, self.seed):
            text = int(np.searchsorted(words.first, a, "right")) - 1
            at = a - int(words.first[text])
            before = None
            for i, (state, n) in enumerate([*self.automaton.stream(numbers[a:b].tolist()), (0, 0)]):
                if before and before[1] >= self.seed and n <= before[1]:
                    for template, ends in self.ends[before[0]].items():
                        for end in ends:
                            seeds[text, template].append((at + i - before[1], end - before[1] + 1, before[1]))
                before = (state, n)
        out = defaultdict(list)
        for (text, template), found in seeds.items():
            size = self.sizes[template]
            for first, last, held in chains(found, self.gap, min(covered * size, long)):
                out[text].append((self.names[template], first, last, min(1.0, held / size)))
        return out


def chains(seeds: list[tuple[int, int, int]], gap: int, least: float) -> list[tuple[int, int, int]]:
    """First and last word and words held of chains that hold `least` words, best first, none of
    which overlap. seeds: place in the text, place in the template, words."""
    seeds = sorted(seeds)
    longest = max(n for _, _, n in seeds)
    best: list[tuple[int, int]] = []  # words held, first word
    for i, (at, place, n) in enumerate(seeds):
        held, first = n, at
        j = i - 1
        while j >= 0 and at - seeds[j][0] <= longest + gap:
            at2, place2, n2 = seeds[j]
            new = n - max(0, at2 + n2 - at, place2 + n2 - place)
            if at - (at2 + n2) <= gap and abs(place - (place2 + n2)) <= gap and place > place2 and new > 0 and best[j][0] + new > held:
                held, first = best[j][0] + new, best[j][1]
            j -= 1
        best.append((held, first))
    taken: list[tuple[int, int]] = []  # in order, apart from each other
    out = []
    for i in sorted(range(len(seeds)), key=lambda k: (-best[k][0], k)):
        held, first = best[i]
        if held < least:
            break
        last = seeds[i][0] + seeds[i][2] - 1
        k = bisect.bisect_right(taken, (first, last))
        if (k == 0 or taken[k - 1][1] < first) and (k == len(taken) or taken[k][0] > last):
            taken.insert(k, (first, last))
            out.append((first, last, held))
    return out


def scan_licenses(documents: DataFrame, templates: dict[str, str] = TEMPLATES, base: dict[str, str] = BASE, seed: int = SEED, gap: int = GAP, covered: float = COVERED, long: int = LONG) -> DataFrame:
    """One row per document: base phrases, all labels, a score, and the spans of templates.

    score is the best coverage, and at least 0.5 where a base phrase stands.
    """

    def run(batches):
        scanner = Scanner(templates, base, seed, gap)
        for rows, buf, offsets in text_slices(batches):
            words = find_words(buf, offsets, ALNUM)
            hashes = word_hashes(words)
            base_found, span_found = scanner.base(words, hashes), scanner.spans(words, hashes, covered, long)
            cells = []
            for i in range(rows.num_rows):
                phrases = base_found.get(i, [])
                kept = sorted(span_found.get(i, []))
                own = sorted({label for _, label in phrases})
                cells.append(
                    (
                        len(phrases),
                        min((at for at, _ in phrases), default=None),
                        max((at for at, _ in phrases), default=None),
                        ",".join(own),
                        ",".join(sorted({*own, *(s[0] for s in kept)})),
                        max([0.5 if phrases else 0.0, *(s[3] for s in kept)]),
                        [dict(zip(("template", "first", "last", "coverage"), s, strict=True)) for s in kept],
                    )
                )
            span = pa.struct([("template", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())])
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span)]
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"].cast(pa.int64()), pa.array(words.counts, pa.int64()), *(pa.array(c, k) for c, k in zip(zip(*cells, strict=True), kinds, strict=True))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, OUTPUT)
