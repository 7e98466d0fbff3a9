"""Operator 3: license scan with a generalised suffix automaton.

Templates (license sentences and notices, as words) are compiled into one suffix automaton on the driver; it
has at most two states per template word, a size fixed by the templates. Tasks stream the words of every
text through it. After each word the automaton holds the longest suffix of the text that occurs in some
template (the matching statistics). Where a match can grow no more and is long enough, it is placed in
every template that contains it; placements that go on in order, with gaps of at most ``MAX_GAP`` words, are
chained, and a chain that covers ``COVER`` of its template reports the template's label and text span.

Base phrases are templates too: a phrase ends wherever the current match is at least as long as the phrase
and has it as a suffix, so every place counts, overlapping ones included.

Words are maximal runs of a-z, 0-9 and characters beyond ASCII, after lower-casing A-Z only. The score is
the largest share of a template that one chain covers (1 when a base phrase stands in the text).

Defined results: NULL, empty and wordless texts have no words, counts of 0, NULL first and last word, empty
labels and score 0; each row is scanned on its own, so repeated rows and NULL ids keep theirs; an empty
table gives no rows; other columns are ignored. A text is one pass with memory for its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from lakeload.llm.common import long_id, read_table, words_of

# Base phrases and labels of the contract.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Opening sentences of public licenses and common notices, with the label of each.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
                 "with the license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("bsd", "released under the bsd license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("gpl", "licensed under the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "cc0 1 0 universal public domain dedication"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
]
MIN_MATCH = 3
MAX_GAP = 8
COVER = 0.8


class TemplateAutomaton:
    """Generalised suffix automaton of word sequences, with the places and base phrases of each state."""

    def __init__(self, templates=TEMPLATES, base=BASE):
        self.phrases = [(label, tuple(words_of(p))) for p, label in base.items()]
        self.templates = [(label, tuple(words_of(t))) for label, t in templates] + self.phrases
        self.next, self.link, self.length, self.ends = [{}], [-1], [0], [set()]
        for t, (_, words) in enumerate(self.templates):
            last = 0
            for i, w in enumerate(words):
                last = self._extend(last, w)
                self.ends[last].add((t, i + 1))
        # an end of a longer string is an end of each of its suffixes
        for v in sorted(range(1, len(self.link)), key=lambda v: -self.length[v]):
            if self.link[v] > 0:
                self.ends[self.link[v]] |= self.ends[v]
        #: per state: the base phrases that its longest string ends with, as (phrase, words)
        self.base = [[] for _ in self.link]
        for v in range(1, len(self.link)):
            t, end = min(self.ends[v])
            longest = self.templates[t][1][end - self.length[v]:end]
            self.base[v] = [(p, len(words)) for p, (_, words) in enumerate(self.phrases) if longest[-len(words):] == words]

    def _state(self, length: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, p: int, q: int, w: bytes) -> int:
        """State of the strings of q no longer than p's plus one; edges into q from p upwards move to it."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.next[last]:
            return self._split(last, self.next[last][w], w)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][w], w)
        return new

    def scan(self, words: list[bytes]):
        """(base places as (phrase, start), maximal matches as (state, start, length))."""
        edges, link, length, base = self.next, self.link, self.length, self.base
        root, state, n, places, matches = edges[0], 0, 0, [], []
        for i, w in enumerate(words):
            if not state and w not in root:
                continue
            if w not in edges[state] and n >= MIN_MATCH:
                matches.append((state, i - n, n))
            while state and w not in edges[state]:
                state = link[state]
                n = length[state]
            state = edges[state].get(w, 0)
            n = n + 1 if state else 0
            for p, size in base[state]:
                if size <= n:
                    places.append((p, i + 1 - size))
        if n >= MIN_MATCH:
            matches.append((state, len(words) - n, n))
        return places, matches

    def chains(self, matches) -> tuple[list[tuple[str, int, int]], float]:
        """Reported (label, first word, end) spans and the best covered share, from matches in text order."""
        open_, spans, best = {}, [], 0.0

        def close(t):
            nonlocal best
            first, end, _, covered = open_.pop(t)
            share = covered / len(self.templates[t][1])
            best = max(best, share)
            if share >= COVER:
                spans.append((self.templates[t][0], first, end))
        for state, start, n in matches:
            for t, end in sorted(self.ends[state]):
                at = end - n
                if t in open_:
                    first, last, used, covered = open_[t]
                    shared = max(0, last - start, used - at)     # words that the chain has already
                    if shared < n and start - last <= MAX_GAP:
                        open_[t] = (first, start + n, end, covered + n - shared)
                        continue
                    if start < last:                             # another reading of the chain's own words
                        continue
                    close(t)
                open_[t] = (start, start + n, end, n)
        for t in list(open_):
            close(t)
        return spans, min(1.0, best)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, base=BASE) -> DataFrame:
    """Per row: word count, base places, labels, template spans (``label:first:end``) and score."""
    held = docs.sparkSession.sparkContext.broadcast(TemplateAutomaton(templates, base))  # size fixed by the templates

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = held.value
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                words = words_of(text)
                places, matches = a.scan(words)
                spans, score = a.chains(matches)
                starts = [s for _, s in places]
                base_labels = {a.phrases[p][0] for p, _ in places}
                out.append((len(words), len(places), min(starts, default=None), max(starts, default=None),
                            ",".join(sorted(base_labels)), ",".join(sorted(base_labels | {s[0] for s in spans})),
                            1.0 if places else score, ",".join(f"{x}:{s}:{e}" for x, s, e in sorted(spans, key=lambda s: (s[1], s[2], s[0])))))
            got = pd.DataFrame(out, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
            got.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None))
            for c in ("doc_id", "first_word", "last_word"):
                got[c] = got[c].astype("Int64")
            yield got
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
    return docs.select(long_id().alias("doc_id"), "text").mapInPandas(run, schema)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))
