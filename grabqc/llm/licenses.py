"""License scans: matching statistics from a suffix automaton of licence words.

The automaton knows every run of words of every template, and all its places. A text's words are
streamed through it; at each word it knows the longest run that ends there and occurs in a template, and by
its suffix links the longest that ends there for each place of each other template. Runs
of at least ``min_run`` words that go no further are chained, for each template, in the order of the text and of
the template; a template of which a chain covers ``min_cover`` of the words gives its label.

Before streaming, neighbouring words that are neighbours in no template are found at once; no
match of two words or more crosses them, so this loses nothing.

Nulls: a null text is empty: no words, no labels, score 0. Texts of any length are read whole.
A null id stays null; repeated rows are scanned each; an empty table gives an empty result.
"""

import heapq

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grabqc.llm.common import map_batches, utf8

# Phrases whose places are counted, with their labels. Fixed values.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

# Opening words of well-known public licences.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. "
               "You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("mit", "Released under the MIT License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

# Bytes of words: a-z, 0-9 and all beyond ASCII; A-Z become a-z, the rest separates.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text):
    return utf8(text).translate(WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton of lists of words."""

    def __init__(self, texts):
        self.next, self.link, self.length, self.ends = [{}], [-1], [0], [set()]
        for t, words in enumerate(texts):
            last = 0
            for i, word in enumerate(words):
                last = self._extend(last, word)
                self.ends[last].add((t, i + 1))
        # a state's own places; those of the longer runs below it are its places too
        for state in sorted(range(1, len(self.link)), key=lambda v: -self.length[v]):
            self.ends[self.link[state]] |= self.ends[state]

    def _state(self, following, link, length):
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, state, word):
        """The state after ``word`` whose longest run is one longer than that of ``state``."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(dict(self.next[target]), self.link[target], self.length[state] + 1)
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last, word):
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state({}, 0, self.length[last] + 1)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def statistics(self, words):
        """(state, length) after each word: the longest run ending there that a text holds."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield state, length

    def above(self, state):
        while state > 0:
            yield state
            state = self.link[state]


def chain(matches):
    """Best chain of (text start, template start, length): total length, first start, last end.

    Matches of a chain follow each other in the text and in the template. ``ended`` holds, for
    each place in the template, the best chain that ends there before the match at hand.
    """
    ended, open_chains, best = {}, [], (0, 0, 0)
    for start, at, n in sorted(matches):
        while open_chains and open_chains[0][0] <= start:
            end, place, total, first = heapq.heappop(open_chains)
            if total > ended.get(place, (0, 0))[0]:
                ended[place] = total, first
        total, first = max(((total + n, first) for place, (total, first) in ended.items() if place <= at),
                           key=lambda c: c[0], default=(n, start))
        heapq.heappush(open_chains, (start + n, at + n, total, first))
        if total > best[0]:
            best = total, first, start + n
    return best


class Scanner:
    def __init__(self, templates, phrases, min_run, min_cover):
        texts = [words_of(t) for _, t in templates] + [words_of(p) for p, _ in phrases]
        self.labels = [label for label, _ in templates] + [label for _, label in phrases]
        self.texts, self.templates = texts, len(templates)
        self.min_run, self.min_cover = min_run, min_cover
        self.shortest = min(map(len, texts[:self.templates]), default=min_run)
        self.automaton = Automaton(texts)
        self.phrase_at = {}
        for t in range(self.templates, len(texts)):
            *_, (state, _) = self.automaton.statistics(texts[t])
            self.phrase_at.setdefault(state, []).append((len(texts[t]), self.labels[t]))
        self.ids = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        size = len(self.ids) + 1
        self.pairs = np.zeros(size * size, bool)
        for t in texts:
            for a, b in zip(t, t[1:]):
                self.pairs[self.ids[a] * size + self.ids[b]] = True
        self.size = size

    def stretches(self, words):
        """Stretches of words in which all neighbours are neighbours in a template."""
        known = self.ids.get
        ids = np.fromiter([known(w, 0) for w in words], np.int64, len(words))
        together = self.pairs[ids[:-1] * self.size + ids[1:]]
        if not together.any():
            return []
        edges = np.flatnonzero(np.diff(np.concatenate([[False], together, [False]])))
        return [(int(a), int(b) + 1) for a, b in edges.reshape(-1, 2)]

    def runs(self, state, length):
        """(template, place after it, words) of the runs that end at a state: the longest that each place of each template holds.

        Along the suffix links runs grow shorter and are held in more places.
        """
        least, met = min(self.min_run, self.shortest), set()
        while state > 0 and length >= least:
            for t, at in self.automaton.ends[state]:
                if (t, at) not in met and t < self.templates:
                    met.add((t, at))
                    if length >= min(self.min_run, len(self.texts[t])):
                        yield t, at, length
            state = self.automaton.link[state]
            length = self.automaton.length[state]

    def scan(self, text):
        words = words_of(text)
        places, base, matches = [], set(), {}
        for begin, end in self.stretches(words) if len(words) > 1 else []:
            states = list(self.automaton.statistics(words[begin:end]))
            for i, (state, length) in enumerate(states):
                for above in self.automaton.above(state):
                    for n, label in self.phrase_at.get(above, ()):
                        if length >= n:
                            places.append(begin + i + 1 - n)
                            base.add(label)
                following = words[begin + i + 1] if i + 1 < len(states) else None
                for t, at, n in self.runs(state, length):
                    # a run that goes on in the template is met again at the next word
                    if at == len(self.texts[t]) or self.texts[t][at] != following:
                        matches.setdefault(t, []).append((begin + i + 1 - n, at - n, n))
        spans, score = [], 1.0 if base else 0.0
        for t, found in sorted(matches.items()):
            total, first, end = chain(found)
            cover = total / len(self.texts[t])
            score = max(score, cover)
            if cover >= self.min_cover:
                spans.append({"label": self.labels[t], "first_word": first, "end_word": end, "cover": cover})
        return len(words), places, base, spans, score


def scan(docs, templates=TEMPLATES, phrases=PHRASES, min_run=4, min_cover=0.6, id_col="doc_id", text_col="text"):
    """Per row: id, number of words, places of phrases, labels, covered template spans, score."""
    def start():
        scanner = Scanner(templates, phrases, min_run, min_cover)

        def step(ids, texts):
            found = [scanner.scan(t) for t in texts]
            return (ids, [f[0] for f in found], [f[1] for f in found], [sorted(f[2]) for f in found],
                    [sorted(f[2] | {s["label"] for s in f[3]}) for f in found], [f[3] for f in found], [f[4] for f in found])

        return step

    span = T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
                         T.StructField("end_word", T.LongType()), T.StructField("cover", T.DoubleType())])
    return map_batches(docs, [id_col, text_col], start, T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("places", T.ArrayType(T.LongType())), T.StructField("base_labels", T.ArrayType(T.StringType())),
        T.StructField("labels", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(span)),
        T.StructField("score", T.DoubleType())]))


def digests(docs, **options):
    return scan(docs, **options).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"), F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")
