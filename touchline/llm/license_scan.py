"""License notices: exact phrases, and an exact set-similarity join of text blocks with notice templates.

A block is a line, or a run of words, wherever its lines break, that is longer than the template by no more than the words which the
threshold forgives. It meets a template if it holds at least THRESHOLD of the template's distinct words. The words of all templates are
ordered by the number of lines of the whole corpus that hold them, rarest first. A block that meets a template must hold one of the
template's first words in that order (prefix filter), must have enough distinct words of the vocabulary (length filter), and from the
first shared word on both must have enough words left (positional filter); what passes is counted out.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import arrow_rows, in_tasks, two_columns

THRESHOLD = 0.9

# The phrases and labels to find.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Customary first sentences of notices, and their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

# Bytes to bytes: A-Z in lower case, every other ASCII sign that is neither letter nor digit to a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters and signs beyond ASCII, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def phrase_places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Numbers of the words at which the phrase starts."""
    joined, wanted = b" " + b" ".join(words) + b" ", b" " + b" ".join(phrase) + b" "
    out, at, counted, number = [], joined.find(wanted), 0, -1
    while at >= 0:
        number += joined.count(b" ", counted, at + 1)
        out.append(number)
        counted, at = at + 1, joined.find(wanted, at + 1)
    return out


class TemplateIndex:
    """Templates with their words in the global order; the index holds each template under the words of its prefix only."""

    def __init__(self, templates, frequency: dict[bytes, int], threshold: float = THRESHOLD):
        every = {w for _, text in templates for w in words_of(text)}
        self.rank = {w: i for i, w in enumerate(sorted(every, key=lambda w: (frequency.get(w, 0), w)))}
        self.templates, self.prefix, self.spans = [], {}, []
        for label, text in templates:
            order = sorted(set(words_of(text)), key=self.rank.__getitem__)
            if not order:
                continue
            need = math.ceil(threshold * len(order) - 1e-9)
            for i, word in enumerate(order[: len(order) - need + 1]):
                self.prefix.setdefault(word, []).append((len(self.templates), i))
            self.templates.append((label, order, frozenset(order), need))
            self.spans.append(math.ceil(len(words_of(text)) / threshold - 1e-9))

    def matches(self, words: set[bytes]) -> list[tuple[str, float]]:
        """Label and containment of every template that the block meets."""
        return [(self.templates[t][0], c) for t, c in self._met(words)]

    def _met(self, words: set[bytes]) -> list[tuple[int, float]]:
        entries = self.prefix.keys() & words
        if not entries:
            return []
        block = sorted(self.rank.keys() & words, key=self.rank.__getitem__)
        place, seen, out = {w: j for j, w in enumerate(block)}, set(), []
        for word in sorted(entries, key=self.rank.__getitem__):
            for template, i in self.prefix[word]:
                _, order, whole, need = self.templates[template]
                if template in seen or len(block) < need:
                    continue
                seen.add(template)  # words come in the global order, so this is the first shared one
                if 1 + min(len(order) - i - 1, len(block) - place[word] - 1) < need:
                    continue
                if (shared := len(whole & words)) >= need:
                    out.append((template, shared / len(order)))
        return out

    def _runs(self, words: list[bytes], template: int) -> list[tuple[int, int, float]]:
        """First word, last word and containment of runs that meet the template; of runs that overlap the fullest, then the first, is given."""
        _, order, whole, need = self.templates[template]
        inside, first, met = Counter(), 0, []
        places = [i for i, w in enumerate(words) if w in whole]
        for place in places:
            inside[words[place]] += 1
            # what is out of reach goes, and so does a first word that stands again further on
            while place - places[first] >= self.spans[template] or inside[words[places[first]]] > 1:
                inside[words[places[first]]] -= 1
                if not inside[words[places[first]]]:
                    del inside[words[places[first]]]
                first += 1
            if len(inside) >= need:
                met.append((places[first], place, len(inside) / len(order)))
        taken: list[tuple[int, int, float]] = []
        for run in sorted(met, key=lambda r: (-r[2], r)):
            at = bisect_right(taken, run)
            if (not at or taken[at - 1][1] < run[0]) and (at == len(taken) or run[1] < taken[at][0]):
                taken.insert(at, run)
        return taken

    def blocks(self, text: str) -> list[tuple[int, str, float]]:
        """Line number, label and containment of every line that meets a template, and of every run over a line break that meets it more
        fully than each line it touches; its number is that of its first line."""
        lines = [words_of(line) for line in text.split("\n")]
        words = [w for line in lines for w in line]
        there = set(words)
        if self.prefix.keys().isdisjoint(there):
            return []
        by_line = [dict(self._met(set(line))) for line in lines]
        out = [(n, t, c) for n, met in enumerate(by_line) for t, c in met.items()]
        start = list(accumulate(map(len, lines), initial=0))
        for t, _ in self._met(there) if len(lines) > 1 else ():
            for a, b, c in self._runs(words, t):
                i, j = bisect_right(start, a) - 1, bisect_right(start, b) - 1
                if i < j and all(met.get(t, 0) < c for met in by_line[i : j + 1]):
                    out.append((i, t, c))
        return [(n, self.templates[t][0], c) for n, t, c in sorted(out, key=lambda b: b[0])]


def word_frequency(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """Number of lines of the whole table that hold each word of the (fixed) vocabulary; it only settles the order of the words."""

    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text and not vocabulary.isdisjoint(words_of(text)):
                    for line in text.split("\n"):
                        found.update(vocabulary.intersection(words_of(line)))
        yield arrow_rows(pa.schema([("word", pa.binary()), ("n", pa.int64())]), [list(found), list(found.values())])

    counted = in_tasks(docs.select(F.col(text_col).cast("string")), count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counted.collect()}


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_words, n_base (places of phrases), first_word, last_word (smallest and largest start), base_labels,
    labels (with those of met templates), score (1 with a phrase, else the largest containment of a met template, else 0), and blocks
    (number of the first line, label and containment of each met template).

    A null or empty text has no words: counts 0, places null, labels empty, score 0. Repeated rows each get a row, null ids too. Other
    columns are ignored; an empty table gives no row.
    """
    rows = two_columns(docs, id_col, text_col)
    vocabulary = {w for _, text in templates for w in words_of(text)}
    index = TemplateIndex(templates, word_frequency(rows, vocabulary), threshold)
    wanted = [(tuple(words_of(p)), label) for p, label in phrases.items()]
    block = pa.struct([("line", pa.int64()), ("label", pa.string()), ("containment", pa.float64())])
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
         ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("blocks", pa.list_(block))]
    )

    def scan(text: str) -> tuple:
        words = words_of(text)
        there, places, base, blocks = set(words), [], set(), []
        for phrase, label in wanted:
            if there.issuperset(phrase) and (found := phrase_places(words, phrase)):
                places += found
                base.add(label)
        if not index.prefix.keys().isdisjoint(there):
            blocks = [{"line": number, "label": label, "containment": c} for number, label, c in index.blocks(text)]
        labels = base | {b["label"] for b in blocks}
        score = 1.0 if places else max((b["containment"] for b in blocks), default=0.0)
        ends = (min(places), max(places)) if places else (None, None)
        return len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score, blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(text or "") for text in batch.column(1).to_pylist()]
            yield arrow_rows(schema, [batch.column(0), *(list(zip(*found)) if found else [[]] * 8)])

    return in_tasks(
        rows, run,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
        "score double, blocks array<struct<line: bigint, label: string, containment: double>>",
    )
