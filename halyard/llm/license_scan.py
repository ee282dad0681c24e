"""License scan with a generalised suffix automaton of licence words.

The automaton holds every run of words of the templates. Texts are streamed
through it word by word, which gives matching statistics: the longest run of
template words ending at each word, and by the suffix links the longest of each
template. Runs that cannot be extended in their template and are long enough
are chained, in the order of both text and template, into spans, and a
template whose span covers enough of its words labels the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.llm.common import per_batch, texts, with_columns
from halyard.llm.licences import LICENCES

#: Phrases that label a text wherever their words stand consecutively (fixed values).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Well-known notices, from the public licence texts (fixed values).
NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "apache": "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "as-is": "The software is provided as is, without warranty of any kind, express or implied",
    "mit-line": "Released under the MIT License",
    "apache-line": "Licensed under the Apache License, Version 2.0",
    "gpl-line": "This work is licensed under the GNU General Public License, version 3",
    "spdx": "SPDX-License-Identifier",
}

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text: str) -> list[str]:
    """ASCII-lower-cased runs of letters, digits and characters beyond ASCII."""
    return WORD.findall(text.lower() if text.isascii() else text.translate(LOWER))


class Automaton:
    """Generalised suffix automaton over the words of templates, and the scan of one text."""

    def __init__(self, templates: list[tuple[str, str, bool]], min_match: int, gap: int, cover: float):
        """templates: label, text, whether it is a phrase."""
        self.words = [words_of(t) for _, t, _ in templates]
        self.labels = [x.rstrip() for x, _, _ in templates]  # further templates of a label end in spaces
        self.min_match, self.gap, self.cover = min_match, gap, cover
        self.vocab = {w for ws in self.words for w in ws}
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set] = {}
        for t, ws in enumerate(self.words):
            last = 0
            for at, w in enumerate(ws):
                last = self._extend(last, w)
                ends.setdefault(last, set()).add((t, at))
        # what ends at a state ends at the states its suffix links lead to
        for v in sorted(range(1, len(self.next)), key=lambda v: -self.length[v]):
            ends.setdefault(self.link[v], set()).update(ends.get(v, ()))
        self.ends = [sorted(ends.get(v, ())) for v in range(len(self.next))]
        whole: dict[int, int] = {}
        for t, (_, _, phrase) in enumerate(templates):
            if phrase:
                v = 0
                for w in self.words[t]:
                    v = self.next[v][w]
                whole[v] = t
        self.matches: dict[int, list[tuple[int, int, list[int], set[str]]]] = {}
        self.phrases: list[list[tuple[int, int]]] = []
        for v in range(len(self.next)):
            up, found = v, []
            while up > 0:
                if up in whole:
                    found.append((whole[up], len(self.words[whole[up]])))
                up = self.link[up]
            self.phrases.append(found)

    def _state(self, length: int, link: int, nexts: dict[str, int]) -> int:
        self.next.append(nexts)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: str) -> int:
        """The part of q's class no longer than what p and w spell, as a state of its own."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: str) -> int:
        if w in self.next[last]:
            return self._split(last, self.next[last][w], w)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][w], w)
        return new

    def scan(self, words: list[str]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """Phrase places (template, first word), and spans (template, first word, last word, covered share)."""
        vocab, nexts, link, length, least = self.vocab, self.next, self.link, self.length, self.min_match
        places, runs = [], {}
        v = n = 0
        before = -2
        for i, w in [(i, w) for i, w in enumerate(words) if w in vocab]:
            if i != before + 1:
                v = n = 0
            while v and w not in nexts[v]:
                v = link[v]
                n = length[v]
            if w in nexts[v]:
                v = nexts[v][w]
                n += 1
            if n >= least:
                after = words[i + 1] if i + 1 < len(words) else None
                for size, t, ats, following in self._matches(v):
                    if after not in following:
                        runs.setdefault(t, []).extend((i, min(n, size), at) for at in ats)
            if n and self.phrases[v]:
                places.extend((t, i - size + 1) for t, size in self.phrases[v] if size <= n)
            before = i
        return places, self._chain(runs)

    def _matches(self, v: int) -> list[tuple[int, int, list[int], set[str]]]:
        """Of each template that holds min_match words or more of what ends at state v: how many at most, where they end in it, and the words after them there."""
        known = self.matches.get(v)
        if known is None:
            known, up, met = [], v, set()
            while up > 0 and self.length[up] >= self.min_match:
                own: dict[int, list[int]] = {}
                for t, at in self.ends[up]:
                    if t not in met:
                        own.setdefault(t, []).append(at)
                known += [(self.length[up], t, ats, {self.words[t][at + 1] for at in ats if at + 1 < len(self.words[t])}) for t, ats in own.items()]
                met.update(own)
                up = self.link[up]
            self.matches[v] = known
        return known

    def _chain(self, runs: dict[int, list[tuple[int, int, int]]]) -> list[tuple[int, int, int, float]]:
        """Spans: of each template, chains of runs that go on in text and template, at most a gap apart, that cover enough of it.

        runs: by template, the last word in the text, the number of words and the
        last place in the template. Every place of a run in a template is the end of its best chain: the run
        alone, or after the chain of a run before it, whichever covers more. The
        chains that cover most are taken first, and none that overlaps another.
        """
        spans = []
        for t, own in runs.items():
            chains: list[tuple[int, int, int, int]] = []  # covered words, first word, last word, last place in the template
            for i, (end, n, at) in enumerate(own):
                start = end - n + 1
                best = (n, start)
                for k in range(i - 1, -1, -1):
                    covered, first, last, reached = chains[k]
                    if last < start - self.gap:
                        break
                    if last < end and reached < at:
                        best = max(best, (covered + min(n, at - reached), first), key=lambda c: (c[0], c[1]))
                chains.append((*best, end, at))
            taken: list[tuple[int, int]] = []
            for covered, first, last, _ in sorted(chains, key=lambda c: (-c[0], c[1], c[2])):
                if covered / len(self.words[t]) < self.cover:
                    break
                k = bisect_left(taken, (first, last))
                if (k == 0 or taken[k - 1][1] < first) and (k == len(taken) or taken[k][0] > last):
                    taken.insert(k, (first, last))
                    spans.append((t, first, last, covered / len(self.words[t])))
        return sorted(spans, key=lambda s: (s[1], s[2], s[0]))


def template_table(spark: SparkSession) -> DataFrame:
    """(label, text): the notices of this module and the whole licences of ``licences``."""
    return spark.createDataFrame([*NOTICES.items(), *LICENCES.items()], "label string, text string")


def notice_table(templates: DataFrame, most_chars: int = 20_000_000) -> dict[str, str]:
    """Licence templates of a table (label, text), whole licences too, for scan_licenses; several of a label are told apart by spaces after it.

    Every task holds their automaton, so their characters have a bound; beyond
    it this raises. Rows without label or text are left out.
    """
    rows = templates.where("label is not null and text is not null")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    if size > most_chars:
        raise ValueError(f"templates of {size} characters are more than the {most_chars} a task may hold")
    out: dict[str, str] = {}
    for label, text in sorted((r["label"], r["text"]) for r in rows.select("label", "text").collect()):
        name = label
        while name in out:
            name += " "
        out[name] = text
    return out


@lru_cache(maxsize=2)
def automaton(phrases: tuple, notices: tuple, min_match: int, gap: int, cover: float) -> Automaton:
    return Automaton([(x, p, True) for p, x in phrases] + [(x, t, False) for x, t in notices], min_match, gap, cover)


SPAN = "array<struct<label:string,first_word:long,last_word:long,covered:double>>"
SPAN_TYPE = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.float64())]))


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    min_match: int = 3,
    gap: int = 8,
    cover: float = 0.6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    notices: those of this module, or of a table by notice_table, whole licences
    too. phrases label wherever they stand; notices label where a chain of runs
    of min_match words or more, at most gap words apart, covers the share cover
    of them; a licence that holds another, or its opening words, has both labels. score is the largest covered share, 1 for a phrase, 0 for nothing.
    Null and empty texts have no words, empty labels, score 0 and null places;
    whole texts of any length are scanned; repeated rows give repeated rows; a
    null id stays null; an empty table gives no rows; other columns are ignored,
    whatever their names.
    """
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    key = (tuple(phrases.items()), tuple(notices.items()), min_match, gap, cover)

    def make():
        a = automaton(*key)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            cols: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for t in texts(batch):
                words = words_of(t)
                places, spans = a.scan(words)
                starts = [p for _, p in places]
                base = {a.labels[t] for t, _ in places}
                found = base | {a.labels[t] for t, *_ in spans}
                row = (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(found)),
                       1.0 if places else max((s[3] for s in spans), default=0.0),
                       [{"label": a.labels[t], "first_word": f, "last_word": l, "covered": c} for t, f, l, c in spans])
                for column, value in zip(cols.values(), row, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), SPAN_TYPE]
            return with_columns(batch, ["id"], **{k: pa.array(v, kind) for (k, v), kind in zip(cols.items(), kinds, strict=True)})

        return one

    kind = slim.schema["id"].dataType.simpleString()
    out = per_batch(slim, f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {SPAN}", make)
    return out.withColumnRenamed("id", id_col)
