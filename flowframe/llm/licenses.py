"""License scan as an exact set-similarity join of templates against text blocks.

A template is a set of words. A text block is twice a template's step of consecutive words of a document, one every step;
the step is the template's length, and ``STEP`` words at least, so each passage as long as the template lies whole in a
block. A block meets a template if it holds at least
``threshold`` of the template's distinct words. Words are ordered by their frequency over all documents, rarest first;
a block can only meet a template if it holds one of the template's first |T| - need + 1 words (prefix filter), has enough
words (length filter), and enough words are left behind the shared one on both sides (positional filter). Survivors are
counted exactly. Base phrases are templates of threshold 1 whose words must also stand consecutively.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower, map_blocks, runs, span_hashes, texts

STEP = 32
THRESHOLD = 0.8

# fixed values: base phrases and their labels
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# fixed values: one distinctive sentence of each license, in the words of its public text
TEMPLATES = {
    "apache": "licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
# fixed values: whole licenses, in the words of their public texts
FULL = {
    "isc": """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
        provided that the above copyright notice and this permission notice appear in all copies the software is provided as is
        and the author disclaims all warranties with regard to this software including all implied warranties of merchantability
        and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages
        whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action
        arising out of or in connection with the use or performance of this software""",
    "mit": """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the rights to
        use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the
        software is furnished to do so subject to the following conditions the above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the software the software is provided as is without warranty
        of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular
        purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other
        liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or
        the use or other dealings in the software""",
}

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def license_words(data: np.ndarray, offs: np.ndarray):
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased bytes."""
    return runs(_WORD[data], offs)


def hash_of(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        b = np.frombuffer(w.encode(), np.uint8)
        out.append(span_hashes(b, np.array([0]), np.array([len(b)]))[0])
    return np.array(out, np.uint64)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    threshold: float
    consecutive: bool

    @property
    def step(self) -> int:
        return max(STEP, len(self.words))

    @property
    def need(self) -> int:
        return max(1, math.ceil(self.threshold * len(set(self.words)) - 1e-9))


def templates(threshold: float = THRESHOLD) -> list[Template]:
    return [Template(v, tuple(k.split()), 1.0, True) for k, v in PHRASES.items()] + [Template(k, tuple(v.split()), threshold, False) for some in (TEMPLATES, FULL) for k, v in some.items()]


class Vocabulary:
    """The words of all templates, found by hash; a number for each, -1 for any other word."""

    def __init__(self, ts: list[Template]):
        self.words = sorted({w for t in ts for w in t.words})
        h = hash_of(self.words)
        self.by = np.argsort(h)
        self.sorted = h[self.by]

    def ids(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        return np.where(self.sorted[at] == h, self.by[at], -1)


def frequencies(docs: DataFrame, ts: list[Template]) -> dict[str, int]:
    """How often each template word stands in all documents; as many rows as the templates have words."""
    vocabulary = Vocabulary(ts)

    def count(ids, data, offs):
        low = lower(data)
        s, e, _ = license_words(low, offs)
        got = vocabulary.ids(span_hashes(low, s, e)) if len(s) else np.empty(0, np.int64)
        n = np.bincount(got[got >= 0], minlength=len(vocabulary.words))
        return [vocabulary.words, n]

    rows = map_blocks(texts(docs), count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {w: 0 for w in vocabulary.words} | {r["word"]: r["n"] for r in rows}


def scan(docs: DataFrame, ts: list[Template] | None = None) -> DataFrame:
    """One row a document: n_words, and of the matches: phrase places, labels, best containment and first words of met blocks.

    Null and empty text give zero words and no match; a repeated row or doc_id is scanned again; text of any length is
    cut into blocks. Labels are distinct and sorted.
    """
    ts = templates() if ts is None else ts
    vocabulary = Vocabulary(ts)
    counts = frequencies(docs, ts)
    number = {w: i for i, w in enumerate(vocabulary.words)}
    rank = np.empty(len(vocabulary.words), np.int64)
    rank[[number[w] for w in sorted(vocabulary.words, key=lambda w: (counts[w], w))]] = np.arange(len(vocabulary.words))
    sets = [sorted({int(rank[number[w]]) for w in t.words}) for t in ts]
    order = [[int(rank[number[w]]) for w in t.words] for t in ts]
    prefix: dict[int, list[tuple[int, int]]] = {}
    for k, (t, s) in enumerate(zip(ts, sets)):
        for i in range(len(s) - t.need + 1):
            prefix.setdefault(s[i], []).append((k, i))
    in_prefix = np.zeros(len(rank), bool)
    in_prefix[list(prefix)] = True

    def find(ids, data, offs):
        low = lower(data)
        s, e, first = license_words(low, offs)
        n = len(offs) - 1
        got = vocabulary.ids(span_hashes(low, s, e)) if len(s) else np.empty(0, np.int64)
        at = np.flatnonzero(got >= 0)
        tok = rank[got[at]]
        n_base, lo, hi = np.zeros(n, np.int64), [None] * n, [None] * n
        base, labels, score, met = [""] * n, [""] * n, np.zeros(n), [[] for _ in range(n)]
        docs_hit = np.unique(np.searchsorted(first, at[in_prefix[tok]], "right") - 1)
        for d in docs_hit.tolist():
            a, b = np.searchsorted(at, [first[d], first[d + 1]])
            where, what = at[a:b] - first[d], tok[a:b]
            places, found, best = match(where, what)
            if places:
                n_base[d], lo[d], hi[d] = len(places), min(p for p, _ in places), max(p for p, _ in places)
                base[d] = ",".join(sorted({ts[k].label for _, k in places}))
            if found:
                labels[d] = ",".join(sorted({ts[k].label for _, k in found}))
                score[d] = best
                met[d] = sorted({int(x) for x, _ in found})
        return [ids, np.diff(first), n_base, lo, hi, base, labels, score, pa.array(met, pa.list_(pa.int64()))]

    def match(where: np.ndarray, what: np.ndarray):
        candidates: set[tuple[int, int]] = set()
        blocks: dict[tuple[int, int], np.ndarray] = {}

        def block(start: int, words: int) -> np.ndarray:
            if (start, words) not in blocks:
                blocks[start, words] = np.unique(what[np.searchsorted(where, start) : np.searchsorted(where, start + words)])
            return blocks[start, words]

        for p, t in zip(where[in_prefix[what]].tolist(), what[in_prefix[what]].tolist()):
            for k, i in prefix[t]:
                step, need = ts[k].step, ts[k].need
                for x in {p // step, p // step - 1} - {-1}:
                    held = block(x * step, 2 * step)
                    j = int(np.searchsorted(held, t))
                    if len(held) >= need and 1 + min(len(sets[k]) - i - 1, len(held) - j - 1) >= need:
                        candidates.add((k, x * step))
        places, found, best = set(), set(), 0.0
        position = dict(zip(where.tolist(), what.tolist()))
        for k, x in candidates:
            a, b = np.searchsorted(where, [x, x + 2 * ts[k].step])
            share = len(set(what[a:b].tolist()) & set(sets[k])) / len(sets[k])
            if share * len(sets[k]) < ts[k].need:
                continue
            if ts[k].consecutive:
                starts = where[a:b][what[a:b] == order[k][0]].tolist()
                hits = [p for p in starts if all(position.get(p + i) == w for i, w in enumerate(order[k]))]
                places |= {(p, k) for p in hits}
                if not hits:
                    continue
            found.add((x, k))
            best = max(best, share)
        return places, found, best

    return map_blocks(texts(docs), find, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, blocks array<long>")
