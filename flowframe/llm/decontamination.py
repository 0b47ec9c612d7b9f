"""Benchmark decontamination by pigeonhole edit matching.

An item of n words may be found with up to k = floor(rate * n) word edits (insert, delete, replace). Cut into k + 1 pieces,
at least one piece must stand unchanged in any such place, so exact piece hits are complete candidates; each is verified
with Myers' bit-parallel distance, one bit a word. Items are held in passes of ``ITEMS_PER_PASS``, each pass scanning all
documents, so what a task holds is bounded however many items there are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import blocks, discard, lower, map_blocks, mix, small_batches, span_hashes, staged, texts, tidy
from .licenses import license_words

RATE = 0.2
ITEMS_PER_PASS = 20_000
_STEP = np.uint64(0xD6E8FEB86659FD93)


def myers(pattern: list[int], text: list[int], k: int) -> tuple[int, int] | None:
    """(distance, end) of the best approximate occurrence of pattern in text within k, the first of equals."""
    m = len(pattern)
    peq: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, None
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = (mv | ~(xh | pv)) & full, pv & xh
        score += bool(ph & high) - bool(mh & high)
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = (mh | ~(xv | ph)) & full, ph & xv
        if score <= k and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


class Items:
    """Pieces of one pass of items: for each piece length, sorted hashes and what they belong to."""

    def __init__(self, rows: list[tuple[int, str]], rate: float):
        self.words: list[tuple[int, list[int], int]] = []
        self.hashes: list[np.ndarray] = []
        pieces: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for item, text in rows:
            data = lower(np.frombuffer((text or "").encode(), np.uint8))
            s, e, _ = license_words(data, np.array([0, len(data)]))
            if not len(s):
                continue
            h = span_hashes(data, s, e)
            n = len(h)
            k = int(rate * n)
            at = len(self.words)
            self.words.append((item, h.tolist(), k))
            self.hashes.append(h)
            cuts = [n * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces[b - a][int(rolled(h[a:b], b - a)[0])].append((at, a))
        self.sets = [np.unique(h) for h in self.hashes]
        self.tables = {n: (np.array(sorted(x), np.uint64), [x[v] for v in sorted(x)]) for n, x in sorted(pieces.items())}

    def matches(self, data: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, distance, end word) of the best place of each item in each document.

        A place with at most k edits keeps all but k words of the item. So an item is dropped where the document lacks more of
        its words than that, and a window in which fewer words than the rest belong to the item is never searched: a piece that
        many items and many places share costs a vector operation for each item, not a step for each pair.
        """
        low = lower(data)
        s, e, first = license_words(low, offs)
        if not len(s):
            return []
        h = span_hashes(low, s, e)
        last = np.repeat(first[1:], np.diff(first))  # the end of each word's document
        places: dict[int, dict[tuple[int, int], np.ndarray]] = defaultdict(dict)
        g, width = h, 1
        for n, (table, _) in self.tables.items():
            while width < n and len(g):
                g = g[:-1] * _STEP + h[width:]
                width += 1
            if width < n or not len(g):
                break
            x = mix(g)
            at = np.minimum(np.searchsorted(table, x), len(table) - 1)
            hit = np.flatnonzero((table[at] == x) & (np.arange(len(x)) + n <= last[: len(x)]))
            if not len(hit):
                continue
            rows, piece = np.searchsorted(first, hit, "right") - 1, at[hit]
            order = np.lexsort((hit, piece, rows))
            hit, rows, piece = hit[order], rows[order], piece[order]
            cut = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (piece[1:] != piece[:-1])))
            for a, b in zip(cut.tolist(), np.append(cut[1:], len(hit)).tolist()):
                places[int(rows[a])][n, int(piece[a])] = hit[a:b]
        out = []
        for d in sorted(places):
            out += self._within(d, h, int(first[d]), int(first[d + 1]), places[d])
        return out

    def _within(self, d: int, h: np.ndarray, begin: int, end: int, places: dict[tuple[int, int], np.ndarray]) -> list[tuple[int, int, int, int]]:
        words = h[begin:end]
        opened: dict[int, list[np.ndarray]] = defaultdict(list)
        for (n, t), at in places.items():
            for i, o in self.tables[n][1][t]:
                opened[i].append(at - o)
        items = sorted(opened)
        have = np.unique(words)
        size = np.array([len(self.words[i][1]) for i in items])
        flat = np.concatenate([self.hashes[i] for i in items])
        known = have[np.minimum(np.searchsorted(have, flat), len(have) - 1)] == flat
        enough = np.add.reduceat(known, np.cumsum(size) - size) >= size - np.array([self.words[i][2] for i in items])
        out = []
        for i in np.array(items)[enough].tolist():
            item, pattern, k = self.words[i]
            n, own = len(pattern), self.sets[i]
            from_ = np.unique(np.concatenate(opened[i])) - k
            a, b = np.maximum(from_, begin), np.minimum(from_ + n + 2 * k, end)
            mine = own[np.minimum(np.searchsorted(own, words), len(own) - 1)] == words
            seen = np.append(0, np.cumsum(mine))
            full = seen[b - begin] - seen[a - begin] >= n - k
            a, b = a[full], b[full]
            if not len(a):
                continue
            cut = np.flatnonzero(np.append(True, a[1:] > b[:-1]))  # windows come in order and are equally long
            best, stop = None, -1
            for x, y in zip(a[cut].tolist(), b[np.append(cut[1:], len(a)) - 1].tolist()):
                found = myers(pattern, h[x:y].tolist(), k)
                if found and (best is None or found[0] < best):
                    best, stop = found[0], x + found[1] - begin
            if best is not None:
                out.append((d, item, best, stop))
        return out


def rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words."""
    g = h
    for i in range(1, n):
        g = g[:-1] * _STEP + h[i:]
    return mix(g)


def passes(items: DataFrame, rate: float) -> Iterator[Items]:
    """Items in passes of ``ITEMS_PER_PASS``, one at a time; at least one."""
    rows, n = [], 0
    for r in items.select("item_id", "text").toLocalIterator():
        rows.append((r["item_id"], r["text"]))
        if len(rows) == ITEMS_PER_PASS:
            yield Items(rows, rate)
            rows, n = [], n + 1
    if rows or not n:
        yield Items(rows, rate)


def _by_pass(items: DataFrame, rate: float, step: Callable[[Items, DataFrame | None], DataFrame]) -> DataFrame:
    """``step`` (items of a pass, what the passes before it made) carried through all passes.

    What a pass made is written before the next one's items are read, so the driver holds those of one pass.
    """
    out, held = None, None
    for one in passes(items, rate):
        if out is not None:
            out = staged(out, "items-pass")
            if held is not None:
                discard(held)
            held = out
        out = step(one, out)
    return out


def matches(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance, end_word) of every document and item within the item's error budget.

    The best place of each item in each row, the first of equal distances; items that tie each have a row. Null or empty texts
    and items without a word match nothing; repeated rows, repeated items and items without an id each give their matches. Texts
    of any length are searched whole; other columns are not read.
    """

    def step(one: Items, before: DataFrame | None) -> DataFrame:
        def find(ids, data, offs):
            got = one.matches(data, offs)
            if not got:
                return None
            d, i, k, e = zip(*got)
            return [ids.take(pa.array(d)), pa.array(i, pa.int64()), pa.array(k, pa.int32()), pa.array(e, pa.int64())]

        part = map_blocks(texts(docs), find, "doc_id long, item_id long, distance int, end_word long")
        return part if before is None else before.unionByName(part)

    return _by_pass(items, rate, step)


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns kept, without a shuffle.

    Null and empty texts hold nothing and stay; each of several equal rows, and of rows that share a doc_id, is judged by
    its own text; a text of any length is searched whole.
    """
    small_batches(docs.sparkSession)

    def step(one: Items, before: DataFrame | None) -> DataFrame:
        def keep(batches):
            for batch in batches:
                at = batch.schema.get_field_index("text")
                filled = pa.RecordBatch.from_arrays([batch.column(at).fill_null("")], ["text"])
                bad = np.zeros(batch.num_rows, bool)
                for row, _, data, offs in blocks(filled):
                    for d, *_ in one.matches(data, offs):
                        bad[row + d] = True
                yield batch.filter(pa.array(~bad))

        return (docs if before is None else before).mapInArrow(tidy(keep), docs.schema)

    return _by_pass(items, rate, step)
