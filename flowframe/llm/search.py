"""Ranked lexical search over a two-level quantised index.

A segment of the index holds a block of documents by term. Its first level has one byte for each posting, the term's impact
in the document rounded up to a whole number of ``STEP``; its second level has the exact count. Sums of bytes bound a score
from above, and from below by less than a step a term, so one pass over the first level finds the k-th best lower bound of
each item, and a second one rescores, in whole numbers, every document whose upper bound reaches it. No document is lost, and
nothing but the bounds of the best leaves a task.

Items are a query set in blocks: a pass holds ``PASS_TERMS`` (item, term) entries at most, whatever their number.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import blockwise, discard, free_name, lower, span_hashes, staged, texts, tidy
from .licenses import license_words

BEST = 20
#: A score of a term is below FULL; a byte counts steps of it.
FULL = 1_000_000
STEP = -(-FULL // 255)
#: (item, term) entries of a pass: 20 bytes each on the driver and in a task.
PASS_TERMS = 1 << 20
#: Items whose bounds a task holds at a time, and terms of fewer items than that are added posting by posting.
ITEM_GROUP, RARE = 1024, 8
_BLOCK = 1 << 20
_SEGMENT = "ids array<long>, m array<long>, terms binary, offs binary, docs binary, impact binary, tf binary"


def _terms(data: np.ndarray, offs: np.ndarray):
    """(hash of each term, terms of each document)."""
    low = lower(data)
    s, e, first = license_words(low, offs)
    return (span_hashes(low, s, e) if len(s) else np.empty(0, np.uint64)), np.diff(first)


def term_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


@dataclass
class Index:
    """Segments of all documents, with the number of documents that hold a term and of all their terms."""

    segments: DataFrame
    n_docs: int
    n_terms: int

    def close(self) -> None:
        discard(self.segments)


def build(docs: DataFrame) -> Index:
    """The index of (doc_id, text). Null and empty texts hold no term; every row is a document of its own."""

    def sizes(ids, data, offs):
        low = lower(data)
        n = np.diff(license_words(low, offs)[2])
        return [np.array([np.count_nonzero(n)]), np.array([n.sum()])]

    n_docs, n_terms = blockwise(texts(docs), sizes, "docs long, terms long", _BLOCK).agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()

    def segment(ids, data, offs):
        h, n = _terms(data, offs)
        if not len(h):
            return None
        m = np.array([75 + 25 * x * n_docs // n_terms for x in n.tolist()], np.int64)
        doc = np.repeat(np.arange(len(n), dtype=np.uint32), n)
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        tf = np.diff(np.append(at, len(h)))
        h, doc = h[at], doc[at]
        starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        impact = -(-term_score(tf, m[doc]) // STEP)
        cols = [h[starts], np.append(starts, len(h)).astype("<i4"), doc.astype("<u4"), impact.astype(np.uint8), tf.astype("<u4")]
        return [pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([m], pa.list_(pa.int64())), *[pa.array([c.tobytes()], pa.binary()) for c in cols]]

    return Index(staged(blockwise(texts(docs), segment, _SEGMENT, _BLOCK), "search-index"), n_docs, n_terms)


class Weights:
    """What a pass asks for: its terms in order of their hashes, and of each term the items and weights, by term and by item."""

    def __init__(self, item: np.ndarray, term: np.ndarray, weight: np.ndarray, n_items: int):
        self.n = n_items
        self.vocab, t = np.unique(term, return_inverse=True)
        order = np.lexsort((item, t))
        self.term, self.item, self.weight = t[order], item[order], weight[order]
        self.offs = np.searchsorted(self.term, np.arange(len(self.vocab) + 1))
        order = np.lexsort((t, item))
        self.of_item, self.of_weight = t[order], weight[order]
        self.item_offs = np.searchsorted(item[order], np.arange(n_items + 1))

    def postings(self, terms: bytes, offs: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(term of the pass, place of the posting) of a segment's postings that matter, by term."""
        have, at = np.frombuffer(terms, np.uint64), np.frombuffer(offs, "<i4").astype(np.int64)
        i = np.minimum(np.searchsorted(have, self.vocab), len(have) - 1)
        hit = np.flatnonzero(have[i] == self.vocab)
        i = i[hit]
        size = at[i + 1] - at[i]
        total = int(size.sum())
        return np.repeat(hit, size), np.repeat(at[i] - (np.cumsum(size) - size), size) + np.arange(total)

    def sums(self, term: np.ndarray, doc: np.ndarray, value: np.ndarray, n_docs: int, a: int, b: int) -> np.ndarray:
        """(documents, items a to b) sums of weight times value; exact, as all sums stay below 2**53."""
        lo, hi = self.offs[term], self.offs[term + 1]
        out = np.zeros((n_docs, b - a))
        wide = hi - lo >= RARE
        if wide.any():
            used, col = np.unique(term[wide], return_inverse=True)
            have = np.zeros((n_docs, len(used)))
            have[doc[wide], col] = value[wide]
            size = self.offs[used + 1] - self.offs[used]
            row = np.repeat(np.arange(len(used)), size)
            at = np.repeat(self.offs[used] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            pick = (self.item[at] >= a) & (self.item[at] < b)
            by = np.zeros((len(used), b - a))
            by[row[pick], self.item[at[pick]] - a] = self.weight[at[pick]]
            out += have @ by
        few = np.flatnonzero(~wide)
        if len(few):
            size = hi[few] - lo[few]
            post = np.repeat(few, size)
            at = np.repeat(lo[few] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            pick = (self.item[at] >= a) & (self.item[at] < b)
            post, at = post[pick], at[pick]
            np.add.at(out, (doc[post], self.item[at] - a), self.weight[at] * value[post].astype(float))
        return out


def _segments(batches, columns: list[str]):
    for batch in batches:
        for i in range(batch.num_rows):
            yield [batch.column(c)[i] for c in columns]


def _kth(index: Index, ask: Weights, k: int) -> np.ndarray:
    """The k-th largest lower bound of each item over all documents, 1 at least."""

    def run(batches):
        from pyspark import TaskContext

        best = np.zeros((k, ask.n))
        for ids, terms, offs, docs, impact in _segments(batches, ["ids", "terms", "offs", "docs", "impact"]):
            term, at = ask.postings(terms.as_buffer(), offs.as_buffer())
            if not len(term):
                continue
            doc = np.frombuffer(docs.as_buffer(), "<u4")[at]
            q = np.frombuffer(impact.as_buffer(), np.uint8)[at].astype(float)
            for a in range(0, ask.n, ITEM_GROUP):
                b = min(a + ITEM_GROUP, ask.n)
                low = ask.sums(term, doc, np.where(q > 0, q * STEP - (STEP - 1), 0), len(ids), a, b)
                both = np.concatenate([best[:, a:b], low])
                best[:, a:b] = np.partition(both, len(both) - k, axis=0)[len(both) - k :]
        i, j = np.nonzero(best)
        part = np.full(len(i), TaskContext.get().partitionId() % 64, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(j.astype(np.int64)), pa.array(part), pa.array(best[i, j].astype(np.int64))], ["item", "part", "low"])

    lows = index.segments.select("ids", "terms", "offs", "docs", "impact").mapInArrow(tidy(run), "item long, part int, low long")
    for by in (["item", "part"], ["item"]):  # what many tasks found is cut down in two steps
        lows = lows.withColumn("r", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("low")))).where(F.col("r") <= k)
    out = np.ones(ask.n, np.int64)
    for r in lows.where(F.col("r") == k).select("item", "low").toLocalIterator():
        out[r["item"]] = max(1, r["low"])
    return out


def _rescored(index: Index, ask: Weights, least: np.ndarray, names: np.ndarray, k: int) -> DataFrame:
    """(no, doc_id, score) of documents whose upper bound reaches ``least``; each task tells its best k of an item only."""

    def exact(term, doc, tf, m, d, i, n_docs):
        """Scores of the (document, item) pairs, in whole numbers."""
        key = term * n_docs + doc  # rises, as postings come by term, then by document
        size = ask.item_offs[i + 1] - ask.item_offs[i]
        pair = np.repeat(np.arange(len(d)), size)
        at = np.repeat(ask.item_offs[i] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        want = ask.of_item[at] * n_docs + d[pair]
        place = np.minimum(np.searchsorted(key, want), len(key) - 1)
        hit = key[place] == want
        pair, at, place = pair[hit], at[hit], place[hit]
        score = np.zeros(len(d), np.int64)
        np.add.at(score, pair, ask.of_weight[at] * term_score(tf[place], m[doc[place]]))
        return score

    def run(batches):
        held: list[np.ndarray] = []

        def cut():
            rows = np.concatenate(held, axis=1)
            rows = rows[:, np.lexsort((rows[2], rows[1], -rows[3], rows[0]))]  # null ids last
            start = np.flatnonzero(np.append(True, rows[0][1:] != rows[0][:-1]))
            rank = np.arange(rows.shape[1]) - np.repeat(start, np.diff(np.append(start, rows.shape[1])))
            return rows[:, rank < k]

        for ids, m, terms, offs, docs, impact, tf in _segments(batches, ["ids", "m", "terms", "offs", "docs", "impact", "tf"]):
            term, at = ask.postings(terms.as_buffer(), offs.as_buffer())
            if not len(term):
                continue
            doc = np.frombuffer(docs.as_buffer(), "<u4")[at].astype(np.int64)
            q = np.frombuffer(impact.as_buffer(), np.uint8)[at]
            count = np.frombuffer(tf.as_buffer(), "<u4")[at].astype(np.int64)
            names_, m = ids.values, np.asarray(m.values)
            for a in range(0, ask.n, ITEM_GROUP):
                b = min(a + ITEM_GROUP, ask.n)
                d, i = np.nonzero(ask.sums(term, doc, q.astype(float) * STEP, len(ids), a, b) >= least[a:b])
                if not len(d):
                    continue
                i = i + a
                score = exact(term, doc, count, m, d, i, len(ids))
                keep = score >= least[i]
                who = names_.take(pa.array(d[keep]))
                held.append(np.stack([i[keep], np.asarray(who.is_null()).astype(np.int64), np.asarray(who.fill_null(0)), score[keep]]))
            if sum(x.shape[1] for x in held) > 1 << 16:
                held = [cut()]
        if held:
            i, null, who, score = cut()
            yield pa.RecordBatch.from_arrays([pa.array(names[i]), pa.array(who, mask=null > 0), pa.array(score)], ["no", "doc_id", "score"])

    return index.segments.mapInArrow(tidy(run), "no long, doc_id long, score long")


def _document_counts(index: Index, vocab: np.ndarray) -> dict[int, int]:
    """Documents that hold each of the terms, by its hash."""

    def run(batches):
        n = np.zeros(len(vocab), np.int64)
        for terms, offs in _segments(batches, ["terms", "offs"]):
            have, at = np.frombuffer(terms.as_buffer(), np.uint64), np.frombuffer(offs.as_buffer(), "<i4")
            i = np.minimum(np.searchsorted(have, vocab), len(have) - 1)
            n += np.where(have[i] == vocab, at[i + 1] - at[i], 0)
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(n[hit])], ["term", "n"])

    found = index.segments.select("terms", "offs").mapInArrow(tidy(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r["term"]: r["n"] for r in found.toLocalIterator()}


def search(index: Index, items: DataFrame, k: int = BEST, pass_terms: int = PASS_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score) of each row's k best documents, scores above 0 only, equal ones by doc_id, null last.

    ``items`` is (item_id, text). Every row is an item of its own, also where its id is null or repeated; one without a term,
    or whose terms no document holds, has no rows.
    """
    row = free_name(items, "no")
    rows = staged(items.select(F.monotonically_increasing_id().alias(row), "item_id", F.coalesce("text", F.lit("")).alias("text")), "search-items")

    def entries(ids, data, offs):
        h, n = _terms(data, offs)
        if not len(h):
            return None
        no = np.repeat(np.asarray(ids), n)
        pair, count = np.unique(np.stack([no, h.view(np.int64)]), axis=1, return_counts=True)
        return [pair[0], pair[1], count]

    asked = staged(blockwise(rows.select(F.col(row).alias("doc_id"), "text"), entries, "no long, term long, n long", _BLOCK), "search-terms")
    passes = max(1, -(-asked.count() // pass_terms))
    best = []
    for p in range(passes):
        part = asked.where(F.pmod(F.xxhash64("no"), F.lit(passes)) == p).toPandas() if index.n_docs else None
        if part is None or not len(part):
            continue
        names, item = np.unique(part["no"].to_numpy(), return_inverse=True)
        term = part["term"].to_numpy().view(np.uint64)
        vocab, t = np.unique(term, return_inverse=True)
        held = _document_counts(index, vocab)
        df = np.array([held.get(i, 0) for i in range(len(vocab))])
        w = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        known = df[t] > 0
        ask = Weights(item[known], term[known], (w[t] * part["n"].to_numpy())[known], len(names))
        if known.any():
            best.append(_rescored(index, ask, _kth(index, ask, k), names, k))
    if not best:
        out = rows.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
        discard(rows, asked)
        return out
    found = best[0]
    for other in best[1:]:
        found = found.unionByName(other)
    order = W.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    out = staged(found.join(rows.select(F.col(row).alias("no"), "item_id"), "no").select("item_id", "rank", "doc_id", "score"), "search-best")
    discard(rows, asked)
    return out


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """``search`` of an index of ``docs`` that is built for it and deleted behind it.

    Null and empty texts hold no term; equal rows are documents of their own with equal scores; texts are read whole; other
    columns of either table are not read; an empty table gives no rows.
    """
    index = build(docs)
    out = search(index, items, k)
    index.close()
    return out
