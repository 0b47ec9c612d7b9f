"""Language-model scoring with a weighted backoff automaton over word n-grams of any order.

States are the histories of up to ``order`` - 1 words that training holds; a text begins in the state of the start symbol. A
state has an arc for each word that follows it in training, and a failure arc to the state of its longest proper suffix; the
root has an arc for every word. With c counts over training tokens, N tokens, V words, and h' the history h without its
first word:

    root arc of w:      P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))
    arc of h to w:      P(w | h) = (c(hw) + s P(w | h')) / (c(h) + s)
    failure arc of h:   s / (c(h) + s)

which sums to one over w for each h. One traversal from left to right carries the state of each text: it takes failure arcs
until the state has an arc for the word, follows it, and adds up the logarithms. Long texts are walked in lanes of ``LANE``
tokens side by side; a lane begins order - 1 tokens early, after which its state is that of the whole walk.

Documents are dealt into blocks by hash. A block asks for the counts of its own distinct n-grams, one packed message per
hash range; ranges are totalled over all blocks and answered in the order asked, so each task holds the part of the
automaton that its own texts can reach, never the whole model. Blocks grow with the square root of the input, so the number
of messages grows in proportion to it. A frequent word is one number in each message, however often it stands. Words are told
apart by 96 bits, longer n-grams by 64.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, lower, mix, small_batches, space_words, span_hashes, staged

STRENGTH, ORDER = 1.0, 2
#: Bytes of text in a block, on average and at least, and bytes of text for each message.
BLOCK_TEXT, MESSAGE_TEXT = 12 << 20, 4096
LANE = 256
_END, _START, _GRAM = np.uint64(0x1D8AF066F0C4A7E3), np.uint64(0x6A09E667F3BCC909), np.uint64(0xA24BAED4963EE407)


def _texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    col = table.column("text").combine_chunks().cast(pa.large_binary())
    col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    body = col.buffers()[2]
    return (np.frombuffer(body, np.uint8)[offs[0] : offs[-1]] if body is not None else np.empty(0, np.uint8)), offs - offs[0]


class Grams:
    """The n-grams of a block of texts: for each order the sorted distinct keys, and which of them ends at each token.

    ``keys[0]`` has a second hash of each word in ``more``. ``top`` is the longest n-gram at each token, as a text begins with
    one start symbol.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, order: int):
        low = lower(data)
        s, e, first = space_words(low, offs)
        n = np.diff(first)
        self.begin, self.size, self.order = first[:-1] + np.arange(len(n)), n + 1, order
        word, other = (np.full(len(s) + len(n), x, np.uint64) for x in (_END, _START))
        inside = np.ones(len(word), bool)
        inside[self.begin + n] = False
        if len(s):
            word[inside], other[inside] = span_hashes(low, s, e), span_hashes(low, s, e, 1)
        other >>= np.uint64(32)
        self.top = np.minimum(np.arange(len(word)) - np.repeat(self.begin, self.size) + 2, order)
        key, more, at, rep = _distinct(word, other)
        self.keys, self.more, self.at, self.rep = [key], more, [at], [rep]
        token = mix(word + mix(other))
        gram = token
        for m in range(2, order + 1):
            before = np.empty_like(gram)
            before[1:] = gram[:-1]
            before[self.begin] = _START if m == 2 else 0
            gram = mix(before * _GRAM + token)
            some = np.flatnonzero(self.top >= m)
            key, _, at, rep = _distinct(gram[some])
            full = np.full(len(word), -1, np.int32)
            full[some] = at
            self.keys.append(key)
            self.at.append(full)
            self.rep.append(some[rep])

    def counts(self, learned: np.ndarray) -> list[np.ndarray]:
        """How often each distinct n-gram stands in the texts for which ``learned`` is true."""
        some = np.repeat(learned, self.size)
        return [np.bincount(at[some & (at >= 0)], minlength=len(k)) for at, k in zip(self.at, self.keys)]


def _distinct(x: np.ndarray, y: np.ndarray | None = None):
    """Sorted distinct keys (and second keys), for each element its place among them, and an element of each."""
    order = np.argsort(x, kind="stable")
    new = np.append(True, x[order[1:]] != x[order[:-1]]) if len(x) else np.empty(0, bool)
    if y is not None and len(x):
        again = ~new
        again[1:] &= y[order[1:]] != y[order[:-1]]
        if again.any():  # two words of one hash
            order = np.lexsort((y, x))
            new = np.append(True, (x[order[1:]] != x[order[:-1]]) | (y[order[1:]] != y[order[:-1]]))
    at = np.empty(len(x), np.int32)
    at[order] = np.cumsum(new) - 1
    rep = order[new]
    return x[rep], None if y is None else y[rep], at, rep


def walk(g: Grams, counts: list[np.ndarray], n_docs: int, n: int, v: int, strength: float = STRENGTH, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """(root weight, weight of the arcs taken) at each token, in log10, given the total count of each distinct n-gram."""
    order, total = g.order, len(g.top)
    root = np.log10((counts[0] + 0.5) / (n + 0.5 * (v + 1)))
    starts = np.zeros(total, bool)
    starts[g.begin] = True
    # the automaton: weight of each arc that training has, and of the failure arc of each state
    arcs, fails = [root], [np.log10(strength / (c + strength)) for c in counts[: order - 1]]
    from_start = math.log10(strength / (n_docs + strength))
    for m in range(2, order + 1):
        at = g.rep[m - 1]
        state = np.where(starts[at], n_docs, counts[m - 2][g.at[m - 2][at - 1]]) if len(at) else np.empty(0)
        arcs.append(np.log10((counts[m - 1] + strength * 10.0 ** arcs[m - 2][g.at[m - 2][at]]) / (state + strength)))
    lanes = np.arange(0, total, lane)
    level, out = np.zeros(len(lanes), np.int64), np.empty(total)
    for step in range(1 - order, lane):
        at = lanes + step
        live = np.flatnonzero((at >= 0) & (at < total))
        at, now = at[live], level[live]
        first = starts[at]
        now[first] = 1 if n_docs and order > 1 else 0
        arc, weight = np.minimum(now + 1, order), np.zeros(len(at))
        for m in range(order, 1, -1):  # at a state of m - 1 words: its arc for this word, or its failure arc
            here = np.flatnonzero(arc == m)
            p = at[here]
            gram = g.at[m - 1][p]
            hit = (gram >= 0) & (counts[m - 1][gram] > 0)
            weight[here[hit]] += arcs[m - 1][gram[hit]]
            miss = here[~hit]
            q = at[miss]
            weight[miss] += np.where(first[miss], from_start, fails[m - 2][g.at[m - 2][q - 1]])
            arc[miss] = m - 1
        low = np.flatnonzero(arc == 1)
        word = g.at[0][at[low]]
        weight[low] += root[word]
        now = np.minimum(arc, order - 1)
        now[low] = np.minimum(now[low], counts[0][word] > 0)
        level[live] = now
        if step >= 0:
            out[at] = weight
    return root[g.at[0]], out


def _packed(keys: np.ndarray) -> bytes:
    """Sorted numbers as their differences, in as few bytes each as the largest needs."""
    step = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(step.max()).bit_length() + 7) // 8)
    return bytes([width]) + step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    width = raw[0]
    wide = np.zeros(((len(raw) - 1) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(wide.reshape(-1).view("<u8"), dtype=np.uint64)


def _cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.empty(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def scores(docs: DataFrame, folds: int = 5, held: int = 1, strength: float = STRENGTH, order: int = ORDER, block_text: int | None = None, lane: int = LANE) -> DataFrame:
    """One row a document: held_out, n_tokens, n_known, train_tokens, base_score, score (log10) and score_per_token.

    Documents whose crc32(doc_id) leaves ``held`` modulo ``folds`` are scored but not learned from; a null doc_id counts
    as empty text there. Null and empty texts have the end token alone. Repeated rows are learned and scored each time.
    With no training token every word is unseen: N and V are 0 and each token has probability one.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("doc_id"), text.alias("text"), F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)), F.lit(0)).alias("fold"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block_text = block_text or max(BLOCK_TEXT, math.isqrt(size * MESSAGE_TEXT))
    bits = max(3, (size // block_text).bit_length())
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << bits)).cast("int"))

    def ask(table: pa.Table) -> pa.Table:
        learned = table.column("fold").to_numpy() != held
        g = Grams(*_texts(table), order)
        out = {k: [] for k in _ASKED.names}
        for kind, (keys, count) in enumerate(zip(g.keys, g.counts(learned))):
            cut = _cuts(keys, bits)
            for part, (a, b) in enumerate(zip(cut, cut[1:])):
                if b > a:
                    more = g.more[a:b].astype("<u4").tobytes() if kind == 0 else b""
                    for k, x in zip(_ASKED.names, (table.column("block")[0].as_py(), kind, part, _packed(keys[a:b]), more, zlib.compress(count[a:b].astype("<u4").tobytes(), 1), 0)):
                        out[k].append(x)
        out["docs"][0] = int(learned.sum())
        give_back()
        return pa.table(out, _ASKED)

    def answer(table: pa.Table) -> pa.Table:
        words = table.column("kind")[0].as_py() == 0
        keys = [_unpacked(x.as_py()) for x in table.column("keys")]
        more = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table.column("more")]) if words else None
        counts = np.concatenate([np.frombuffer(zlib.decompress(x.as_py()), "<u4") for x in table.column("counts")])
        distinct, _, at, _ = _distinct(np.concatenate(keys), more)
        total = np.bincount(at, weights=counts, minlength=len(distinct)).astype("<u8")
        ends = np.cumsum([len(k) for k in keys])
        reply = [zlib.compress(total[at[e - len(k) : e]].tobytes(), 1) for k, e in zip(keys, ends)]
        first = [1] + [0] * (len(reply) - 1)
        return pa.table({"block": table.column("block"), "kind": table.column("kind"), "part": table.column("part"), "counts": reply, "docs": table.column("docs"), "n": [x * int(total.sum()) * words for x in first], "v": [x * int((total > 0).sum()) * words for x in first]}, _ANSWERED)

    asked = rows.groupBy("block").applyInArrow(ask, "block int, kind int, part int, keys binary, more binary, counts binary, docs long")
    answered = staged(asked.groupBy("kind", "part").applyInArrow(answer, "block int, kind int, part int, counts binary, docs long, n long, v long"), "lm-counts")
    n_docs, n, v = (x or 0 for x in answered.agg(F.sum("docs"), F.sum("n"), F.sum("v")).first())

    def score(table: pa.Table, replies: pa.Table) -> pa.Table:
        g = Grams(*_texts(table), order)
        line = np.lexsort([replies.column("part").to_numpy(), replies.column("kind").to_numpy()])
        kinds, packed = replies.column("kind").to_numpy(), replies.column("counts")
        counts = [np.concatenate([np.empty(0, "<u8"), *(np.frombuffer(zlib.decompress(packed[int(i)].as_py()), "<u8") for i in line if kinds[i] == k)]).astype(np.int64) for k in range(order)]
        root, arcs = walk(g, counts, n_docs, n, v, strength, lane)
        total = lambda x: np.add.reduceat(x, g.begin)
        found = total(arcs)
        give_back()
        return pa.table({"doc_id": table.column("doc_id"), "held_out": table.column("fold").to_numpy() == held, "n_tokens": g.size, "n_known": total((counts[0][g.at[0]] > 0).astype(np.int64)), "train_tokens": np.full(len(g.size), n), "base_score": total(root), "score": found, "score_per_token": found / g.size}, _SCORED)

    return rows.groupBy("block").cogroup(answered.select("block", "kind", "part", "counts").groupBy("block")).applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, score_per_token double")


_ASKED = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("more", pa.binary()), ("counts", pa.binary()), ("docs", pa.int64())])
_ANSWERED = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("counts", pa.binary()), ("docs", pa.int64()), ("n", pa.int64()), ("v", pa.int64())])
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("score_per_token", pa.float64())])
