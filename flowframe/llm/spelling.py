"""Spelling variants of frequent words by pairless wildcard groups.

Two words differ by one replaced letter exactly if they share one group (position, letters before it, letters behind it).
Such a group holds a word for each letter at most, so its size and its two most frequent words tell every member how
many replacements it has and which is the best, without a pair. The same key with nothing at the position is the word that
a deletion leaves, so insertions and deletions join the groups too; of equal neighbouring letters only the first counts as
deleted, which gives each such pair one group.

Keys are digests of the letters before and behind, taken on from letter to letter, so a word of any length takes memory in
proportion to its length. Words carry numbers in code-point order instead of their text.
"""

from __future__ import annotations

import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blockwise, discard, lower, ragged, runs, staged, texts, tidy

#: Least letters and occurrences of a word; a form has RATIO times as many.
LETTERS, OCCURRENCES, RATIO = 6, 5, 5
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LEAD = 0xC3  # U+00C0 to U+00FF are this byte and one more
_LONG = 64
_KEYS = 1 << 16


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def crcs(prefix: list[bytes], doc: np.ndarray, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """crc32 of each document's prefix and each span behind it, by one byte of all spans at a time."""
    begun = np.array([zlib.crc32(p) for p in prefix], np.uint32)
    order = np.argsort(s - e, kind="stable")  # longest first
    at, size = s[order], (e - s)[order]
    state = begun[doc[order]] ^ np.uint32(0xFFFFFFFF)
    for j in range(min(int(size.max(initial=0)), _LONG)):
        k = int(np.searchsorted(-size, -j, "left"))
        x = state[:k]
        state[:k] = _CRC[(x ^ data[at[:k] + j]) & np.uint32(255)] ^ (x >> np.uint32(8))
    out = np.empty(len(s), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(e - s > _LONG):
        out[i] = zlib.crc32(data[s[i] : e[i]].tobytes(), int(begun[doc[i]]))
    return out


def word_counts(docs: DataFrame, letters: int = LETTERS, drop_every: int | None = None) -> DataFrame:
    """(word, n) of the runs of letters of all texts, A-Z lower-cased, with ``letters`` code points at least.

    With ``drop_every``, a run whose crc32 of ``<doc_id>:<run>`` it divides loses the letter at that crc's place first; a
    null doc_id counts as no characters. Null and empty texts hold nothing; equal rows count each.
    """

    def run(ids, data, offs):
        low = lower(data)
        inside = _LETTER[low]
        lead = low == _LEAD
        inside |= lead
        inside[1:] |= lead[:-1]
        s, e, first = runs(inside, offs)
        behind = np.concatenate([[0], np.cumsum(lead)])
        n = (e - s) - (behind[e] - behind[s])
        keep = n >= letters
        doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))[keep]
        s, e, n = s[keep], e[keep], n[keep]
        if not len(s):
            return None
        less = []
        if drop_every:
            h = crcs([b"%s:" % (b"" if i is None else str(i).encode()) for i in ids.to_pylist()], doc, low, s, e).astype(np.int64)
            cut = h % drop_every == 0
            for i in np.flatnonzero(cut & (n > letters)):
                word, at = low[s[i] : e[i]].tobytes().decode(errors="replace"), int(h[i] % n[i])
                less.append(word[:at] + word[at + 1 :])
            s, e = s[~cut], e[~cut]
        offsets = np.concatenate([[0], np.cumsum(e - s)])
        chars = low[ragged(s, e - s)] if len(s) else np.empty(0, np.uint8)
        words = pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(chars))
        found = pa.concat_arrays([words, pa.array(less, pa.large_string())]).value_counts()
        return [found.field("values"), found.field("counts")]

    return blockwise(texts(docs), run, "word string, n long", 4 << 20).groupBy("word").agg(F.sum("n").alias("n"))


def wildcards(words: DataFrame) -> DataFrame:
    """(key, star, canon, n, no) of words (no, n, word): a key for each letter left out (``star``) and for each gap.

    ``canon`` marks the first of a run of equal letters, whose deletion stands for those of the others.
    """
    out = pa.schema([("key", pa.binary()), ("star", pa.bool_()), ("canon", pa.bool_()), ("n", pa.int64()), ("no", pa.int64())])

    def digests(letters):
        h = blake2b(digest_size=12)
        yield h.digest()
        for c in letters:
            h.update(c)
            yield h.digest()

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in out]
            for no, n, word in zip(*(batch.column(i).to_pylist() for i in range(3))):
                letters = [c.encode() for c in word]
                size = len(letters)
                before, behind = list(digests(letters)), list(digests(reversed(letters)))[::-1]
                cols[0] += [before[p] + behind[p + 1] for p in range(size)] + [a + b for a, b in zip(before, behind)]
                cols[1] += [True] * size + [False] * (size + 1)
                cols[2] += [p == 0 or letters[p] != letters[p - 1] for p in range(size)] + [False] * (size + 1)
                cols[3] += [n] * (2 * size + 1)
                cols[4] += [no] * (2 * size + 1)
                if len(cols[0]) >= _KEYS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)
                    cols = [[] for _ in out]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    return words.select("no", "n", "word").mapInArrow(tidy(run), "key binary, star boolean, canon boolean, n long, no long")


def near_words(words: DataFrame) -> DataFrame:
    """(no, n_near, best) of the words (no, n, word) that have a near word; best is (-n, no) of the most frequent one.

    A group is collected: it holds a word for each letter of the alphabet at most (90) and one without.
    """
    member = F.struct((-F.col("n")).alias("neg"), "no", "canon")
    stars = F.sort_array(F.collect_list(F.when(F.col("star"), member)))
    gap = F.min(F.when(~F.col("star"), F.struct((-F.col("n")).alias("neg"), "no")))
    groups = wildcards(words).groupBy("key").agg(F.count(F.lit(1)).alias("size"), stars.alias("stars"), gap.alias("gap")).where("size > 1")
    groups = groups.select("stars", "gap", F.get("stars", F.lit(0)).alias("one"), F.get("stars", F.lit(1)).alias("two"), F.filter("stars", lambda m: m["canon"]).alias("heads"))
    pick = lambda m: F.when(m.isNotNull(), F.struct(m["neg"].alias("neg"), m["no"].alias("no")))

    def told(m):
        left = m["canon"] & F.col("gap").isNotNull()
        other = F.when(m["no"] == F.col("one.no"), pick(F.col("two"))).otherwise(pick(F.col("one")))
        n = F.size("stars") - 1 + left.cast("int")
        return F.struct(m["no"].alias("no"), n.cast("long").alias("n_near"), F.least(other, F.when(left, F.col("gap"))).alias("best"))

    whole = F.struct(F.col("gap.no").alias("no"), F.size("heads").cast("long").alias("n_near"), pick(F.get("heads", F.lit(0))).alias("best"))
    each = groups.select(F.inline(F.concat(F.transform("stars", told), F.array(whole)))).where("no is not null and n_near > 0")
    return each.groupBy("no").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(no, to) of links (no, to) without a circle, each followed to its last by doubling steps."""
    links = staged(links, "spelling-links")
    while True:
        ahead = links.select(F.col("no").alias("to"), F.col("to").alias("next"))
        moved = staged(links.join(ahead, "to", "left").select("no", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "spelling-links")
        discard(links)
        links = moved
        if not links.where("moved").limit(1).count():
            return links


def variants(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, ratio: int = RATIO, drop_every: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``letters`` code points and ``occurrences`` at least.

    ``form`` is the near word (one letter inserted, deleted or replaced) of largest n, the first in code-point order of
    equals, if its n is ``ratio`` times the word's; ``root`` follows forms to the last. Null and empty texts hold no word,
    equal rows count each, texts and words may be of any length, other columns are not read; no rows give no words. Forms
    only lead to more frequent words, so ``ratio`` is at least 2.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    counts = staged(word_counts(docs, letters, drop_every).where(F.col("n") >= occurrences), "spelling-counts")
    words = staged(counts.orderBy("word").select(F.monotonically_increasing_id().alias("no"), "word", "n"), "spelling-words")
    near = near_words(words).withColumns({"to": F.col("best.no"), "form_n": -F.col("best.neg")}).select("no", "n_near", "to", "form_n")
    found = words.join(near, "no", "left")
    real = F.col("form_n") >= ratio * F.col("n")
    found = found.select("no", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(real, F.col("to")).alias("to"), F.when(real, F.col("form_n")).alias("form_n"))
    found = staged(found, "spelling-found")
    last = roots(found.where("to is not null").select("no", "to"))
    named = lambda at, name: words.select(F.col("no").alias(at), F.col("word").alias(name))
    ends = last.select("no", F.col("to").alias("end")).join(named("end", "root"), "end").select("no", "root")
    linked = found.where("to is not null").join(ends, "no").join(named("to", "form"), "to")
    alone = found.where("to is null").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    out = staged(linked.select(*alone.columns).unionByName(alone), "spelling-variants")
    discard(counts, words, found, last)
    return out

