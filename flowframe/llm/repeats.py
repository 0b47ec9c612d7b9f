"""Removal of every byte that lies in a string of ``LENGTH`` bytes which also starts elsewhere.

Strings that share their first ``LEAST`` bytes hold the same least gram there, so a start is filed under the least hash of
the grams behind it, and neighbours filed alike make one segment. Only segments go on whose gram stands elsewhere with the same
bytes before it or behind it, for half of what is left of ``LEAST`` (an exact filter); equal segments become one. The segments of a file lie in one shard, whose suffixes are put in order by
external induced sorting (``suffixes``); the common prefixes that come with the order give each start the longest string
that starts elsewhere too. A file of more bytes than a shard, as a very common passage makes it, is not sorted in one task:
the 128-bit fingerprints of its strings are counted over all tasks instead.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, discard, eights, map_blocks, mix, powers, ragged, small_batches, space_words, staged, texts, tidy
from .suffixes import MEMORY, longest_repeats, scratch

#: Strings of LENGTH bytes are removed; shorter repeats are known from LEAST bytes on.
LENGTH, LEAST, GRAM = 400, 256, 32
#: Words of a passage.
WORDS = 51
#: Bytes of segments in a shard, on average; a file above it is settled by fingerprints.
SHARD_BYTES = 2 << 20
_END = b"\xff"  # in no UTF-8 text
_GRAM_KEYS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _least(h: np.ndarray, w: int, of: np.ufunc = np.minimum) -> np.ndarray:
    """Least (or what ``of`` takes) of each w consecutive values: windows double until two of them cover w."""
    n, step = len(h) - w + 1, 1 << 14  # a stretch at a time stays in cache
    out = np.empty(n, h.dtype)
    for i in range(0, n, step):
        m = min(step, n - i)
        t, k = h[i : i + m + w - 1], 1
        while 2 * k <= w:
            t = of(t[:-k], t[k:])
            k *= 2
        of(t[:m], t[w - k : w - k + m], out=out[i : i + m])
    return out


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM = 32 bytes from each position on."""
    e, m = eights(data), len(data) - GRAM + 1
    out, step = np.empty(m, np.uint64), 1 << 15  # a stretch at a time stays in cache
    for i in range(0, m, step):
        n = min(step, m - i)
        out[i : i + n] = mix(sum(e[i + 8 * k : i + 8 * k + n] * _GRAM_KEYS[k] for k in range(GRAM // 8)))
    return out


def segments(data: np.ndarray, offs: np.ndarray, least: int = LEAST):
    """(document, file, first start in the block, number of starts, 2 if the file's gram stands twice in reach else 1) of
    each segment; then (segment, key) of what a string of ``least`` bytes that starts there must share with its like."""
    size = np.diff(offs)
    z = np.empty(0, np.int64)
    if len(data) < least or size.max() < least:
        return z, np.empty(0, np.uint64), z, z, z, z, z
    h = _grams(data)
    width = least - GRAM + 1
    low = _least(h, width)
    long_ = size >= least
    begin, end = offs[:-1][long_], offs[1:][long_] - least + 1
    new = np.append(True, low[1:] != low[:-1])
    new[begin] = True
    first = np.flatnonzero(new)
    stop = end[np.searchsorted(begin, first, "right") - 1]  # where the starts of the document end
    keep = (first < stop) & (first >= begin[0])
    first, stop = first[keep], stop[keep]
    file, starts = low[first], np.minimum(np.append(first[1:], len(low)), stop) - first
    # places that are the least of some window around them; two of a segment's file in its reach can repeat a string inside it
    top = _least(np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)]), width, np.maximum)
    place = np.flatnonzero(h == top[: len(h)])
    a, b = np.searchsorted(place, first), np.searchsorted(place, first + starts + least - GRAM)
    p, segment = place[ragged(a, b - a)], np.repeat(np.arange(len(file)), b - a)
    own = h[p] == file[segment]
    p, segment = p[own], segment[own]
    times = np.bincount(segment, minlength=len(file))
    doc = np.searchsorted(offs, first, "right") - 1
    # a string has half of its other bytes before the gram or behind it, so one of two longer stretches repeats with it
    half = (least - GRAM) // 2
    steps = sorted({*range(GRAM, half, GRAM), half})
    keys, owner = [], []
    for side, wanted, fits in (
        (1, p - (first + starts)[segment] < half, p + half + GRAM <= offs[1:][doc[segment]]),
        (-1, p - first[segment] > half, p - half >= offs[:-1][doc[segment]]),
    ):
        q = p[wanted & fits]
        key = h[q] + np.uint64(side + 1)
        for step in steps:
            key = mix(key) + h[q + side * step]
        keys.append(mix(key))
        owner.append(segment[wanted & fits])
    both = np.stack([np.concatenate(owner).astype(np.uint64), np.concatenate(keys)])
    order = np.lexsort(both[::-1])
    both = both[:, order]
    new = np.append(True, (both[:, 1:] != both[:, :-1]).any(axis=0))[: both.shape[1]]
    return doc, file, first, starts, np.minimum(times, 2), both[0, new].astype(np.int64), both[1, new].view(np.int64)


def spans_of(common: np.ndarray, least: int, length: int) -> list[int]:
    """Runs (first start, last start, reach) of starts with a common prefix of ``least`` bytes or more; reach is -1 for the
    starts of a repeated string of ``length`` bytes, else where the repeated strings end that start there."""
    reach = np.where(common >= length, -1, np.arange(len(common)) + common)
    i = np.flatnonzero(common >= least)
    if not len(i):
        return []
    new = np.append(True, (i[1:] != i[:-1] + 1) | (reach[i[1:]] != reach[i[:-1]]))
    first = np.flatnonzero(new)
    return np.stack([i[first], i[np.append(first[1:], len(i)) - 1], reach[i[first]]], axis=1).ravel().tolist()


def prints(part: np.ndarray, starts: int, length: int, words: int):
    """(start, end, fingerprint, second fingerprint) of the strings of ``length`` bytes and of ``words`` words at each start."""
    tail = np.arange(len(part))
    own = eights(part)  # sums over every eight bytes, scrambled, so that no pattern of single bytes cancels
    n = max(0, min(starts, len(part) - length + 1))
    a, b = tail[:n], tail[:n] + length
    s, e, _ = space_words(part, np.array([0, len(part)]))
    if len(s) >= words:
        at = s[: len(s) - words + 1]
        ok = at < starts
        a, b = np.append(a, at[ok]), np.append(b, e[words - 1 :][ok])
    p, q = powers(len(part) + 1)
    out = []
    for key in _GRAM_KEYS[1:3]:
        c = np.append(np.uint64(0), np.cumsum(mix(own[: len(part)] ^ key) * p[: len(part)]))
        out.append(mix((c[b - 7] - c[a]) * q[a] + (b - a).astype(np.uint64)).view(np.int64))
    return a, b, *out


_SETTLED = pa.schema([("digest", pa.binary()), ("spans", pa.list_(pa.int32()))])


def _settled(batches, least: int, length: int, memory: int):
    """Shard by shard, the spans of each part; rows (shard, digest, copies, starts, bytes) come in order of shard."""
    held = None

    def result():
        digest, copies, starts, size, file = held[1:]
        size, at = np.array(size), np.append(0, np.cumsum(np.array(size) + 1))
        text = np.memmap(file, np.uint8, "r", shape=(int(at[-1]),))
        begins = scratch(len(text), bool)
        for a, n in zip(at.tolist(), starts):
            begins[a : a + n] = True
        best = longest_repeats(text, begins, length, memory)
        spans = []
        for a, n, m, c in zip(at.tolist(), starts, size.tolist(), copies):
            room = np.minimum(m - np.arange(n), length)
            spans.append(spans_of(room if c > 1 else np.minimum(best[a : a + n], room), least, length))
        return pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(spans, pa.list_(pa.int32()))], schema=_SETTLED)

    for batch in batches:
        for shard, digest, copies, starts, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if held is None or held[0] != shard:
                if held is not None:
                    yield result()
                held = (shard, [], [], [], [], tempfile.TemporaryFile())
            for x, v in zip(held[1:], (digest, copies, starts, len(raw))):
                x.append(v)
            held[5].write(raw + _END)
            held[5].flush()
    if held is not None:
        yield result()


def repeated_spans(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, least: int = LEAST, words: int = WORDS, memory: int = MEMORY) -> DataFrame:
    """(doc_id, spans): runs of starts as ``spans_of`` has them, in bytes of the text, of documents that have any.

    ``docs`` is (doc_id, text) without nulls; doc_id is binary and names a text (see ``_named``). Rows that repeat both are
    documents of equal text, whose every string also starts elsewhere; they share one row of the result.
    """

    def file(ids, data, offs):
        doc, _, _, _, times, segment, key = segments(data, offs, least)
        if not len(key):
            return None
        seq = np.arange(len(doc)) - np.searchsorted(doc, doc)
        return [ids.take(pa.array(doc[segment])), key, seq[segment], times[segment]]

    filed = staged(map_blocks(docs, file, "doc_id binary, key long, seq int, times int"), "repeat-files")
    # what joins here grows with the documents and has no bound, so nothing is broadcast: sort and merge at every size
    used = filed.groupBy("key").agg(F.sum("times").alias("n")).where("n > 1").select("key")
    marks = staged(filed.join(used.hint("merge"), "key").groupBy("doc_id").agg(F.sort_array(F.collect_set("seq")).alias("seqs")), "repeat-marks")
    discard(filed)

    seg = pa.schema([("doc_id", pa.binary()), ("file", pa.int64()), ("digest", pa.binary()), ("at", pa.int64()), ("starts", pa.int32()), ("inner", pa.int32()), ("bytes", pa.binary())])

    def cut(batches):
        for batch in batches:
            seqs = batch.column(2)
            for row, n, data, offs in blocks(batch):
                rows: dict = {k: [] for k in seg.names}
                doc, file, first, starts, times, _, _ = segments(data, offs, least)
                begin, raw, file = np.searchsorted(doc, np.arange(n)).tolist(), data.tobytes(), file.view(np.int64)
                for d in range(n):
                    name, end = batch.column(0)[row + d].as_py(), int(offs[d + 1])
                    for s in seqs[row + d].as_py():
                        i = begin[d] + s
                        a, m = int(first[i]), int(starts[i])
                        part = raw[a : min(end, a + m + length - 1)]
                        for k, v in zip(seg.names, (name, int(file[i]), hashlib.blake2b(part, digest_size=16).digest(), a - int(offs[d]), m, int(times[i] > 1), part)):
                            rows[k].append(v)
                yield pa.RecordBatch.from_pydict(rows, schema=seg)

    small_batches(docs.sparkSession)
    marked = docs.where(F.octet_length("text") >= least).join(marks.hint("merge"), "doc_id").select("doc_id", "text", "seqs")
    found = staged(marked.mapInArrow(tidy(cut), "doc_id binary, file long, digest binary, at long, starts int, inner int, bytes binary"), "repeat-segments")
    discard(marks)
    parts = staged(found.groupBy("file", "digest").agg(F.count(F.lit(1)).alias("copies"), F.max("inner").alias("inner"), F.first("starts").alias("starts"), F.first("bytes").alias("bytes")), "repeat-parts")
    # a file with one part needs no sorting unless the part repeats inside
    per = parts.groupBy("file").agg(F.count(F.lit(1)).alias("parts"), F.max("inner").alias("inside"), F.sum(F.octet_length("bytes") + F.lit(1)).alias("size")).where("parts > 1 or inside > 0")
    per = staged(per, "repeat-per-file")
    total = per.where(F.col("size") <= shard_bytes).agg(F.sum("size")).first()[0] or 0
    todo = parts.join(per.hint("merge"), "file").select(F.pmod("file", F.lit(max(8, -(-total // shard_bytes)))).alias("shard"), "digest", "copies", "starts", "bytes", (F.col("size") > shard_bytes).alias("hot"))
    sorted_ = todo.where("not hot").drop("hot").repartition("shard").sortWithinPartitions("shard")
    settled = staged(sorted_.mapInArrow(tidy(lambda b: _settled(b, least, length, memory)), "digest binary, spans array<int>"), "repeat-settled")

    def fingers(batches):
        for batch in batches:
            for digest, starts, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                a, b, one, two = prints(np.frombuffer(raw, np.uint8), starts, length, words)
                yield pa.RecordBatch.from_arrays([pa.array([digest] * len(a), pa.binary()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(one), pa.array(two)], ["digest", "a", "b", "p", "q"])

    hot = staged(todo.where("hot").select("digest", "starts", "bytes").mapInArrow(tidy(fingers), "digest binary, a int, b int, p long, q long"), "repeat-prints")
    again = hot.groupBy("p", "q").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("p", "q")
    run = F.array("a", "a", F.when(F.col("b") - F.col("a") >= length, F.lit(-1)).otherwise(F.col("b")))
    late = hot.join(again.hint("merge"), ["p", "q"]).groupBy("digest").agg(F.flatten(F.collect_list(run)).alias("spans"))
    # every start of a part with copies stands elsewhere, as far as the part goes
    size, last = F.octet_length("bytes"), F.col("starts") - 1
    full = F.when(size >= length, F.array(F.lit(0), F.least(last, size - length), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    rest = F.when(last > size - length, F.array(F.greatest(F.lit(0), size - length + 1), last, size)).otherwise(F.array().cast("array<int>"))
    whole = parts.where("copies > 1").join(per.where(F.col("size") <= shard_bytes).select("file").hint("merge"), "file", "left_anti").select("digest", F.concat(full, rest).alias("spans"))
    spans = settled.where(F.size("spans") > 0).unionByName(late).unionByName(whole)
    at = found.select("doc_id", "digest", "at").join(spans.hint("merge"), "digest")
    moved = F.transform("spans", lambda x: F.when(x < 0, F.lit(-1).cast("long")).otherwise(x.cast("long") + F.col("at")))
    out = staged(at.select("doc_id", moved.alias("spans")).groupBy("doc_id").agg(F.flatten(F.collect_set("spans")).alias("spans")), "repeat-spans")
    discard(found, parts, per, settled, hot)
    return out


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a binary ``name`` of id and text, so that a null or repeated id mixes no two texts."""
    digits = lambda c: F.lpad(F.hex(c), 16, "0")
    own = F.coalesce(F.col("doc_id"), F.xxhash64(F.lit(1), "text"))
    return docs.withColumn("name", F.unhex(F.concat(digits(own), digits(F.xxhash64("text")))))


def merged(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans (first ascending) as rows (start, end) of maximal ones."""
    if not len(first):
        return np.empty((0, 2), np.int64)
    far = np.maximum.accumulate(end)
    new = np.append(True, first[1:] > far[:-1])
    i = np.flatnonzero(new)
    return np.stack([first[i], far[np.append(i[1:], len(first)) - 1]], axis=1)


def passage_words(raw: bytes, runs: np.ndarray, gone: np.ndarray, words: int) -> int:
    """Words in stretches of ``words`` words that lie whole in a repeated string, or in a removed run."""
    data = np.frombuffer(raw, np.uint8)
    s, e, _ = space_words(data, np.array([0, len(data)]))
    if len(s) < words or not len(runs):
        return 0
    head, end = s[: len(s) - words + 1], e[words - 1 :]
    # of runs that cover a start, the farthest reach counts
    order = np.argsort(runs[:, 0], kind="stable")
    runs = runs[order]
    i = np.searchsorted(runs[:, 0], head, "right") - 1
    hit = np.zeros(len(head), bool)
    for back in range(4):  # a start has one run, or three where fingerprints give it
        j = i - back
        ok = (j >= 0) & (head <= runs[np.maximum(j, 0), 1])
        hit |= ok & (runs[np.maximum(j, 0), 2] >= end)
    if len(gone):
        j = np.searchsorted(gone[:, 0], head, "right") - 1
        hit |= (j >= 0) & (gone[np.maximum(j, 0), 1] >= end)
    change = np.zeros(len(s) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(change, at, 1)
    np.add.at(change, at + words, -1)
    return int((np.cumsum(change) > 0).sum())


def removed(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, least: int = LEAST, words: int = WORDS, memory: int = MEMORY) -> DataFrame:
    """One row a document: n_bytes, n_removed, n_spans, kept_sha256 of what stays, and n_passage_words.

    ``n_passage_words`` counts the words of passages of ``words`` words or more that repeat and hold ``least`` bytes, which may
    be shorter than what is removed. Null text counts as empty; texts shorter than ``length`` lose nothing; copies of a text
    all lose what they share. Every row is a document, also one that repeats another row or its doc_id, or has no doc_id.
    """
    plain = _named(texts(docs))
    long_ = plain.where(F.octet_length("text") >= least).select(F.col("name").alias("doc_id"), "text")
    spans = repeated_spans(long_, length, shard_bytes, least, words, memory).withColumnRenamed("doc_id", "name")
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("n_passage_words", pa.int64())])

    def take(batches):
        for batch in batches:
            rows: dict = {k: [] for k in out.names}
            for doc, text, marks in zip(*(batch.column(i) for i in range(3))):
                raw = (text.as_py() or "").encode()
                runs = np.array(marks.as_py() or [], np.int64).reshape(-1, 3)
                hits = runs[runs[:, 2] < 0]
                hits = hits[np.argsort(hits[:, 0], kind="stable")]
                gone = merged(hits[:, 0], hits[:, 1] + length)
                edges = [0, *gone.ravel().tolist(), len(raw)]
                kept = hashlib.sha256(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))).hexdigest()
                for k, v in zip(out.names, (doc.as_py(), len(raw), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), kept, passage_words(raw, runs, gone, words))):
                    rows[k].append(v)
            yield pa.RecordBatch.from_pydict(rows, schema=out)

    small_batches(docs.sparkSession)
    return plain.join(spans.hint("merge"), "name", "left").select("doc_id", "text", "spans").mapInArrow(tidy(take), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_words long")
