"""Byte-level BPE by a pair occurrence index.

A block of texts is cut into pre-tokens by vector operations on code point classes. The distinct pre-tokens that the
worker has not met yet are laid out in one symbol array; an index maps every adjacent pair to all its positions. Active
pairs are applied in ascending rank, each at all its positions at once, and only the lists of the pairs next to a merge
change. Decoding joins the bytes of the ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_blocks, ragged, span_equal, span_hashes, texts

VOCABULARY = "byte_bpe_50k.json"
#: Distinct pre-tokens that a worker remembers before it starts anew; memory, not results, depends on it.
REMEMBERED = 400_000
#: Bytes of a block; many new pre-tokens at once share the work of each rank.
BYTES = 4 << 20
#: Bytes of documents that are pre-tokenised at once.
STRETCH = 1 << 18
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3
_WHITE = {*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}


def _byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: itself where printable, else the next from 256."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Table:
    """Index of each key by open addressing; one gather a probe, and few probes."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys)).bit_length() + 3)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        for i, (slot, key) in enumerate(zip(self._slots(keys).tolist(), keys.tolist())):
            while self.keys[slot] not in (-1, key):
                slot = (slot + 1) & ((1 << self.bits) - 1)
            if self.keys[slot] == -1:
                self.keys[slot], self.values[slot] = key, i

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        while len(left):
            have = self.keys[slot]
            hit = have == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            go = ~hit & (have != -1)
            left, slot = left[go], (slot[go] + 1) & ((1 << self.bits) - 1)
        return out


class Encoder:
    """A vocabulary and what the worker has encoded with it so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = _byte_symbols()
        raw = {k: bytes(to_byte[c] for c in k) for k in spec["model"]["vocab"]}
        vocab = spec["model"]["vocab"]
        self.bytes_of = {i: raw[k] for k, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.of_byte = np.zeros(256, np.int64)
        for i, b in self.bytes_of.items():
            if len(b) == 1:
                self.of_byte[b[0]] = i
        merges = [m if isinstance(m, list) else m.split(" ", 1) for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges])
        self.right = np.array([vocab[b] for _, b in merges])
        self.made = np.array([vocab[a + b] for a, b in merges])
        key = self.left << 32 | self.right
        self.table = _Table(key)
        self.rank_of = {int(k): i for i, k in reversed(list(enumerate(key.tolist())))}
        self.lengths = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, b in self.bytes_of.items():
            self.lengths[i] = len(b)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.pool = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(len(self.lengths))), np.uint8)
        self.classes = _classes()
        self.forget()

    def forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)
        self.bytes = np.empty(0, np.uint8)
        self.begin = self.size = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint16 if len(self.lengths) <= 1 << 16 else np.uint32)

    # -- pre-tokens

    def pretokens(self, raw: bytes, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each pre-token of a block in bytes, and the offsets of documents in them; none spans two documents."""
        cp = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        n = len(cp)
        utf8 = np.zeros(n + 1, np.int64)
        np.cumsum(1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000), out=utf8[1:])
        cuts = np.searchsorted(utf8, offs)
        edge = np.zeros(n + 1, bool)
        edge[cuts] = edge[n] = True
        kind = self.classes[cp]
        first = edge.copy()
        first[0] = True
        first[1:n] |= kind[1:] != kind[:-1]
        starts = np.flatnonzero(first[:n])
        ends = np.append(starts[1:], n)
        k, inner = kind[starts], ~edge[ends]
        # a white run before something else gives up its last character: to the next token if it is a blank, else as one
        white = np.flatnonzero((k == _SPACE) & inner)
        blank = cp[ends[white] - 1] == 0x20
        first[ends[white] - 1] = True
        first[ends[white[blank]]] = False
        # contractions: a lone apostrophe that starts a token, with the letters behind it
        lone = np.flatnonzero((k == _OTHER) & (cp[starts] == 0x27) & (ends - starts == 1) & inner)
        for i in starts[lone].tolist():
            if not first[i]:
                continue
            m = 2 if not edge[i + 2] and (chr(cp[i + 1]) + chr(cp[i + 2])) in ("re", "ve", "ll") else 1 if chr(cp[i + 1]) in "stmd" else 0
            if m:
                first[i + 1] = False
                first[i + 1 + m] = True
        at = np.flatnonzero(first[:n])
        return utf8[at], utf8[np.append(at[1:], n)], np.searchsorted(at, cuts)

    # -- merging

    def merge(self, symbols: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and offsets of many words at once; ``symbols`` holds the ids of their bytes."""
        n = len(symbols)
        sym = symbols.copy()
        word = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
        nxt = np.arange(1, n + 1)
        nxt[offs[1:][np.diff(offs) > 0] - 1] = n
        prv = np.arange(-1, n - 1)
        prv[offs[:-1][np.diff(offs) > 0]] = -1
        alive = np.ones(n, bool)
        sym = np.append(sym, -1)
        lists: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def index(pos: np.ndarray) -> None:
            """Enter the pairs that start at ``pos`` into the index."""
            pos = pos[nxt[pos] < n]
            if len(pos) <= 8:
                for p in pos.tolist():
                    r = self.rank_of.get(int(sym[p]) << 32 | int(sym[nxt[p]]))
                    if r is not None:
                        if r not in lists:
                            lists[r] = []
                            heapq.heappush(heap, r)
                        lists[r].append(np.array([p]))
                return
            rank = self.table.find(sym[pos] << 32 | sym[nxt[pos]])
            ok = rank >= 0
            pos, rank = pos[ok], rank[ok]
            order = np.argsort(rank, kind="stable")
            pos, rank = pos[order], rank[order]
            cut = np.flatnonzero(np.diff(rank)) + 1
            for r, p in zip(rank[np.append(0, cut)].tolist() if len(rank) else [], np.split(pos, cut)):
                if r not in lists:
                    lists[r] = []
                    heapq.heappush(heap, r)
                lists[r].append(p)

        index(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            got = lists.pop(r)
            pos = np.sort(np.concatenate(got)) if len(got) > 1 else np.sort(got[0])
            if len(pos) > 1:
                pos = pos[np.append(True, pos[1:] != pos[:-1])]
            a, b, new = self.left[r], self.right[r], self.made[r]
            pos = pos[alive[pos] & (sym[pos] == a) & (sym[nxt[pos]] == b)]
            if a == b and len(pos) > 1:  # overlapping places: from the left, each symbol once
                keep, used = [], -1
                for p in pos.tolist():
                    if p != used:
                        keep.append(p)
                        used = int(nxt[p])
                pos = np.array(keep)
            if not len(pos):
                continue
            gone = nxt[pos]
            after = nxt[gone]
            sym[pos] = new
            alive[gone] = False
            nxt[pos] = after
            inside = after < n
            prv[after[inside]] = pos[inside]
            before = prv[pos]
            before = before[before >= 0]
            index(np.concatenate([before, pos]))
        return sym[:n][alive], np.searchsorted(word[alive], np.arange(len(offs)))

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Places among the known pre-tokens of new and old ones; ``h`` are distinct and sorted."""
        if len(self.known) > REMEMBERED:
            self.forget()
        at = np.minimum(np.searchsorted(self.known, h), max(0, len(self.known) - 1))
        new = np.flatnonzero(self.known[at] != h) if len(self.known) else np.arange(len(h))
        if len(new):
            size = ends[new] - starts[new]
            piece = data[ragged(starts[new], size)]
            ids, offs = self.merge(self.of_byte[piece], np.append(0, np.cumsum(size)))
            known = np.concatenate([self.known, h[new]])
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.at = np.concatenate([self.at, len(self.ids) + offs[:-1]])[order]
            self.count = np.concatenate([self.count, np.diff(offs)])[order]
            self.begin = np.concatenate([self.begin, len(self.bytes) + np.cumsum(size) - size])[order]
            self.size = np.concatenate([self.size, size])[order]
            self.ids = np.concatenate([self.ids, ids.astype(self.ids.dtype)])
            self.bytes = np.concatenate([self.bytes, piece])
        return np.searchsorted(self.known, h)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of documents and their offsets; special tokens in a text count as themselves."""
        raw = data.tobytes()
        if any(t.encode() in raw for t in self.special):
            return self._with_special(raw, offs)
        return self.plain(data, offs)

    def plain(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Like ``encode``, special tokens being ordinary text."""
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(offs), np.int64)
        parts, at = [], 0
        while at < len(offs) - 1:  # some documents at a time, so that what stands beside each character stays small
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + STRETCH, "right")) - 1)
            a, b, cut = self.pretokens(data[offs[at] : offs[to]].tobytes(), offs[at : to + 1] - offs[at])
            parts.append((a + offs[at], b + offs[at], np.diff(cut)))
            at = to
        starts, ends, count = (np.concatenate(x) for x in zip(*parts))
        owner = np.append(0, np.cumsum(count))
        h = span_hashes(data, starts, ends)
        order = np.argsort(h)
        ordered = h[order]
        fresh = np.append(True, ordered[1:] != ordered[:-1])
        first, which = order[fresh], np.empty(len(h), np.int64)
        which[order] = np.cumsum(fresh) - 1
        place = self.learn(data, starts[first], ends[first], ordered[fresh])
        # a hash names a pre-token only as long as the bytes agree, here and with what the worker remembers
        same = span_equal(data, starts, ends, data, starts[first[which]], ends[first[which]]).all()
        if not same or not span_equal(data, starts[first], ends[first], self.bytes, self.begin[place], self.begin[place] + self.size[place]).all():
            return self._by_bytes(data, starts, ends, owner)
        at = place[which]
        count = self.count[at]
        return self.ids[ragged(self.at[at], count)].astype(np.uint32), np.append(0, np.cumsum(count))[owner]

    def _by_bytes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``plain``, with pre-tokens told apart by their bytes alone, for a block in which two hashes are equal."""
        raw, names = data.tobytes(), {}
        at = np.array([names.setdefault(raw[a:b], len(names)) for a, b in zip(starts.tolist(), ends.tolist())])
        offs = np.append(0, np.cumsum([len(w) for w in names]))
        ids, cut = self.merge(self.of_byte[np.frombuffer(b"".join(names), np.uint8)], offs)
        count = np.diff(cut)[at]
        return ids[ragged(cut[:-1][at], count)].astype(np.uint32), np.append(0, np.cumsum(count))[owner]

    def _with_special(self, raw: bytes, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts between special tokens as documents of one ``plain`` call, with the tokens put in between."""
        find = re.compile(b"|".join(re.escape(t.encode()) for t in sorted(self.special, key=len, reverse=True)))
        names = {t.encode(): i for t, i in self.special.items()}
        cuts, put, last = [], [], []  # (start, end) of each text between, the token behind it, and each document's last one
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
            for m in find.finditer(raw, a, b):
                cuts.append((a, m.start()))
                put.append(names[m[0]])
                a = m.end()
            cuts.append((a, b))
            put.append(-1)
            last.append(len(cuts))
        cut, token = np.array(cuts, np.int64).reshape(-1, 2), np.array(put, np.int64)
        size = cut[:, 1] - cut[:, 0]
        ids, at = self.plain(np.frombuffer(raw, np.uint8)[ragged(cut[:, 0], size)], np.append(0, np.cumsum(size)))
        behind = np.flatnonzero(token >= 0)
        out = np.insert(ids, at[behind + 1], token[behind].astype(np.uint32))
        whole = at + np.append(0, np.cumsum(token >= 0))
        return out, whole[np.append(0, np.array(last, np.int64))]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: their bytes joined, what is not UTF-8 replaced."""
        return self.pool[ragged(self.starts[ids], self.lengths[ids])].tobytes().decode("utf-8", "replace")


def _classes() -> np.ndarray:
    """Letter, number, white space or other, of every code point; from the Unicode categories."""
    out = np.full(0x110000, _OTHER, np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))[0]
        if c == "L":
            out[i] = _LETTER
        elif c == "N":
            out[i] = _NUMBER
    out[list(_WHITE)] = _SPACE
    return out


def encoder(path: str, cache: dict = {}) -> Encoder:  # noqa: B006  one encoder per worker and file
    if path not in cache:
        cache[path] = Encoder(path)
    return cache[path]


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the token ids of every whole text and the text they decode to.

    Null counts as empty and gives no ids; repeated rows are encoded again. ``path`` names the vocabulary file, which
    every executor has; it is never copied.
    """
    path = path or vocabulary_path()

    def run(ids, data, offs):
        enc = encoder(path)
        tokens, at = enc.encode(data, offs)
        rows = [tokens[a:b] for a, b in zip(at, at[1:])]
        return [ids, pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), pa.array(tokens, pa.int32())).cast(pa.list_(pa.int32())), [enc.decode(r) for r in rows]]

    return map_blocks(texts(docs), run, "doc_id long, ids array<int>, decoded string", BYTES)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, hashed where they are made.

    Null and empty texts have no token and the digests of nothing; repeated rows, also of one doc_id, give a row each;
    a text of any length is encoded whole.
    """
    path = path or vocabulary_path()

    def run(ids, data, offs):
        enc = encoder(path)
        tokens, at = enc.encode(data, offs)
        rows = [tokens[a:b] for a, b in zip(at, at[1:])]
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return [ids, np.diff(at), [sha(r.astype("<u4").tobytes()) for r in rows], [sha(enc.decode(r).encode()) for r in rows]]

    return map_blocks(texts(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", BYTES)
