"""External induced sorting of the suffixes of one shard, with disk-backed queues of (suffix, common prefix) tuples.

Suffixes are classified by whether they are smaller or larger than their successor. Leftmost-smaller (LMS) suffixes are
sorted first: their substrings by one induction, then, where names repeat, by sorting the string of names, which is induced
in the same way as long as it is larger than the memory given; all others are induced from them. An induction meets
suffixes in ascending (then descending) order and puts each suffix's predecessor into the queue of its first symbol, so it
needs no comparison: the queues are a monotone priority queue. With each suffix goes the length of the prefix that it
shares with the one before it: a pushed suffix shares one symbol more than the least of what was met since the last push
to its queue. Common prefixes are found by comparison only between LMS suffixes and where a bucket turns from larger to
smaller ones.

Queues hold a bounded number of bytes and write the rest to an unnamed scratch file of the task, as Spark spills do; text,
types and names lie in memory-mapped scratch files, so a shard may be far larger than ``memory``.
"""

from __future__ import annotations

import heapq
import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

#: Bytes that one sort works in: a sixteenth for the tuples held by queues; strings of names are sorted in memory below it.
MEMORY = 96 << 20
TUPLE = np.dtype([("at", "<u4"), ("common", "<i2")])
_NAME_BYTES = 40


def scratch(n: int, dtype) -> np.ndarray:
    """n items in a scratch file that goes with the array."""
    if not n:
        return np.empty(0, dtype)
    file = tempfile.TemporaryFile()
    file.truncate(n * np.dtype(dtype).itemsize)
    return np.asarray(np.memmap(file, dtype, "r+", shape=(n,)))


class Queues:
    """A queue of tuples for each symbol; what is beyond ``limit`` bytes in all lies in one scratch file."""

    def __init__(self, limit: int):
        self.limit, self.bytes, self.spills = limit, 0, 0
        self.held: dict[int, deque] = {}
        self.gone: dict[int, deque] = {}
        self.file, self.end = None, 0
        self.symbols: list[int] = []

    def push(self, symbols: np.ndarray, tuples: np.ndarray) -> None:
        """Tuples in order of arrival, each to the queue of its symbol."""
        if not len(tuples):
            return
        if (symbols[1:] < symbols[:-1]).any():
            order = np.argsort(symbols, kind="stable")
            symbols, tuples = symbols[order], tuples[order]
        first = np.append(0, np.flatnonzero(symbols[1:] != symbols[:-1]) + 1)
        for c, a, b in zip(symbols[first].tolist(), first.tolist(), [*first[1:].tolist(), len(tuples)]):
            self.put(c, tuples[a:b])

    def put(self, c: int, tuples: np.ndarray) -> None:
        if c not in self.held:
            self.held[c] = deque()
            if c not in self.gone:
                heapq.heappush(self.symbols, c)
        self.held[c].append(tuples)
        self.bytes += tuples.nbytes
        if self.bytes > self.limit:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(self.end)
        for c, parts in self.held.items():
            x = np.concatenate(parts) if len(parts) > 1 else parts[0]
            self.file.write(x.tobytes())
            self.gone.setdefault(c, deque()).append((self.end, len(x)))
            self.end += x.nbytes
        self.held, self.bytes, self.spills = {}, 0, self.spills + 1

    def _read(self, place: tuple[int, int]) -> np.ndarray:
        self.file.seek(place[0])
        return np.frombuffer(self.file.read(place[1] * TUPLE.itemsize), TUPLE)

    def pop(self, c: int, last: bool = False) -> np.ndarray | None:
        """The first (or last) stretch of a queue: one that was written, or all that is held; None if it is empty."""
        for of in (self.held, self.gone) if last else (self.gone, self.held):
            if c in of and of is self.gone:
                x = of[c].pop() if last else of[c].popleft()
                if not of[c]:
                    del of[c]
                return self._read(x)
            if c in of:
                parts = of.pop(c)
                x = np.concatenate(parts) if len(parts) > 1 else parts[0]
                self.bytes -= x.nbytes
                return x
        return None

    def least(self) -> int | None:
        """The least symbol whose queue is not empty."""
        while self.symbols and self.symbols[0] not in self.held and self.symbols[0] not in self.gone:
            heapq.heappop(self.symbols)
        return self.symbols[0] if self.symbols else None


class String:
    """A string of symbols and the types of its suffixes, in scratch files; ``memory`` bytes are worked in."""

    def __init__(self, symbols: np.ndarray, memory: int):
        self.n, self.memory = len(symbols), memory
        self.raw = scratch(self.n + 8 // symbols.dtype.itemsize, symbols.dtype)
        self.raw[: self.n] = symbols
        self.a = np.asarray(self.raw[: self.n])
        self.see = np.ndarray((self.n,), "<u8", self.raw, strides=(1,)) if symbols.dtype == np.uint8 else None
        self.step = max(1024, memory // 256)
        self.smaller = scratch(self.n, bool)
        after, larger_end = False, True
        for a in range((self.n - 1) // self.step * self.step, -1, -self.step):
            x = self.a[a : a + self.step + 1]
            m = min(self.step, self.n - a)
            diff = np.zeros(m, np.int8)
            diff[: len(x) - 1] = (x[1:] > x[:-1]).astype(np.int8) - (x[1:] < x[:-1])
            known = np.flatnonzero(diff)
            at = np.searchsorted(known, np.arange(m))
            self.smaller[a : a + m] = np.where(at < len(known), diff[known[np.minimum(at, len(known) - 1)]] > 0, after) if len(known) else after
            after, larger_end = bool(self.smaller[a]), False

    def lms(self) -> np.ndarray:
        parts = [np.flatnonzero(self.smaller[a : a + self.step] & ~self.smaller[a - 1 : a - 1 + min(self.step, self.n - a)]) + a for a in range(1, self.n, self.step)]
        total = sum(map(len, parts))
        out = scratch(total, np.uint32)
        if total:
            out[:] = np.concatenate(parts)
        return out

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray | int) -> np.ndarray:
        """Length of the common prefix of each two suffixes, at most ``most``."""
        out, width = np.zeros(len(a), np.int64), 8 if self.see is not None else 1
        see = self.see if self.see is not None else self.a
        most = np.minimum(most, self.n - np.maximum(a, b))
        left = np.flatnonzero(most > 0)
        while len(left):
            x = see[a[left] + out[left]] ^ see[b[left] + out[left]]
            ends = x != 0
            if width == 8:
                y = x[ends]
                out[left[ends]] += np.log2((y & (~y + np.uint64(1))).astype(float)).astype(np.int64) >> 3
            left = left[~ends]
            out[left] += width
            left = left[out[left] < most[left]]
        return np.minimum(out, most)


def _range_min(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(x[lo..hi]) of each range, by a table of minima over powers of two."""
    level = np.log2(hi - lo + 1).astype(np.int64)
    out = np.empty(len(lo), x.dtype)
    t, j = x, 0
    while True:
        at = np.flatnonzero(level == j)
        out[at] = np.minimum(t[lo[at]], t[hi[at] + 1 - (1 << j)])
        if j == (int(level.max()) if len(level) else 0):
            return out
        t = np.minimum(t[: -(1 << j)], t[1 << j :])
        j += 1


class _Sender:
    """Pushes predecessors of processed suffixes, with their common prefixes if ``clip`` is given."""

    def __init__(self, s: String, queues: Queues, want: bool, clip: int | None):
        self.s, self.queues, self.want, self.clip = s, queues, want, clip
        self.since = np.full(256, -1, np.int16) if clip else None

    def send(self, batch: np.ndarray) -> None:
        at = batch["at"].astype(np.int64)
        sel = np.flatnonzero(at > 0)
        sel = sel[self.s.smaller[at[sel] - 1] == self.want]
        p = at[sel] - 1
        symbol = self.s.a[p]
        order = np.argsort(symbol, kind="stable")
        y, i = symbol[order], sel[order]
        out = np.empty(len(p), TUPLE)
        out["at"] = p[order]
        if self.clip is None:
            out["common"] = 0
        else:
            c = batch["common"]
            least = c.min()
            if len(i):
                new = np.append(True, y[1:] != y[:-1])
                value = _range_min(c, np.where(new, 0, np.append(0, i[:-1] + 1)), i)
                value[new] = np.minimum(value[new], self.since[y[new]])
                out["common"] = np.minimum(value + 1, self.clip)
            np.minimum(self.since, least, out=self.since)
            if len(i):
                tail = np.append(np.minimum.accumulate(c[::-1])[::-1], np.int16(32767))
                last = np.append(new[1:], True)
                self.since[y[last]] = tail[i[last] + 1]
        self.queues.push(y, out)


def _induced(s: String, seeds: np.ndarray, common: np.ndarray | None, clip: int | None) -> Iterator[np.ndarray]:
    """All suffixes in descending order, as stretches of tuples that hold what each shares with the one before it here.

    ``seeds`` are the LMS suffixes in order, or in any order within a symbol where only their substrings count.
    """
    limit = s.memory // 16
    first, larger, queue = Queues(limit), Queues(limit), Queues(limit)
    for a in range(0, len(seeds), s.step):
        x = np.empty(len(seeds[a : a + s.step]), TUPLE)
        x["at"] = seeds[a : a + s.step]
        x["common"] = 0 if common is None else common[a : a + s.step]
        first.push(s.a[x["at"]], x)
    # before the end there is nothing: the last suffix is the least of its symbol
    queue.put(int(s.a[s.n - 1]), np.array([(s.n - 1, 0)], TUPLE))
    out = _Sender(s, queue, False, clip)
    if clip:
        out.since[s.a[s.n - 1]] = 32767
    turn = lambda a, b: 0 if a is None or clip is None else int(s.common(np.array([a]), np.array([b]), clip)[0])
    while (c := min((x for x in (queue.least(), first.least()) if x is not None), default=None)) is not None:
        last = None
        while (batch := queue.pop(c)) is not None:
            larger.put(c, batch)
            out.send(batch)
            last = int(batch["at"][-1])
        begin = True
        while (batch := first.pop(c)) is not None:
            if begin:
                batch = batch.copy()
                batch["common"][0] = turn(last, int(batch["at"][0]))
                begin = False
            out.send(batch)
    down = Queues(limit)
    out = _Sender(s, down, True, clip)
    larger.symbols = [-x for x in {*larger.held, *larger.gone}]
    heapq.heapify(larger.symbols)
    todo = larger.symbols
    met = {-x for x in todo}
    while True:
        for c in {*down.held, *down.gone} - met if len(down.symbols) else ():
            met.add(c)
            heapq.heappush(todo, -c)
        down.symbols = []
        if not todo:
            return
        c = -heapq.heappop(todo)
        met.discard(c)
        last = None
        while (batch := down.pop(c)) is not None:
            yield batch
            out.send(batch)
            last = int(batch["at"][-1])
        share = None
        while (batch := larger.pop(c, last=True)) is not None:
            back = batch[::-1].copy()
            back["common"][1:] = batch["common"][:0:-1]
            back["common"][0] = turn(last, int(batch["at"][-1])) if share is None else share
            share = batch["common"][0]
            yield back
            out.send(back)


def _by_doubling(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names by their first ``depth`` symbols at least, in memory.

    The rank of a suffix is the first place of its group of equals; only groups of two and more are sorted again.
    """
    names, n, k = np.asarray(names, np.int64), len(names), 1
    order = np.argsort(names)
    slots, y = np.arange(n), names[order]
    rank = np.empty(n, np.int64)
    while True:
        new = np.append(True, y[1:] != y[:-1])
        head = np.flatnonzero(new)
        rank[order[slots]] = slots[head[np.cumsum(new) - 1]]
        many = np.repeat(np.diff(np.append(head, len(y))) > 1, np.diff(np.append(head, len(y))))
        slots = slots[many]
        if k >= depth or not len(slots):
            return order
        at = order[slots]
        after = np.where(at + k < n, rank[np.minimum(at + k, n - 1)] + 1, 0)
        y = rank[at] * (n + 1) + after
        again = np.argsort(y)
        order[slots], y = at[again], y[again]
        k *= 2


def _ordered_lms(s: String, lms: np.ndarray, depth: int) -> np.ndarray:
    """The LMS suffixes in order of their first ``depth`` symbols at least."""
    m = len(lms)
    name, current, before = scratch(m, np.uint32), 0, None
    for batch in _induced(s, lms, None, None):
        at = batch["at"][s.smaller[batch["at"]]]
        at = at[at > 0]
        at = at[~s.smaller[at - np.uint32(1)]]
        if not len(at):
            continue
        place, at = np.searchsorted(lms, at), at.astype(np.int64)
        # equal LMS substrings, from one LMS position to the next, have one name
        stop = np.where(place + 1 < m, lms[np.minimum(place + 1, m - 1)], s.n - 1).astype(np.int64)
        size = stop - at + 1
        prev, prev_size = (np.append([x[0] if before else 0], y[:-1]) for x, y in ((before and (before[0],), at), (before and (before[1],), size)))
        same = size == prev_size
        same[same] = s.common(prev[same], at[same], size[same]) == size[same]
        if before is None:
            same[0] = True
        number = current + np.cumsum(~same)
        name[place], current, before = number, int(number[-1]), (int(at[-1]), int(size[-1]))
    name = current - np.asarray(name) if m * _NAME_BYTES <= s.memory else _flipped(name, current, s.step)
    if current + 1 == m:
        order = scratch(m, np.uint32)
        order[name] = np.arange(m, dtype=np.uint32)
    elif m * _NAME_BYTES <= s.memory or m < 1024:
        order = _by_doubling(name, depth)
    else:
        order = _order(String(name, s.memory), depth)
    return lms[order]


def _flipped(name: np.ndarray, top: int, step: int) -> np.ndarray:
    for a in range(0, len(name), step):
        name[a : a + step] = top - name[a : a + step]
    return name


def _order(s: String, depth: int) -> np.ndarray:
    """All positions in order, in a scratch file."""
    lms = s.lms()
    seeds = _ordered_lms(s, lms, depth) if len(lms) else lms
    out, end = scratch(s.n, np.uint32), s.n
    for batch in _induced(s, seeds, None, None):
        out[end - len(batch) : end] = batch["at"][::-1]
        end -= len(batch)
    return out


def suffix_order(text: np.ndarray, clip: int, memory: int = MEMORY) -> Iterator[np.ndarray]:
    """The suffixes of bytes ``text`` in descending order of their first ``clip`` bytes, as stretches of tuples.

    ``common`` is the length of the prefix that a suffix shares with the one before it in this order, at most ``clip``.
    """
    s = String(np.asarray(text, np.uint8), memory)
    if not s.n:
        return
    lms = s.lms()
    seeds = _ordered_lms(s, lms, clip // 2 + 1) if len(lms) else lms  # LMS suffixes are two bytes apart at least
    common = scratch(len(seeds), np.int16)
    for a in range(0, len(seeds), s.step):
        x = np.asarray(seeds[max(0, a - 1) : a + s.step], np.int64)
        got = s.common(x[:-1], x[1:], clip)
        common[a + len(seeds[a : a + s.step]) - len(got) : a + s.step] = got
    yield from _induced(s, seeds, common, clip)


def longest_repeats(text: np.ndarray, starts: np.ndarray, clip: int, memory: int = MEMORY) -> np.ndarray:
    """For each position the longest prefix, up to ``clip``, that a suffix at another start has too; 0 where no start is.

    ``starts`` is a boolean for each byte; a common prefix may run beyond the part that it starts in.
    """
    best = scratch(len(text), np.int16)
    last, least = None, np.int16(32767)
    for batch in suffix_order(text, clip, memory):
        at, c = batch["at"].astype(np.int64), batch["common"]
        is_start = starts[at]
        i = np.flatnonzero(is_start)
        if not len(i):
            least = min(least, c.min())
            continue
        shared = _range_min(c, np.append(0, i[:-1] + 1), i)
        shared[0] = min(shared[0], least) if last is not None else 0
        p = at[i]
        best[p] = np.maximum(best[p], shared)
        before = np.append(p[0] if last is None else last, p[:-1])
        np.maximum.at(best, before, shared)
        last, least = int(p[-1]), c[i[-1] + 1 :].min() if i[-1] + 1 < len(c) else np.int16(32767)
    return best
