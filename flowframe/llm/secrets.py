"""Secret scan with a recursive decoding worklist.

Each text starts a worklist. A layer is scanned for secrets, then every encoding it holds (percent escapes, Unicode
escapes, base64 also over several lines, and zlib or gzip below base64 or percent escapes) is unwrapped into a new layer, until no layer is new. Within one such run
a layer already seen is not entered again, which ends cycles; every run names the secrets below it, also where runs hold the
same text. A run that does not decode as a whole is searched at all four alignments for what it holds behind a prefix. What
is packed is unpacked in overlapping windows, so a small payload that unpacks to gigabytes takes no more memory than any
other. Every character of a layer knows the span of the original text it came from, by runs of characters.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import re
import zlib
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import blocks, lower, map_blocks, runs, small_batches, texts, tidy

# fixed values: the kinds and their patterns
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX, LEAST_BASE64 = 6, 20, 24, 16

_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST_BASE64)
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)+" % LEAST_BASE64)
MAGIC = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")
_MAGIC = re.compile(b"|".join(re.escape(x) for x in MAGIC))
_PLAIN = re.compile(rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){%d,}" % (LEAST_BASE64 * 3 // 4))
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
#: Characters of a window of unpacked text; windows overlap by OVERLAP, or by the run that they end in, up to LONGEST.
PIECE, OVERLAP, LONGEST = 1 << 18, 4096, 1 << 24
_BREAK = re.compile(r"[^A-Za-z0-9+/_=%.~\\&#;-]")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_PACKED = re.compile(r"(?:%1[fF]%8[bB]|(?:x|%78)(?:%01|\^|%5[eE]|%9[cC]|%[dD][aA]))[A-Za-z0-9._~!*'()/+%-]+")


def found(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets in a plain text, leftmost without overlap within a kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return out + [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]


class Places:
    """Where the characters of a layer come from, in runs: ``at`` the first character of each run, ``a`` its start in the
    original text, and ``b`` the end there of what all characters of the run come from; -1 where each is itself."""

    def __init__(self, at: list[int], a: list[int], b: list[int]):
        self.at, self.a, self.b = at, a, b

    def start(self, i: int) -> int:
        j = bisect_right(self.at, i) - 1
        return self.a[j] + (i - self.at[j] if self.b[j] < 0 else 0)

    def end(self, i: int) -> int:
        """The end of character i."""
        j = bisect_right(self.at, i) - 1
        return self.a[j] + i - self.at[j] + 1 if self.b[j] < 0 else self.b[j]

    def copy(self, lo: int, hi: int, to: "Places", at: int) -> None:
        """Append the runs of characters lo to hi to another layer's, from its character ``at`` on."""
        j = bisect_right(self.at, lo) - 1
        while lo < hi:
            end = min(hi, self.at[j + 1] if j + 1 < len(self.at) else hi)
            to.at.append(at)
            to.a.append(self.start(lo))
            to.b.append(self.b[j])
            at, lo, j = at + end - lo, end, j + 1


@dataclass
class Layer:
    """``new``: starts and ends, in turn, of what the last step decoded; None for all of it."""

    text: str
    path: str
    places: Places
    new: list[int] | None

    def decoded(self, a: int, b: int) -> bool:
        """Whether the last step decoded any of the characters a to b."""
        return self.new is None or bisect_right(self.new, a) % 2 == 1 or bisect_right(self.new, a) < bisect_left(self.new, b)


def _replaced(layer: Layer, name: str, pattern: re.Pattern, decode) -> Layer | None:
    text, new, at, size, places = [], [], 0, 0, Places([], [], [])
    for m in pattern.finditer(layer.text):
        got = decode(m[0])
        if not got:
            continue
        a, b = m.span()
        layer.places.copy(at, a, places, size)
        size += a - at
        text += [layer.text[at:a], got]
        places.at.append(size)
        places.a.append(layer.places.start(a))
        places.b.append(layer.places.end(b - 1))
        new += [size, size + len(got)]
        size, at = size + len(got), b
    if not at:
        return None
    layer.places.copy(at, len(layer.text), places, size)
    return Layer("".join([*text, layer.text[at:]]), name, places, new)


def _percent(s: str) -> str:
    return bytes.fromhex(s.replace("%", "")).decode("utf-8", "replace")


def _escape(s: str) -> str | None:
    if s[0] == "&":
        code = int(s[3:-1], 16) if s[2] in "xX" else int(s[2:-1])
        return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    units = "".join(chr(int(x[1:], 16)) for x in s.split("\\")[1:])
    return units.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def _codec(raw: bytes) -> tuple[str, int]:
    """(codec, length of the byte order mark): UTF-16 if a mark or a zero in half of all pairs says so, else UTF-8."""
    for mark, name in ((b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")):
        if raw[:2] == mark:
            return name, 2
    half = len(raw) // 2
    if half and len(raw) % 2 == 0:
        for at, name in ((1, "utf-16-le"), (0, "utf-16-be")):
            if raw[at::2].count(0) * 2 >= half:
                return name, 0
    return "utf-8", 0


def _is_plain(s: str) -> bool:
    """Hardly any control character."""
    return bool(s) and len(_CONTROL.findall(s)) * 20 <= len(s)


def _inflated(source, first: bytes):
    """The bytes below zlib or gzip in pieces of bounded size, however many there are; raises zlib.error on other bytes."""
    z, rest = zlib.decompressobj(47), first
    while True:
        while rest:
            out = z.decompress(rest, PIECE)
            rest = z.unconsumed_tail
            if out:
                yield out
            if z.eof:
                return
        if (rest := next(source, b"")) == b"":
            raise zlib.error("cut short")


def _joined(source, least: int) -> bytes:
    """At least ``least`` bytes of a source, fewer only at its end."""
    out = b""
    while len(out) < least and (more := next(source, b"")):
        out += more
    return out


def windows(raw: bytes, name: str = "base64"):
    """(path, text) of the text in decoded bytes, below any number of zlib or gzip layers, in windows of about ``PIECE``
    characters that overlap by a run, so that memory does not grow with what a small payload unpacks to.

    A payload of one window counts only if it unpacks to its end and is text; a longer one ends where it stops being so.
    """
    source, path, seen = iter([raw]), name, set()
    try:
        head = next(source, b"")
        while head[:2] in MAGIC:
            path = f"{name}.zlib"
            source = _inflated(source, head)
            head = _joined(source, 64)
            if (mark := hash(head)) in seen:  # what unpacks to itself
                return
            seen.add(mark)
        codec, skip = _codec(head)
        decoder = codecs.getincrementaldecoder(codec)()
        parts, need = [decoder.decode(head[skip:])], PIECE
        while True:
            more = next(source, b"")
            parts.append(decoder.decode(more, not more))
            if more and sum(map(len, parts)) < need:
                continue
            text = "".join(parts)
            if not _is_plain(text):
                return
            yield path, text
            if not more:
                return
            # what follows may belong to a run of characters that began here
            run = _BREAK.search(text[: -LONGEST - 1 : -1])
            parts = [text[-max(OVERLAP, run.start() if run else 0) :]]
            need = max(PIECE, 2 * len(parts[0]))
    except (zlib.error, UnicodeDecodeError):
        return


def _unpacked(raw: bytes, name: str = "base64") -> tuple[str, str] | None:
    """(path, first window) of what is in decoded bytes, if it is text."""
    return next(windows(raw, name), None)


def _bytes(s: str) -> bytes:
    s = s.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _blocks(text: str):
    """(lines, path, bytes, decoded text) of base64 that is broken into lines of one width, the last one possibly shorter."""
    for block in _LINES.finditer(text):
        lines = [(m.start() + block.start(), m.end() + block.start()) for m in _LINE.finditer(block[0])]
        width = [b - a for a, b in lines]
        i = 0
        while i < len(lines):
            j = i + 1
            while j < len(lines) and width[j] == width[i]:
                j += 1
            # the short line may also be the next word of the text
            for end in ([j + 1] if j < len(lines) and width[j] < width[i] else []) + [j]:
                if width[i] >= LEAST_BASE64 and end - i > 1:
                    raw = _bytes("".join(text[a:b] for a, b in lines[i:end]))
                    if got := _unpacked(raw):
                        yield lines[i:end], *got, raw
                        break
            i = j


def _wrapped(layer: Layer):
    """A layer for every block that decodes to text without unpacking: each character stands at the lines it comes from."""
    for lines, path, text, raw in _blocks(layer.text):
        if path != "base64":
            continue
        codec, skip = _codec(raw)
        text = raw[skip:].decode(codec)
        width = np.array([len(c.encode(codec)) for c in sorted(set(text))])
        number = {c: i for i, c in enumerate(sorted(set(text)))}
        ends = skip + np.cumsum(width[[number[c] for c in text]])
        begins = np.append(skip, ends[:-1])
        upto = np.cumsum([b - a for a, b in lines])
        first, last = (np.searchsorted(upto, x, "right") for x in (begins * 8 // 6, (ends * 8 - 1) // 6))
        at = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (last[1:] != last[:-1])))
        a = [layer.places.start(lines[x][0]) for x in first[at].tolist()]
        b = [layer.places.end(lines[x][1] - 1) for x in last[at].tolist()]
        yield Layer(text, "base64", Places(at.tolist(), a, b), None)


def _inside(run: str):
    """(raw bytes, start, end) of what a run of base64 characters holds besides others: text or packed bytes that begin
    behind a prefix or end before other characters, at each of the four ways to read the run."""
    bare = run.rstrip("=")
    for k in range(4):
        raw = _bytes(bare[k : len(bare) - ((len(bare) - k) % 4 == 1)])
        to = lambda i, j: (k + i * 4 // 3, len(run) if j == len(raw) else k - (-j * 4 // 3))  # noqa: B023, E731
        for m in _PLAIN.finditer(raw):
            yield m[0], *to(*m.span())
        for m in _MAGIC.finditer(raw):
            z = zlib.decompressobj(47)
            try:
                if len(z.decompress(raw[m.start() :], 64)) >= LEAST_BASE64 // 2 or z.eof:
                    yield raw[m.start() :], *to(m.start(), len(raw))
            except zlib.error:
                continue


def _runs(layer: Layer):
    """(name, bytes, start, end) of every run that decodes as a whole or in part: base64 of a line, of lines if it unpacks,
    and escaped zlib or gzip."""
    out = []
    for m in _BASE64.finditer(layer.text):
        raw = _bytes(m[0])
        if _unpacked(raw):
            out.append(("base64", raw, *m.span()))
        else:
            # a packed run that goes on in the next line is read as a block
            out += [("base64", x, m.start() + a, m.start() + b) for x, a, b in _inside(m[0]) if _unpacked(x)]
    for lines, path, text, raw in _blocks(layer.text):
        # a first line that unpacks by itself ends there
        if path != "base64" and not _unpacked(_bytes(layer.text[slice(*lines[0])])):
            out.append(("base64", raw, lines[0][0], lines[-1][1]))
    for m in _PACKED.finditer(layer.text) if "%" in layer.text else []:
        escaped = m[0].encode()
        for plus in (b"+", b" "):  # a plus is itself or a space
            raw = unquote_to_bytes(escaped.replace(b"+", plus))
            if (got := _unpacked(raw, "url")) and got[0] != "url":
                out.append(("url", raw, *m.span()))
                break
    for name, raw, a, b in out:
        yield _path(layer.path, name), raw, layer.places.start(a), layer.places.end(b - 1)


def _path(*steps: str) -> str:
    return ".".join(x for x in steps if x)


def _opened(text: str) -> tuple[set[tuple[str, str, int, int]], dict[tuple[bytes, int, int], str]]:
    """(kind, path, start, end) of the secrets below escapes and wrapped base64, and the path of each (bytes, start, end) of ``_runs``."""
    more: set[tuple[str, str, int, int]] = set()
    inner: dict[tuple[bytes, int, int], str] = {}
    seen = {(hash(text), 0, len(text))}
    work = [Layer(text, "", Places([0], [0], [-1]), None)]
    while work:
        layer = work.pop()
        for path, raw, a, b in _runs(layer):
            inner.setdefault((raw, a, b), path)
        for child in (_replaced(layer, "url", _PERCENT, _percent), _replaced(layer, "unicode", _ESCAPE, _escape), *_wrapped(layer)):
            if child is None or (key := (hash(child.text), child.places.start(0), child.places.end(len(child.text) - 1))) in seen:
                continue
            seen.add(key)
            child.path = _path(layer.path, child.path)
            more |= {(kind, child.path, child.places.start(a), child.places.end(b - 1)) for kind, a, b in found(child.text) if child.decoded(a, b)}
            work.append(child)
    return more, inner


def _below(raw: bytes, name: str) -> set[tuple[str, str]]:
    """(kind, path) of every secret in or below decoded bytes: all of it stands at one place, so each payload is entered once."""
    out: set[tuple[str, str]] = set()
    seen, work = {raw}, [(raw, "", name)]
    while work:
        at, above, name = work.pop()
        for path, text in windows(at, name):
            path = _path(above, path)
            more, inner = _opened(text)
            out |= {(kind, path) for kind, *_ in found(text)} | {(kind, _path(path, step)) for kind, step, *_ in more}
            for (got, *_), step in inner.items():
                if got not in seen:
                    seen.add(got)
                    lead, _, last = step.rpartition(".")
                    work.append((got, _path(path, lead), last))
    return out


def spans(text: str) -> list[tuple[str, int, int]]:
    """Every secret of a text: base kinds, and ``kind@encodings`` for those below an encoding; sorted and distinct.

    A text that several runs decode to is searched once, and what it holds is named at each of them.
    """
    below, inner = _opened(text)
    more = {(f"{kind}@{path}", a, b) for kind, path, a, b in below}
    known: dict[tuple[bytes, str], set[tuple[str, str]]] = {}
    for (raw, a, b), path in inner.items():
        lead, _, name = path.rpartition(".")
        if (raw, name) not in known:
            known[raw, name] = _below(raw, name)
        more |= {(f"{kind}@{_path(lead, step)}", a, b) for kind, step in known[raw, name]}
    order = lambda x: (x[1], KINDS.index(x[0].split("@")[0]) + 3 * ("@" in x[0]), x[2], x[0])
    return sorted([*found(text), *more], key=order)


_RUN = np.zeros(256, bool)
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-":
    _RUN[_c] = True


def suspects(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows that can hold a secret: a keyword, a run as long as the shortest encoding, or an escape."""
    s, e, _ = runs(_RUN[data], offs)
    at = [s[e - s >= min(LEAST_BASE64, LEAST_ACCESS, LEAST_HEX)]]
    low = lower(data).tobytes()
    for word in KEYWORDS:
        i, hits = low.find(word), []
        while i >= 0:
            hits.append(i)
            i = low.find(word, i + 1)
        at.append(np.array(hits, np.int64))
    at += [np.flatnonzero((data == 0x25) | (data == 0x5C)), np.flatnonzero((data[:-1] == 0x26) & (data[1:] == 0x23))]
    return np.unique(np.searchsorted(offs, np.concatenate(at), "right") - 1)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every document: structs of kind, start and end in code points of the text.

    Null and empty text have none; repeated rows are scanned again; whole texts are scanned whatever their length.
    """

    def find(ids, data, offs):
        out: list = [[] for _ in range(len(offs) - 1)]
        raw = data.tobytes()
        for d in suspects(data, offs).tolist():
            out[d] = [{"kind": k, "start": a, "end": b} for k, a, b in spans(raw[offs[d] : offs[d + 1]].decode())]
        return [ids, pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]

    return map_blocks(texts(docs), find, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


MARK = "[secret]"


def redacted_text(text: str) -> str:
    out, at = [], 0
    for _, a, b in sorted(spans(text), key=lambda x: (x[1], -x[2])):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], MARK]
        at = b
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by a mark and n_chars brought up to date; null text stays null."""

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            col = batch.column(at)
            filled = pa.RecordBatch.from_arrays([col.fill_null("")], ["text"])
            new = {}
            for row, _, data, offs in blocks(filled):
                raw = data.tobytes()
                for d in suspects(data, offs).tolist():
                    text = raw[offs[d] : offs[d + 1]].decode()
                    if (clean := redacted_text(text)) != text:
                        new[row + d] = clean
            if new:
                mask = np.zeros(batch.num_rows, bool)
                mask[list(new)] = True
                order = [new[i] for i in sorted(new)]
                batch = batch.set_column(at, batch.schema.field(at), pa.compute.replace_with_mask(col, pa.array(mask), pa.array(order, col.type)))
                if (n := batch.schema.get_field_index("n_chars")) >= 0:
                    f = batch.schema.field(n)
                    lengths = pa.array([len(x) for x in order], f.type)
                    batch = batch.set_column(n, f, pa.compute.replace_with_mask(batch.column(n), pa.array(mask), lengths))
            yield batch

    import pyarrow.compute  # noqa: F401  pa.compute is used in the worker

    small_batches(docs.sparkSession)
    return docs.mapInArrow(tidy(run), docs.schema)
