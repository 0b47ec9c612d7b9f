"""Binary formats of displacement fields, from and to bytes; no library beyond NumPy is needed."""

from __future__ import annotations

import io
import re
import struct
import zlib

import numpy as np

# fixed values: the tag of the .flo format and the signature of PNG
FLO_TAG = 202021.25
PNG = b"\x89PNG\r\n\x1a\n"


def read_flo(raw: bytes) -> np.ndarray | None:
    """(h, w, 2) float32; null on a wrong tag."""
    if len(raw) < 12 or struct.unpack("<f", raw[:4])[0] != FLO_TAG:
        return None
    w, h = struct.unpack("<ii", raw[4:12])
    return np.frombuffer(raw, "<f4", 2 * w * h, 12).reshape(h, w, 2)


def write_flo(field: np.ndarray) -> bytes:
    h, w = field.shape[:2]
    return struct.pack("<fii", FLO_TAG, w, h) + np.ascontiguousarray(field, "<f4").tobytes()


def read_pfm(raw: bytes) -> np.ndarray:
    """(h, w) or (h, w, 3), top row first; a negative scale means little endian."""
    m = re.match(rb"(PF|Pf)\s+(\d+)\s+(\d+)\s+(-?[0-9.eE+]+)\s", raw)
    if not m:
        raise ValueError("not a PFM file")
    w, h, n = int(m[2]), int(m[3]), 3 if m[1] == b"PF" else 1
    data = np.frombuffer(raw, "<f4" if float(m[4]) < 0 else ">f4", w * h * n, m.end())
    return data.reshape((h, w, n) if n == 3 else (h, w))[::-1].astype(np.float32)


def read_png(raw: bytes) -> np.ndarray:
    """(h, w) or (h, w, channels) of uint8 or uint16: a PNG of 8 or 16 bits without palette and interlace."""
    if raw[:8] != PNG:
        raise ValueError("not a PNG file")
    at, idat, head = 8, [], b""
    while at < len(raw):
        n, kind = struct.unpack(">I", raw[at : at + 4])[0], raw[at + 4 : at + 8]
        body = raw[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = body
        elif kind == b"IDAT":
            idat.append(body)
        at += 12 + n
    w, h, depth, colour, _, _, lace = struct.unpack(">IIBBBBB", head)
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if depth not in (8, 16) or channels is None or lace:
        raise ValueError("only 8 or 16 bits without palette and interlace are read")
    step = channels * depth // 8
    rows = np.frombuffer(zlib.decompress(b"".join(idat)), np.uint8).reshape(h, 1 + step * w)
    out = np.zeros((h + 1, step * w), np.uint8)
    for y in range(h):
        kind, line, up = rows[y, 0], rows[y, 1:], out[y]
        if kind == 0:
            out[y + 1] = line
        elif kind == 1:
            out[y + 1] = np.cumsum(line.reshape(w, step), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            out[y + 1] = line + up
        else:
            out[y + 1] = _unfiltered(int(kind), line.tolist(), up.tolist(), step)
    image = out[1:].view(">u2").astype(np.uint16) if depth == 16 else out[1:]
    return image.reshape((h, w) if channels == 1 else (h, w, channels))


def _unfiltered(kind: int, line: list[int], up: list[int], step: int) -> list[int]:
    """A line predicted by the mean of left and upper byte (3), or by the nearest of left, upper and corner to their plane (4)."""
    cur, corner = [0] * step + line, [0] * step + up
    for i, b in enumerate(up):
        a = cur[i]
        if kind == 3:
            guess = (a + b) >> 1
        else:
            c = corner[i]
            to_a, to_b, to_c = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = a if to_a <= to_b and to_a <= to_c else b if to_b <= to_c else c
        cur[i + step] = (cur[i + step] + guess) & 255
    return cur[step:]


def write_png(image: np.ndarray) -> bytes:
    """(h, w) or (h, w, 3) of uint8 or uint16."""
    h, w = image.shape[:2]
    depth = 8 * image.dtype.itemsize
    body = np.ascontiguousarray(image.astype(f">u{image.dtype.itemsize}")).view(np.uint8).reshape(h, -1)
    rows = np.concatenate([np.zeros((h, 1), np.uint8), body], axis=1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", w, h, depth, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return PNG + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def write_png_bytes(image: np.ndarray) -> bytes:
    """Any whole numbers from 0 to 255 as an image of 8 bits."""
    return write_png(image.astype(np.uint8))


def from_disparity(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Field (-disparity, 0) and validity of 16-bit values of 256 steps a pixel; 0 is unknown."""
    d = raw.astype(np.float32) / 256
    return np.dstack([-d, np.zeros_like(d)]), d > 0


def read_pnm(raw: bytes) -> np.ndarray:
    """(h, w) or (h, w, 3) of a binary PGM or PPM of 8 bits."""
    m = re.match(rb"P([56])(?:\s+|#[^\n]*\n)+(\d+)(?:\s+|#[^\n]*\n)+(\d+)(?:\s+|#[^\n]*\n)+(\d+)\s", raw)
    if not m or int(m[4]) > 255:
        raise ValueError("not a binary PGM or PPM file of 8 bits")
    w, h, n = int(m[2]), int(m[3]), 3 if m[1] == b"6" else 1
    return np.frombuffer(raw, np.uint8, w * h * n, m.end()).reshape((h, w, n) if n == 3 else (h, w))


def three_bytes(image: np.ndarray) -> np.ndarray:
    """(h, w, 3) of uint8: gray repeated, alpha dropped, 16 bits cut to 8."""
    a = (image >> 8).astype(np.uint8) if image.dtype == np.uint16 else image
    a = a[..., None] if a.ndim == 2 else a
    return np.repeat(a[..., :1], 3, axis=2) if a.shape[2] < 3 else np.ascontiguousarray(a[..., :3])


def from_kitti(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Field (h, w, 2) and validity of 16-bit values: 64 steps a pixel around 2**15."""
    return (raw[..., :2].astype(np.float32) - 2**15) / 64, raw[..., 2] > 0


def to_kitti(field: np.ndarray) -> np.ndarray:
    return np.dstack([64.0 * field + 2**15, np.ones(field.shape[:2])]).astype(np.uint16)


def read_npz(raw: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    """(2, h, w) field and the covisibility if there is one."""
    with np.load(io.BytesIO(raw)) as z:
        return z["flow"], z["covisibility"] if "covisibility" in z else None


def read_field_valid(path: str, raw: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    """(h, w, 2) of a file by its extension, and the validity or covisibility of its pixels where the format has one."""
    kind = path.rpartition(".")[2].lower()
    if kind == "flo":
        field = read_flo(raw)
        if field is None:
            raise ValueError("not a FLO file")
        return field, None
    if kind == "pfm":
        x = read_pfm(raw)
        return (x[..., :2] if x.ndim == 3 else np.dstack([x, np.zeros_like(x)])), None
    if kind == "png":
        image = read_png(raw)
        return (from_disparity if image.ndim == 2 else from_kitti)(image)
    if kind == "npz":
        flow, seen = read_npz(raw)
        return np.moveaxis(flow, 0, -1), seen
    if kind in ("npy", "bin", "raw"):
        return np.load(io.BytesIO(raw)), None
    raise ValueError("unknown format")
