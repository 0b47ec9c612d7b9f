"""Holes of packed fields, filled from the valid pixels around them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Of points on one circle, neighbours in a column come before those in a row: heights are y*y + x*x with x*x a little longer.
TIE, SLANT = 1e-6, 1e-7


def height(y, x):
    """The paraboloid whose lower hull over the points is their Delaunay triangulation, tilted so that it is unique."""
    return y * y + (1 + TIE) * x * x + SLANT * x * y


#: A pixel is looked up a little beside itself, where no line between two pixels passes; the sides are tried in turn.
BESIDE = [(1e-5, 0.618034e-5), (-1e-5, -0.618034e-5), (1e-5, -0.618034e-5), (-1e-5, 0.618034e-5)]


def _weights(y: np.ndarray, x: np.ndarray) -> np.ndarray | None:
    """Barycentric weights of the origin in a triangle; null if the triangle is flat."""
    det = (y[1] - y[0]) * (x[2] - x[0]) - (y[2] - y[0]) * (x[1] - x[0])
    if abs(det) < 1e-9:
        return None
    a, b = (y[1] * x[2] - y[2] * x[1]) / det, (y[2] * x[0] - y[0] * x[2]) / det
    return np.array([a, b, 1 - a - b])


def _around(y: np.ndarray, x: np.ndarray) -> list[int] | None:
    """Three of the points with the origin between them, if there are any: the nearest one, and its neighbours across."""
    turn = np.arctan2(y, x)
    a = int((y * y + x * x).argmin())
    off = (turn - turn[a]) % (2 * np.pi)
    left, right = np.flatnonzero((off > 0) & (off < np.pi)), np.flatnonzero(off > np.pi)
    if not len(left) or not len(right):
        return None
    at = [a, int(left[off[left].argmax()]), int(right[off[right].argmin()])]
    wt = _weights(y[at], x[at])
    return at if wt is not None and wt.min() > 0 else None


def triangle(y: np.ndarray, x: np.ndarray) -> tuple[list[int], np.ndarray] | None:
    """The Delaunay triangle of the points that holds the origin, and its weights; null outside their hull.

    From any triangle around the origin, the point that lies deepest below its plane on the paraboloid takes a corner's
    place, until none lies below: each step lowers the paraboloid's value over the origin.
    """
    for dy, dx in BESIDE:
        u, v = y - dy, x - dx
        at = _around(u, v)
        if at is not None:
            break
    else:
        return None
    z = height(u, v)
    while True:
        plane = np.linalg.solve(np.column_stack([u[at], v[at], np.ones(3)]), z[at])
        below = z - (plane[0] * u + plane[1] * v + plane[2])
        below[at] = 0
        d = int(below.argmin())
        best = None
        if below[d] < -1e-9:
            for i in range(3):
                to = [d if j == i else at[j] for j in range(3)]
                wt = _weights(u[to], v[to])
                if wt is not None and wt.min() > 0 and (best is None or wt @ z[to] < best[0]):
                    best = wt @ z[to], to
        if best is None:
            return at, _weights(y[at], x[at])
        at = best[1]


def filled(planes: list[np.ndarray], valid: np.ndarray) -> list[np.ndarray]:
    """Planes (h, w) with the invalid pixels linear over the Delaunay triangle of valid ones that they lie in, 0 outside all.

    A triangle around an invalid pixel has corners next to invalid pixels only, as its circle holds no valid one. Corners are
    looked for in a window that doubles until the triangle's circle lies within it.
    """
    h, w = valid.shape
    gone = np.pad(~valid, 1)
    near = np.zeros((h, w), bool)
    for a in range(3):
        for b in range(3):
            near |= gone[a : a + h, b : b + w]
    ring = valid & near
    out = [np.where(valid, p, 0.0) for p in planes]
    for py, px in zip(*np.nonzero(~valid)):
        reach = 2
        while True:
            y0, x0 = max(0, py - reach), max(0, px - reach)
            y, x = np.nonzero(ring[y0 : py + reach + 1, x0 : px + reach + 1])
            y, x = y + y0, x + x0
            found = triangle((y - py).astype(float), (x - px).astype(float)) if len(y) > 2 else None
            all_ = reach >= max(h, w)
            if found is not None and not all_:
                p, q = (y[found[0]] - py).astype(float), (x[found[0]] - px).astype(float)
                m = np.linalg.solve(2 * np.array([[p[1] - p[0], q[1] - q[0]], [p[2] - p[0], q[2] - q[0]]]), [p[1] ** 2 + q[1] ** 2 - p[0] ** 2 - q[0] ** 2, p[2] ** 2 + q[2] ** 2 - p[0] ** 2 - q[0] ** 2])
                radius = np.hypot(p[0] - m[0], q[0] - m[1])
                found = found if max(abs(m[0]), abs(m[1])) + radius < reach + 0.5 else None
            if found is not None or all_:
                break
            reach *= 2
        if found is not None:
            at, wt = found
            for o, p in zip(out, planes):
                o[py, px] = wt @ p[y[at], x[at]]
    return out


def without_holes(df: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """``df`` (key, h, w, valid, parts) of packed row-major fields with the holes of ``parts`` filled.

    A pixel is a hole where ``valid`` is null, not above 0.5, or a part's value is null or not finite; each field is one row.
    """
    kinds = dict(df.dtypes)
    names = [key, "h", "w", *parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plane = lambda c, h, w: np.array([np.nan if x is None else float(x) for x in c.as_py()], float).reshape(h, w)
        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: batch.column(k)[i] for k, n in enumerate([*names, "valid"])}
                h, w = r["h"].as_py(), r["w"].as_py()
                values = [plane(r[p], h, w) for p in parts]
                good = plane(r["valid"], h, w) > 0.5
                for v in values:
                    good &= np.isfinite(v)
                done = filled([np.where(good, v, 0.0) for v in values], good)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([h], pa.int32()), pa.array([w], pa.int32()), *[pa.array([d.ravel()], pa.list_(pa.float64())) for d in done]], names=names)

    rows = df.select(key, df["h"].cast("int"), df["w"].cast("int"), *parts, "valid")
    return rows.mapInArrow(run, f"`{key}` {kinds[key]}, h int, w int, " + ", ".join(f"`{p}` array<double>" for p in parts))
