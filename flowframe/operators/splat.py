"""Forward splatting: every pixel takes the displacement of the nearest source pixel after it has moved."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nearest_source(px: np.ndarray, py: np.ndarray, h: int, w: int) -> np.ndarray:
    """For each pixel of an h x w grid, row-major, the index of the nearest point; -1 everywhere without points.

    Points lie inside the image and are binned in unit cells. A pixel looks at rings of cells around its own, until what
    it has found is no farther than the ring: all later points are. Ties go to the least index.
    """
    best = np.full(h * w, -1, np.int64)
    if not len(px):
        return best
    cell = np.floor(py).astype(np.int64) * w + np.floor(px).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    first = np.searchsorted(cell[order], np.arange(h * w + 1))
    dist = np.full(h * w, np.inf)
    todo = np.arange(h * w)
    ring = 0
    while len(todo):
        for dy in range(-ring, ring + 1):
            for dx in range(-ring, ring + 1) if abs(dy) == ring else (-ring, ring):
                y, x = todo // w + dy, todo % w + dx
                inside = (y >= 0) & (y < h) & (x >= 0) & (x < w)
                at, c = todo[inside], (y * w + x)[inside]
                place, end = first[c], first[c + 1]
                while len(at):  # one point of each cell at a time
                    more = place < end
                    at, place, end = at[more], place[more], end[more]
                    i = order[place]
                    d = (px[i] - at % w) * (px[i] - at % w) + (py[i] - at // w) * (py[i] - at // w)
                    nearer = (d < dist[at]) | ((d == dist[at]) & (i < best[at]))
                    dist[at[nearer]], best[at[nearer]] = d[nearer], i[nearer]
                    place = place + 1
        todo = todo[dist[todo] > ring * ring]
        ring += 1
    return best


def forward_splat(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The field seen from where its pixels arrive; pixels that leave the image are dropped, and with none left it is 0.

    Pixels that arrive on the upper or left edge (coordinate 0) count as having left, as do non-finite ones.
    """
    h, w = u.shape
    y, x = np.mgrid[0:h, 0:w]
    px, py = (x + u).ravel(), (y + v).ravel()
    ok = np.flatnonzero((px > 0) & (px < w) & (py > 0) & (py < h))
    near = nearest_source(px[ok], py[ok], h, w)
    if not len(ok):
        return np.zeros_like(u), np.zeros_like(v)
    return u.ravel()[ok][near].reshape(h, w), v.ravel()[ok][near].reshape(h, w)


def splatted(df: DataFrame, id_: str, h: int, w: int) -> DataFrame:
    """(id, y, x, u, v): ``forward_splat`` of each field of pixels; absent pixels have left.

    The pixels of an image are packed into one row, and many images go to Python in one batch.
    """
    kind = df.schema[id_].dataType.simpleString()
    y, x = (a.ravel().astype(np.int32) for a in np.mgrid[0:h, 0:w])

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.column(1):
                part = row.values
                field = np.full((2, h * w), np.nan)
                at = part.field("p").to_numpy()
                field[0, at], field[1, at] = (part.field(c).to_numpy(zero_copy_only=False) for c in "uv")
                out.append(np.stack([a.ravel() for a in forward_splat(*field.reshape(2, h, w))]))
            n = len(out)
            u, v = np.concatenate(out, axis=1) if n else np.empty((2, 0))
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(n), h * w)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.tile(y, n)), pa.array(np.tile(x, n)), pa.array(u), pa.array(v)], [id_, "y", "x", "u", "v"])

    rows = df.groupBy(id_).agg(F.collect_list(F.struct((F.col("y") * w + F.col("x")).cast("int").alias("p"), "u", "v")).alias("s"))
    return rows.mapInArrow(run, f"{id_} {kind}, y int, x int, u double, v double")
