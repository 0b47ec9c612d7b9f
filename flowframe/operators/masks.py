"""Binary motion masks: thresholds, neighbourhood operators, components, unions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import ordering

# fixed values: row widths of the elliptic structuring elements of 3, 7 and 9 pixels
ELLIPSE = {3: (1, 3, 1), 7: (1, 5, 7, 7, 7, 5, 1), 9: (1, 7, 7, 9, 9, 9, 7, 7, 1)}


def element(size: int) -> list[tuple[int, int]]:
    """Offsets (dy, dx) of an elliptic structuring element."""
    r = size // 2
    return [(i - r, dx) for i, w in enumerate(ELLIPSE[size]) for dx in range(-(w // 2), w // 2 + 1)]


def percentile_mask(df: DataFrame, key: str, m: str = "m", floor: float = 1.0, q: float = 10.0, noise: float = 5.0, whole: int = ordering.WHOLE) -> DataFrame:
    """Candidates above ``floor`` that pass the exact q-th percentile of the candidates, or the noise level."""
    cand = F.col(m) > floor
    cut = ordering.quantiles(df.where(cand), key, m, [q / 100], whole).select(key, F.get("quantiles", F.lit(0)).alias("threshold"))
    rows = ordering.beside(df, key, cut).withColumn("threshold", F.coalesce("threshold", F.lit(0.0)))
    return rows.withColumn("mask", (cand & ((F.col(m) > F.col("threshold")) | (F.col(m) > noise))).cast("int"))


def otsu(df: DataFrame, key: str, level: Column) -> DataFrame:
    """(key, threshold): the level of largest between-class variance of a 256-bin histogram, the lowest of equals."""
    hist = df.groupBy(key, level.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    up = W.partitionBy(key).orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    all_ = W.partitionBy(key)
    s = hist.select(key, "bin", F.sum("n").over(up).alias("w0"), F.sum(F.col("n") * F.col("bin")).over(up).alias("s0"), F.sum("n").over(all_).alias("w"), F.sum(F.col("n") * F.col("bin")).over(all_).alias("s"))
    d = F.col("w") * F.col("s0") - F.col("s") * F.col("w0")
    var = F.try_divide(d.cast("double") * d, (F.col("w0") * (F.col("w") - F.col("w0"))).cast("double"))
    best = s.select(key, "bin", F.coalesce(var, F.lit(0.0)).alias("var"))
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc("var"), "bin"))
    return best.withColumn("r", rank).where("r = 1").select(key, F.col("bin").alias("threshold"))


def robust_mask(df: DataFrame, key: str, m: str = "m", floor: float = 1.0) -> DataFrame:
    """``mask``: above the floor and above Otsu's threshold of the min-max levels; all zero on a static field."""
    rows = ordering.beside(df, key, df.groupBy(key).agg(F.min(m).alias("__lo"), F.max(m).alias("__hi")))
    lo, hi = F.col("__lo"), F.col("__hi")
    level = F.when(hi > lo, F.floor((F.col(m) - lo) / F.nullif(hi - lo, F.lit(0.0)) * 255)).otherwise(0).cast("int")
    rows = rows.withColumn("level", level)
    hit = (hi >= floor) & (F.col("level") > F.col("threshold")) & (F.col(m) > floor)
    return ordering.beside(rows, key, otsu(rows, key, F.col("level"))).withColumn("mask", hit.cast("int")).drop("__lo", "__hi")


def _slid(df: DataFrame, key: str, size: int, how) -> DataFrame:
    """Least or largest value under the structuring element, by windows that slide along rows, then along columns.

    A row of the element is no wider than the rows nearer to its centre, so the element is the union of one rectangle for
    each of its widths: a window of that width in each row, and one over the rows that are as wide.
    """
    r = size // 2
    tall = {w: max(abs(i - r) for i, v in enumerate(ELLIPSE[size]) if v >= w) for w in ELLIPSE[size]}
    row, col = W.partitionBy(key, "y").orderBy("x"), W.partitionBy(key, "x").orderBy("y")
    wide = df.select(key, "y", "x", *[how("mask").over(row.rangeBetween(-(w // 2), w // 2)).alias(f"m{w}") for w in tall])
    parts = [how(f"m{w}").over(col.rangeBetween(-n, n)) for w, n in tall.items()]
    least = F.least if how is F.min else F.greatest
    return wide.select(key, "y", "x", (least(*parts) if len(parts) > 1 else parts[0]).alias("mask"))


def opened(df: DataFrame, key: str, size: int) -> DataFrame:
    """Erosion, then dilation of the pixels of ``df``; what is not among them never decides."""
    return _slid(_slid(df, key, size, F.min), key, size, F.max)


def closed(df: DataFrame, key: str, size: int) -> DataFrame:
    """Dilation, then erosion."""
    return _slid(_slid(df, key, size, F.max), key, size, F.min)


def morph(mask: np.ndarray, size: int, dilate: bool) -> np.ndarray:
    """One dilation or erosion of a packed mask by shifts."""
    h, w = mask.shape
    r = size // 2
    p = np.pad(mask, r, constant_values=0 if dilate else 1)
    parts = [p[r + dy : r + dy + h, r + dx : r + dx + w] for dy, dx in element(size)]
    return (np.maximum if dilate else np.minimum).reduce(parts)


def labels(mask: np.ndarray) -> np.ndarray:
    """8-connected components, each named by its least pixel + 1; 0 off the mask.

    Runs of set pixels in a row are nodes, linked to the runs of the next row that they touch. Each round hangs the larger
    root of every link below the smaller one and shortens all paths, so rounds grow with the logarithm of the runs.
    """
    h, w = mask.shape
    edge = np.diff(np.pad((mask > 0).astype(np.int8), ((0, 0), (1, 1))), axis=1)
    y, start = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    n, wide = len(y), w + 2
    first = np.searchsorted(y * wide + end, (y + 1) * wide + start, "left")
    count = np.maximum(np.searchsorted(y * wide + start, (y + 1) * wide + end, "right") - first, 0)
    a = np.repeat(np.arange(n), count)
    b = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(a))
    root = np.arange(n)
    while len(a):
        p, q = root[a], root[b]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    out = np.zeros(h * w, np.int64)
    size = end - start
    at = np.repeat(y * w + start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    out[at] = np.repeat((y * w + start)[root] + 1, size)  # runs are in order of pixels, so the least run holds the least pixel
    return out.reshape(h, w)


def large_components(df: DataFrame, key: str, h: int, w: int, min_area: int) -> DataFrame:
    """(key, y, x, label, area) of the pixels in components of more than ``min_area`` pixels.

    The set pixels of an image are packed into one row, and many images go to Python in one batch.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            keys, out = [], [np.empty((0, 4), np.int32)]
            for n, on in enumerate(batch.column(1)):
                mask = np.zeros(h * w, np.uint8)
                mask[on.values.to_numpy()] = 1
                lab = labels(mask.reshape(h, w)).ravel()
                at = np.flatnonzero(lab)
                area = np.bincount(lab)[lab[at]]
                at, area = at[area > min_area], area[area > min_area]
                keys.append(np.full(len(at), n))
                out.append(np.stack([at // w, at % w, lab[at], area], axis=1).astype(np.int32))
            cols = np.concatenate(out)
            names = batch.column(0).take(pa.array(np.concatenate(keys).astype(np.int64) if keys else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([names, *(pa.array(np.ascontiguousarray(c)) for c in cols.T)], [key, "y", "x", "label", "area"])

    on = df.where("mask > 0").groupBy(key).agg(F.collect_list((F.col("y") * w + F.col("x")).cast("int")).alias("on"))
    return on.mapInArrow(run, f"{key} {kind}, y int, x int, label int, area int")


def united(*masks: DataFrame, on: list[str]) -> DataFrame:
    """Pixel-wise union of masks (on, mask)."""
    out = masks[0]
    for m in masks[1:]:
        out = out.unionByName(m)
    return out.groupBy(*on).agg(F.max("mask").alias("mask"))


def overlaid(image: Column, colour: float, mask: Column) -> Column:
    """Half the image, half the colour, where the mask is on."""
    return image * (1 - F.lit(0.5) * mask) + F.lit(colour) * F.lit(0.5) * mask
