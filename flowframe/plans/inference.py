"""Estimates of image pairs: an estimator wrapped in scaling, padding and blended tiles, and evaluation by dataset and pass."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics
from ..operators.imaging import bell, resized, tiles


class Wrapped:
    """Estimates at another scale, on images padded to a size and cut into overlapping tiles of it.

    The estimator gives planes (c, h, w); the first two are displacements and follow the scale, others are only resized.
    Tiles are used where images are padded as well.
    """

    def __init__(self, estimator, scale: float = 0.0, size: tuple[int, int] | None = None, tiled: bool = False):
        self.estimator, self.factor, self.size, self.tiled = estimator, 2.0**scale, size, tiled

    def calc_flow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        h, w = (int(n * self.factor) for n in first.shape[:2])
        out = self._padded(*(resized(i, h, w, aligned=True) for i in (first, second)))
        out = np.moveaxis(resized(np.moveaxis(out, 0, -1), *first.shape[:2], aligned=True), -1, 0).copy()
        out[:2] /= self.factor
        return out

    def _padded(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        h, w = first.shape[:2]
        if self.size is None:
            return np.asarray(self.estimator.calc_flow(first, second))
        ph, pw = (max(n - m, 0) for n, m in zip(self.size, (h, w)))
        sides = [(ph // 2, ph - ph // 2), (pw // 2, pw - pw // 2)] + [(0, 0)] * (first.ndim - 2)
        out = self._blended(np.pad(first, sides), np.pad(second, sides))
        return out[:, ph // 2 : ph // 2 + h, pw // 2 : pw // 2 + w]

    def _blended(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        if not self.tiled:
            return np.asarray(self.estimator.calc_flow(first, second))
        (th, tw), (h, w) = self.size, first.shape[:2]
        weight, total, out = bell(th, tw), np.zeros((h, w)), None
        for y in tiles(h, th):
            for x in tiles(w, tw):
                at = np.s_[y : y + th, x : x + tw]
                part = np.asarray(self.estimator.calc_flow(first[at], second[at]))
                out = np.zeros((len(part), h, w)) if out is None else out
                out[(slice(None), *at)] += weight * part
                total[at] += weight
        return out / total


def flows_of(estimator, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list:
    """Estimates of pairs, in one call of ``calc_flows`` where the estimator has it; an error stands in a pair's place."""
    if hasattr(estimator, "calc_flows") and len({a.shape for a, _ in pairs}) == 1:
        try:
            return list(estimator.calc_flows(np.stack([a for a, _ in pairs]), np.stack([b for _, b in pairs])))
        except Exception:  # each pair on its own tells which one fails
            pass
    out = []
    for a, b in pairs:
        try:
            out.append(estimator.calc_flow(a, b))
        except Exception as e:  # the row tells
            out.append(e)
    return out


def built(estimator):
    """An estimator, or what a class or function without arguments makes: so weights are loaded where they are used."""
    return estimator() if isinstance(estimator, type) or not hasattr(estimator, "calc_flow") else estimator


def image(raw: bytes, h: int, w: int) -> np.ndarray:
    """(h, w), or (h, w, channels) of more than one."""
    a = np.frombuffer(raw, np.uint8)
    return a.reshape(h, w) if a.size == h * w else a.reshape(h, w, -1)


def estimated(pairs: DataFrame, key: list[str], estimator, batch: int = 8) -> DataFrame:
    """(key, h, w, u, v, error) from pairs (key, h, w, first_image, second_image): narrow, ``batch`` pairs at a time.

    ``estimator`` is one, or a function that makes one in each task. A pair that fails keeps its row and its error.
    """
    kinds = ", ".join(f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in key)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = built(estimator)
        for pdf in parts:
            for i in range(0, len(pdf), batch):
                part, rows = pdf.iloc[i : i + batch], []
                images, bad = [], {}
                for n, r in enumerate(part.itertuples()):
                    try:
                        images.append((n, (image(r.first_image, r.h, r.w), image(r.second_image, r.h, r.w))))
                    except Exception as e:
                        bad[n] = e
                found = dict(zip([n for n, _ in images], flows_of(own, [p for _, p in images]))) | bad
                for n in range(len(part)):
                    f = found[n]
                    rows.append((None, None, f"{type(f).__name__}: {f}") if isinstance(f, Exception) else (np.ravel(f[0]).astype(float), np.ravel(f[1]).astype(float), None))
                out = part[[*key, "h", "w"]].reset_index(drop=True)
                yield pd.concat([out, pd.DataFrame(rows, columns=["u", "v", "error"])], axis=1)

    small = pairs.select(*key, "h", "w", "first_image", "second_image")
    return small.mapInPandas(run, f"{kinds}, h int, w int, u array<double>, v array<double>, error string")


def evaluated(pixels: DataFrame, by: list[str], image_key: str) -> DataFrame:
    """(by, images, epe, px1_fail, fl_all, n_empty) of pixels (by, image_key, u, v, gu, gv, valid): meters start anew for each
    dataset and pass. One shuffle of partial sums by image, one of images by ``by``."""
    name = F.struct(*by, image_key)
    images = metrics.per_image(pixels.withColumn("__image", name), "__image").select("__image.*", "epe", "px1", "n_out", "n_valid")
    fl = F.try_divide(F.lit(100.0) * F.sum("n_out"), F.sum("n_valid"))
    return images.groupBy(*by).agg(F.count(F.lit(1)).alias("images"), F.avg("epe").alias("epe"), (F.lit(100.0) * (1 - F.avg("px1"))).alias("px1_fail"), fl.alias("fl_all"), F.count_if(F.col("n_valid") == 0).alias("n_empty"))
