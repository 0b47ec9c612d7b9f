"""The annotation plan: pairs of frames to masks, with the estimator as a plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..operators.geometry import ego_motion_removed
from ..operators.imaging import resized, resized_nearest
from ..operators.masks import labels, morph
from .inference import built, flows_of, image


class FlowEstimator(Protocol):
    def calc_flow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """(2, h, w) displacement from the first to the second image."""


class BlockMatching:
    """A stand-in without learned weights: the best whole-pixel shift of each block within a reach."""

    def __init__(self, block: int = 4, reach: int = 3):
        self.block, self.reach = block, reach

    def calc_flow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        h, w = first.shape
        a, b = first.astype(float), np.pad(second.astype(float), self.reach, mode="edge")
        cost, best = np.full((h, w), np.inf), np.zeros((2, h, w))
        shifts = sorted(((dx, dy) for dx in range(-self.reach, self.reach + 1) for dy in range(-self.reach, self.reach + 1)), key=lambda s: s[0] ** 2 + s[1] ** 2)
        for dx, dy in shifts:
            diff = np.abs(a - b[self.reach + dy : self.reach + dy + h, self.reach + dx : self.reach + dx + w])
            for y in range(0, h, self.block):
                for x in range(0, w, self.block):
                    at = np.s_[y : y + self.block, x : x + self.block]
                    if diff[at].mean() < cost[at].flat[0] - 1e-12:
                        cost[at] = diff[at].mean()
                        best[(slice(None), *at)] = np.array([dx, dy])[:, None, None]
        return best


def motion_mask(u: np.ndarray, v: np.ndarray, floor: float = 1.0, min_area: int = 100) -> np.ndarray:
    """Otsu on min-max levels above the floor, opened by 3, closed by 7, small components dropped."""
    m = np.hypot(u, v)
    if m.max() < floor or m.max() == m.min():
        return np.zeros(m.shape, np.uint8)
    level = ((m - m.min()) / (m.max() - m.min()) * 255).astype(np.uint8)
    n = np.bincount(level.ravel(), minlength=256).astype(float)
    w0, s0 = np.cumsum(n), np.cumsum(n * np.arange(256))
    w1 = w0[-1] - w0
    ok = (w0 > 0) & (w1 > 0)
    var = np.where(ok, (w0[-1] * s0 - s0[-1] * w0) ** 2 / np.where(ok, w0 * w1, 1), 0)
    mask = ((level > int(var.argmax())) & (m > floor)).astype(np.uint8)
    for size, first in ((3, False), (7, True)):
        mask = morph(morph(mask, size, first), size, not first)
    lab = labels(mask)
    area = np.bincount(lab.ravel(), minlength=lab.max() + 1)
    return ((lab > 0) & (area[lab] > min_area)).astype(np.uint8)


def annotate(pairs: DataFrame, estimator: FlowEstimator | Callable[[], FlowEstimator], long_floor: float = 1.0, short_floor: float = 0.5, min_area: int = 100, roi: tuple[int, int, int, int] | None = None, limit: int = 640, still_camera: bool = True, batch: int = 8) -> DataFrame:
    """(episode, tgt_long, h, w, mask, error) from pairs (episode, tgt_long, pair_type, h, w, first_image, second_image).

    Images are cut to ``roi`` (y0, x0, y1, x1) and made smaller where an edge is above ``limit``. The masks of a target's
    pairs are united, closed by 9, brought back to size and put into an empty mask of the whole image. Without a still
    camera its own motion is taken off each field first. A pair that fails keeps its frame and its error. Pairs are
    sorted by target within tasks and estimated ``batch`` at a time, so a task holds one batch and one mask.
    """

    def part(raw: bytes, h: int, w: int) -> np.ndarray:
        a = image(raw, h, w)
        y0, x0, y1, x1 = _inside(roi, h, w)
        a = a[y0:y1, x0:x1]
        small = limit / max(a.shape[:2])
        return a if small >= 1 else resized(a.astype(float), int(a.shape[0] * small), int(a.shape[1] * small))

    def masks(own, rows: list) -> list:
        """A mask or an error for each pair."""
        out: list = [None] * len(rows)
        ready = []
        for n, r in enumerate(rows):
            try:
                ready.append((n, (part(r.first_image, r.h, r.w), part(r.second_image, r.h, r.w))))
            except Exception as e:  # the row tells
                out[n] = e
        for (n, _), flow in zip(ready, flows_of(own, [p for _, p in ready])):
            try:
                if isinstance(flow, Exception):
                    raise flow
                u, v = flow[:2] if still_camera else ego_motion_removed(flow[0], flow[1])
                out[n] = motion_mask(u, v, long_floor if rows[n].pair_type == "long" else short_floor, min_area)
            except Exception as e:  # the row tells
                out[n] = e
        return out

    def whole(h: int, w: int, mask: np.ndarray | None) -> np.ndarray:
        out = np.zeros((h, w), np.uint8)
        if mask is not None:
            y0, x0, y1, x1 = _inside(roi, h, w)
            out[y0:y1, x0:x1] = resized_nearest(morph(morph(mask, 9, True), 9, False), y1 - y0, x1 - x0)
        return out

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, last, size, mask, errors, out = built(estimator), None, None, None, [], []

        def row() -> tuple:
            return (*last, *size, whole(*size, mask).ravel().astype(np.int32), "; ".join(errors) or None)

        for pdf in parts:
            for i in range(0, len(pdf), batch):
                rows = list(pdf.iloc[i : i + batch].itertuples(index=False))
                for r, m in zip(rows, masks(own, rows)):
                    if last != (r.episode, r.tgt_long):
                        out += [row()] if last else []
                        last, size, mask, errors = (r.episode, r.tgt_long), (r.h, r.w), None, []
                    if isinstance(m, Exception):
                        errors.append(f"{r.pair_type}: {m}")
                    else:
                        mask = m if mask is None else mask | m
                if out:
                    yield pd.DataFrame(out, columns=["episode", "tgt_long", "h", "w", "mask", "error"])
                    out = []
        if last:
            yield pd.DataFrame([row()], columns=["episode", "tgt_long", "h", "w", "mask", "error"])

    dealt = pairs.select("episode", "tgt_long", "pair_type", "h", "w", "first_image", "second_image").repartition("episode", "tgt_long").sortWithinPartitions("episode", "tgt_long", "pair_type")
    return dealt.mapInPandas(run, "episode long, tgt_long long, h int, w int, mask array<int>, error string")


def _inside(roi: tuple[int, int, int, int] | None, h: int, w: int) -> tuple[int, int, int, int]:
    y0, x0, y1, x1 = roi or (0, 0, h, w)
    return max(0, y0), max(0, x0), min(h, y1), min(w, x1)
