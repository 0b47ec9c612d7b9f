"""Packed images in NumPy: resizing, padding, tiles, and the convex upsampling of estimates."""

from __future__ import annotations

import numpy as np


def _axis(n: int, m: int, aligned: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t = np.arange(m)
    s = t * ((n - 1) / (m - 1) if m > 1 else 0.0) if aligned else np.clip((t + 0.5) * (n / m) - 0.5, 0, n - 1)
    low = np.minimum(s.astype(int), n - 1)
    return low, np.minimum(low + 1, n - 1), s - low


def resized(image: np.ndarray, h: int, w: int, aligned: bool = False) -> np.ndarray:
    """Linear resize of (h, w[, planes]); ``aligned`` maps corner pixels on corner pixels."""
    if image.shape[:2] == (h, w):
        return image
    y0, y1, fy = _axis(image.shape[0], h, aligned)
    x0, x1, fx = _axis(image.shape[1], w, aligned)
    more = (1,) * (image.ndim - 2)
    fy, fx = fy.reshape(-1, 1, *more), fx.reshape(1, -1, *more)
    rows = image[y0] * (1 - fy) + image[y1] * fy
    return rows[:, x0] * (1 - fx) + rows[:, x1] * fx


def resized_nearest(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """Each target pixel takes the source pixel at floor(i * size / target size)."""
    return image[np.arange(h) * image.shape[0] // h][:, np.arange(w) * image.shape[1] // w]


def tiles(n: int, tile: int) -> list[int]:
    """Origins of overlapping tiles along one axis, the last one moved inside."""
    return sorted({max(min(i, n - tile), 0) for i in range(0, n, max(1, tile // 4 * 3))})


def bell(h: int, w: int, sigma: float = 1.0) -> np.ndarray:
    """Weights of a tile: a Gaussian around the middle of relative coordinates."""
    y, x = np.arange(h)[:, None] / h - 0.5, np.arange(w)[None, :] / w - 0.5
    return np.exp(-(y * y + x * x) / (2 * sigma * sigma))


def convex_upsampled(planes: np.ndarray, logits: np.ndarray, scale: float = 1.0) -> np.ndarray:
    """(h, w, c) to (2h, 2w, c): each target pixel is a convex mix of the 3 x 3 source pixels around, zero outside.

    ``logits`` is (h, w, 9, 2, 2): for each source pixel the weights of its neighbours, row-major, for each of its four
    target pixels, before the softmax. ``scale`` is 2 for displacements.
    """
    h, w, c = planes.shape
    e = np.exp(logits - logits.max(axis=2, keepdims=True))
    e /= e.sum(axis=2, keepdims=True)
    p = np.pad(planes * scale, ((1, 1), (1, 1), (0, 0)))
    out = np.zeros((h, 2, w, 2, c))
    for k in range(9):
        near = p[k // 3 : k // 3 + h, k % 3 : k % 3 + w]
        out += e[:, :, k].transpose(0, 2, 1, 3)[..., None] * near[:, None, :, None, :]
    return out.reshape(2 * h, 2 * w, c)
