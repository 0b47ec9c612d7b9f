"""Warping, cycle consistency, camera geometry and homographies."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fields import sampled_bilinear


def warped(image: DataFrame, flow: DataFrame, id_: str, h: int, w: int) -> DataFrame:
    """``image`` (id, y, x, value) sampled at each pixel displaced by ``flow`` (id, y, x, u, v)."""
    at = flow.select(id_, "y", "x", (F.col("y") + F.col("v")).alias("py"), (F.col("x") + F.col("u")).alias("px"))
    return sampled_bilinear(image, at, id_, h, w)


def cycle_consistent(forward: DataFrame, backward: DataFrame, id_: str, h: int, w: int, share: float = 0.1) -> DataFrame:
    """(id, y, x, ok): forward plus the backward flow found there returns within share * min(h, w)."""
    back = [warped(backward.select(id_, "y", "x", F.col(c).alias("value")), forward, id_, h, w).withColumnRenamed("value", f"b{c}") for c in ("u", "v")]
    both = forward.join(back[0], [id_, "y", "x"]).join(back[1], [id_, "y", "x"])
    du, dv = F.col("u") + F.col("bu"), F.col("v") + F.col("bv")
    return both.select(id_, "y", "x", (F.sqrt(du * du + dv * dv) < share * min(h, w)).alias("ok"))


def rotation(x: Column, y: Column, z: Column, w: Column) -> list[Column]:
    """Nine entries, row-major, of the rotation of a quaternion."""
    n = F.sqrt(x * x + y * y + z * z + w * w)
    x, y, z, w = (c / n for c in (x, y, z, w))
    return [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]


def inverse_pose(r: list[Column], t: list[Column]) -> list[Column]:
    """Twelve entries of [R' | -R't], row-major."""
    rows = [[r[i], r[3 + i], r[6 + i]] for i in range(3)]
    return [c for row in rows for c in (*row, -(row[0] * t[0] + row[1] * t[1] + row[2] * t[2]))]


def induced_flow(y: Column, x: Column, depth: Column, k: list[float], pose: list) -> tuple[Column, Column]:
    """Displacement of a pixel of known depth under a relative pose (12 entries) with intrinsics fx, fy, cx, cy."""
    fx, fy, cx, cy = k
    p = [(x - cx) / fx * depth, (y - cy) / fy * depth, depth]
    q = [p[0] * pose[4 * i] + p[1] * pose[4 * i + 1] + p[2] * pose[4 * i + 2] + pose[4 * i + 3] for i in range(3)]
    return F.try_divide(q[0] * fx, q[2]) + cx - x, F.try_divide(q[1] * fy, q[2]) + cy - y


# fixed values: rows of a pose whose axes are forward, right, down, in the order right, down, forward of a camera
AXES = (1, 2, 0)


def camera_pose(t: list[Column], q: list[Column], axes: tuple[int, int, int] = AXES) -> Column:
    """Twelve entries, row-major, that take a point of the world into a camera at ``t`` turned by the quaternion ``q``."""
    m = inverse_pose(rotation(*q), t)
    return F.array(*[m[4 * i + j] for i in axes for j in range(4)])


def relative_pose(a: Column, b: Column) -> Column:
    """Twelve entries that take a point from camera ``a`` into camera ``b``, each given by ``camera_pose``."""
    at = lambda m, i, j: F.get(m, F.lit(4 * i + j))
    turn = [[sum((at(b, i, k) * at(a, j, k) for k in range(1, 3)), at(b, i, 0) * at(a, j, 0)) for j in range(3)] for i in range(3)]
    move = [at(b, i, 3) - (turn[i][0] * at(a, 0, 3) + turn[i][1] * at(a, 1, 3) + turn[i][2] * at(a, 2, 3)) for i in range(3)]
    return F.array(*[c for i in range(3) for c in (*turn[i], move[i])])


def pair_flows(pairs: DataFrame, poses: DataFrame, depths: DataFrame, h: int, w: int, k: list[float], share: float = 0.1) -> DataFrame:
    """(i, j, y, x, u, v, valid): how the pixels of frame i move towards frame j, from depth and pose alone.

    ``pairs`` is (i, j), ``poses`` (frame, pose) by ``camera_pose``, ``depths`` (frame, y, x, depth); k is fx, fy, cx, cy. Flow
    is induced both ways; a pixel whose way there and back does not end within ``share`` of the shorter side is not valid and
    its flow is zero. A point without a place in the other image is not valid either.
    """
    pose = lambda x: poses.select(F.col("frame").alias(x), F.col("pose").alias(f"pose_{x}"))
    both = pairs.select("i", "j").join(pose("i"), "i").join(pose("j"), "j")

    def one_way(a: str, b: str) -> DataFrame:
        rows = both.select(F.struct("i", "j").alias("pair"), F.col(a).alias("frame"), relative_pose(F.col(f"pose_{a}"), F.col(f"pose_{b}")).alias("m"))
        rows = rows.join(depths, "frame")
        u, v = induced_flow(F.col("y"), F.col("x"), F.col("depth"), k, [F.get("m", F.lit(n)) for n in range(12)])
        return rows.select("pair", "y", "x", u.alias("u"), v.alias("v"))

    there, back = one_way("i", "j"), one_way("j", "i")
    ok = cycle_consistent(there, back.select("pair", "y", "x", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("u", "v")]), "pair", h, w, share)
    out = there.join(ok, ["pair", "y", "x"], "left").withColumn("valid", F.coalesce("ok", F.lit(False)))
    return out.select("pair.i", "pair.j", "y", "x", *[F.when(F.col("valid"), F.col(c)).otherwise(F.lit(0.0)).alias(c) for c in ("u", "v")], "valid")


def homography_residual(hm: list[float], y: Column, x: Column, u: Column, v: Column) -> tuple[Column, Column]:
    """What is left of a displacement after the motion of a homography (9 entries)."""
    d = x * hm[6] + y * hm[7] + hm[8]
    return u - (F.try_divide(x * hm[0] + y * hm[1] + hm[2], d) - x), v - (F.try_divide(x * hm[3] + y * hm[4] + hm[5], d) - y)


def fit_homography(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """Direct linear transform of point pairs, normalised for condition."""

    def norm(p: np.ndarray):
        c, s = p.mean(0), max(p.std(), 1e-9)
        t = np.array([[1 / s, 0, -c[0] / s], [0, 1 / s, -c[1] / s], [0, 0, 1]])
        return (p - c) / s, t

    a, ta = norm(src)
    b, tb = norm(dst)
    z, o = np.zeros(len(a)), np.ones(len(a))
    rows = np.concatenate([np.stack([a[:, 0], a[:, 1], o, z, z, z, -b[:, 0] * a[:, 0], -b[:, 0] * a[:, 1], -b[:, 0]], 1), np.stack([z, z, z, a[:, 0], a[:, 1], o, -b[:, 1] * a[:, 0], -b[:, 1] * a[:, 1], -b[:, 1]], 1)])
    m = np.linalg.inv(tb) @ np.linalg.svd(rows)[2][-1].reshape(3, 3) @ ta
    return m / m[2, 2]


def ransac_homography(src: np.ndarray, dst: np.ndarray, reach: float = 3.0, rounds: int = 200, seed: int = 0) -> np.ndarray | None:
    """The homography with most points within ``reach``, fitted again on them; null if fewer than 4 agree."""
    rng, best = np.random.default_rng(seed), np.zeros(len(src), bool)
    for _ in range(rounds if len(src) >= 4 else 0):
        m = _trial(src, dst, rng)
        if m is None:
            continue
        p = np.c_[src, np.ones(len(src))] @ m.T
        with np.errstate(all="ignore"):
            near = np.hypot(*(p[:, :2] / p[:, 2:] - dst).T) < reach
        if near.sum() > best.sum():
            best = near
    return fit_homography(src[best], dst[best]) if best.sum() >= 4 else None


def _trial(src: np.ndarray, dst: np.ndarray, rng) -> np.ndarray | None:
    i = rng.choice(len(src), 4, replace=False)
    try:
        m = fit_homography(src[i], dst[i])
    except np.linalg.LinAlgError:
        return None
    return m if np.isfinite(m).all() else None


def ego_motion_removed(u: np.ndarray, v: np.ndarray, reach: float = 3.0) -> tuple[np.ndarray, np.ndarray]:
    """A field minus its dominant homography, fitted on a grid of about 10,000 points; unchanged where no fit is found."""
    h, w = u.shape
    step = max(1, int((h * w / 10_000) ** 0.5))
    y, x = (a.ravel() for a in np.mgrid[0:h:step, 0:w:step])
    src = np.stack([x, y], 1).astype(float)
    m = ransac_homography(src, src + np.stack([u[y, x], v[y, x]], 1), reach)
    if m is None:
        return u, v
    yy, xx = np.mgrid[0:h, 0:w]
    p = np.stack([xx, yy, np.ones_like(xx)], -1) @ m.T
    return u - (p[..., 0] / p[..., 2] - xx), v - (p[..., 1] / p[..., 2] - yy)
