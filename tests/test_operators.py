import numpy as np
import pytest
from pyspark.sql import functions as F

from flowframe.functions.colour import wheel_rows
from flowframe.operators import fields, geometry, indexing, masks, metrics, planning, rle, splat
from flowframe.functions.registry import register
from flowframe.plans.annotate import BlockMatching, annotate, motion_mask
from flowframe.sources import codecs, readers


def value(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


@pytest.mark.parametrize("bits, counts", [([0, 0, 0, 1, 1, 1, 0, 0], [4, 3, 3]), ([1, 0, 0, 1], [1, 1, 2, 1, 1]), ([0, 1], [2, 1, 1]), ([1, 0], [1, 1, 2]), ([0, 0, 0], [3]), ([1, 1, 1], [0, 3]), ([1, 1, 0, 1, 0], [1, 2, 1, 1, 2])])
def test_padded_code(spark, bits, counts):
    b = F.array(*[F.lit(x) for x in bits])
    assert value(spark, rle.padded(b)) == counts
    assert value(spark, rle.unpadded(rle.padded(b), F.size(b))) == bits


def written(bits, h, w):
    """The string code by its definition, number by number."""
    col = np.array(bits, int).reshape(h, w).T.ravel().tolist()
    counts, at, now = [], 0, 0
    while at < len(col) or not counts:
        end = at
        while end < len(col) and col[end] == now:
            end += 1
        counts.append(end - at)
        at, now = end, 1 - now
    out = ""
    for i, c in enumerate(counts):
        x = c - counts[i - 2] if i > 2 else c
        while not -16 <= x < 16:
            out, x = out + chr(48 + 32 + x % 32), x // 32
        out += chr(48 + x % 32)
    return out


def test_string_code_round_trip(spark):
    rng, rows = np.random.default_rng(0), []
    for _ in range(50):
        h, w = rng.integers(1, 9, 2)
        bits = rng.integers(0, 2, h * w).tolist()
        rows.append((bits, int(h), int(w)))
    rows += [([0] * 40 + [1] * 3000 + [0] * 40000 + [1, 0] * 30 + [1] * 2000, 45100, 1), ([1] * 9, 3, 3), ([0] * 9, 9, 1), ([], 0, 0)]
    register(spark)
    d = spark.createDataFrame(rows, "bits array<int>, h int, w int").selectExpr("*", "coco_encode(bits, h, w) as code")
    got = d.selectExpr("bits", "h", "w", "code", "coco_decode(code, h, w) as back").collect()
    assert all(r["back"] == r["bits"] and r["code"] == written(r["bits"], r["h"], r["w"]) for r in got) and len(got) == len(rows)
    assert value(spark, rle.coco("array(0, 0, 0, 1, 1, 1, 0, 0)", 8, 1)) == "332"
    assert spark.sql("select coco_encode(null, 2, 2) as a, coco_decode(null, 2, 2) as b").first()[:] == (None, None)


@pytest.mark.parametrize("fps, cap, long_s, short_s, want", [(30.0, 5.0, 1, 0.3, (6, 5, 1)), (24.0, 5.0, 1, 0.3, (5, 4, 1)), (10.0, 5.0, 1, 0.3, (2, 5, 1)), (29.97, 5.0, 1, 0.3, (6, 4, 1)), (30.0, None, 1, 0.1, (1, 30, 3))])
def test_strides(spark, fps, cap, long_s, short_s, want):
    s = planning.stride(F.lit(fps), F.lit(cap).cast("double"))
    a, b = planning.offsets(F.lit(fps), s, float(long_s), short_s)
    assert tuple(spark.range(1).select(s.alias("s"), a.alias("a"), b.alias("b")).first()) == want


def test_triplets_and_needed_frames(spark):
    frames = spark.range(12).selectExpr("1 as k", "id as idx")
    t = planning.triplets(frames, ["k"], 2, 5, 1)
    assert [tuple(r)[1:] for r in t.collect()] == [(0, 10, 8)]
    assert sorted(r["idx"] for r in planning.needed_frames(t, ["k"]).collect()) == [0, 8, 10]


def test_cameras(spark):
    c = planning.cameras(F.lit("unknown"), {"a": ["left", "right"]}, ["left", "cam_high"], ["cam_high"])
    assert value(spark, c) == ["cam_high"]
    assert value(spark, planning.cameras(F.lit("a"), {"a": ["left", "right"]}, ["left"], ["cam_high"])) == ["left"]


def test_percentile_mask_golden(spark):
    d = spark.createDataFrame([(1, x) for x in (0.5, 2.0, 4.0, 6.0, 8.0)], "k int, m double")
    rows = masks.percentile_mask(d, "k").orderBy("m").collect()
    assert [r["mask"] for r in rows] == [0, 0, 1, 1, 1] and abs(rows[0]["threshold"] - 2.6) < 1e-9


def test_metrics_goldens(spark):
    d = spark.createDataFrame([(1, 3.0, 4.0, 0.0, 0.0, True), (2, 104.0, 0.0, 100.0, 0.0, True), (3, 0.0, 0.0, 0.0, 0.0, False)], "k int, u double, v double, gu double, gv double, valid boolean")
    r = {x["k"]: x for x in metrics.per_image(d, "k").collect()}
    assert r[1]["epe"] == 5 and r[1]["n_out"] == 1 and r[2]["epe"] == 4 and r[2]["n_out"] == 0 and r[3]["epe"] is None
    assert metrics.summary(metrics.per_image(d, "k")).first()["n_empty"] == 1
    for delta, want in ((0.0, 0.693147), (1.0, 1.693147)):
        z = F.lit(0.0)
        assert abs(value(spark, metrics.mixture_nll(z, z, z, z, F.lit(delta))) - want) < 1e-5


def test_sequence_loss_golden(spark):
    d = spark.createDataFrame([(1, 0, 3.0), (1, 1, 2.0), (1, 2, 1.0)], "k int, i int, l double")
    assert metrics.sequence_loss(d, "k", "i", "l", 0.5).first()["loss"] == 2.75


def test_masked_sequence_loss(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, 0, 4.0, 1.0, 3.0, 4.0), (1, 0, 2.0, 0.5, 3.0, 4.0), (1, 1, 1.0, 1.0, 0.0, 39999.0)]
    out = [(1, 0, nan, 1.0, 0.0, 0.0), (1, 0, inf, 1.0, 0.0, 0.0), (1, 0, -inf, 1.0, 0.0, 0.0), (1, 0, 9.0, 0.4, 0.0, 0.0), (1, 1, 9.0, 1.0, 40000.0, 0.0), (1, 1, 9.0, 1.0, nan, 0.0), (1, 1, None, 1.0, 0.0, 0.0)]
    # an empty prediction counts as one that lost nothing
    empty = [(1, 2, nan, 1.0, 0.0, 0.0), (2, 0, 5.0, 0.0, 0.0, 0.0)]
    d = spark.createDataFrame(good + out + empty, "k int, i int, l double, valid double, gu double, gv double")
    got = {r["k"]: r["loss"] for r in metrics.masked_sequence_loss(d, "k", "i", "l", 0.5).collect()}
    assert got == {1: 0.25 * 3.0 + 0.5 * 1.0, 2: 0.0}


def test_wheel_and_pads(spark):
    w = wheel_rows()
    assert len(w) == 55 and w[0][1:] == (255, 0, 0) and w[1][1:] == (255, 17, 0) and w[15][1:] == (255, 255, 0)
    assert value(spark, planning.pad_plan(F.lit(436))) == 12 and value(spark, planning.pad_plan(F.lit(1024))) == 32


def test_morphology_forms_agree(spark):
    rng = np.random.default_rng(1)
    m = (rng.random((6, 7)) < 0.6).astype(np.uint8)
    d = spark.createDataFrame([(1, y, x, int(m[y, x])) for y in range(6) for x in range(7)], "k int, y int, x int, mask int")
    for size in (3, 7, 9):
        for f, first in ((masks.opened, False), (masks.closed, True)):
            want = masks.morph(masks.morph(m, size, first), size, not first)
            got = np.zeros_like(m)
            for r in f(d, "k", size).collect():
                got[r["y"], r["x"]] = r["mask"]
            assert (got == want).all()
            assert (masks.morph(masks.morph(want, size, first), size, not first) == want).all()


def test_codecs_round_trip(spark, tmp_path):
    rng = np.random.default_rng(2)
    f = rng.normal(size=(5, 7, 2)).astype(np.float32)
    assert (codecs.read_flo(codecs.write_flo(f)) == f).all() and codecs.read_flo(b"\0" * 20) is None
    k = codecs.to_kitti(np.round(f * 64) / 64)
    assert (codecs.read_png(codecs.write_png(k)) == k).all()
    assert np.allclose(codecs.from_kitti(k)[0], np.round(f * 64) / 64)
    assert codecs.from_kitti(np.array([[[32864, 32768, 1]]]))[0][0, 0, 0] == 1.5
    (tmp_path / "a.flo").write_bytes(codecs.write_flo(f))
    (tmp_path / "b.flo").write_bytes(b"junk")
    rows = {r["path"][-5:]: r for r in readers.read_fields(spark, str(tmp_path)).collect()}
    assert rows["a.flo"]["h"] == 5 and np.allclose(rows["a.flo"]["u"], f[..., 0].ravel()) and rows["b.flo"]["error"]


def test_pfm():
    raw = b"Pf\n2 2\n-1.0\n" + np.array([3, 4, 1, 2], "<f4").tobytes()
    assert codecs.read_pfm(raw).tolist() == [[1, 2], [3, 4]]


def test_homography_fit_removes_ego_motion():
    y, x = np.mgrid[0:30, 0:40]
    m = np.array([[1.01, 0.02, 1.5], [-0.01, 0.98, -0.7], [1e-4, 2e-4, 1]])
    p = np.stack([x, y, np.ones_like(x)], -1) @ m.T
    u, v = p[..., 0] / p[..., 2] - x, p[..., 1] / p[..., 2] - y
    a, b = geometry.ego_motion_removed(u, v)
    assert np.abs(a).max() < 1e-6 and np.abs(b).max() < 1e-6


@pytest.mark.parametrize("n", [0, 1, 5, 200])
def test_nearest_source_is_brute_force(n):
    rng = np.random.default_rng(n)
    px, py = np.round(rng.uniform(0.1, 11.9, n), 1), np.round(rng.uniform(0.1, 8.9, n), 1)
    y, x = (a.ravel()[:, None] for a in np.mgrid[0:9, 0:12])
    want = ((px - x) * (px - x) + (py - y) * (py - y)).argmin(axis=1) if n else np.full(108, -1)
    assert splat.nearest_source(px, py, 9, 12).tolist() == want.tolist()


def test_rotation_goldens(spark):
    lit = lambda *q: [F.lit(float(x)) for x in q]
    for q, want in (((0, 0, 0, 1), [1, 0, 0, 0, 1, 0, 0, 0, 1]), ((0, 0, 1, 0), [-1, 0, 0, 0, -1, 0, 0, 0, 1])):
        assert value(spark, F.array(*geometry.rotation(*lit(*q)))) == want


def test_flips_undo_and_zero_warp(spark):
    d = spark.createDataFrame([(1, y, x, float(x), float(y)) for y in range(2) for x in range(3)], "k int, y int, x int, u double, v double")
    twice = fields.flipped(fields.flipped(d, 2, 3), 2, 3)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, d.collect()))
    image = d.select("k", "y", "x", (F.col("u") * 10 + F.col("v")).alias("value"))
    still = d.withColumns({"u": F.lit(0.0), "v": F.lit(0.0)})
    assert sorted(map(tuple, geometry.warped(image, still, "k", 2, 3).collect())) == sorted(map(tuple, image.collect()))


def test_unpivot_and_first_match(spark):
    d = spark.createDataFrame([(0, 9, 1, 2, 0.5, 1.5)], ["episode_index", "length", *[f"videos/a.b/{f}" for f in ("chunk_index", "file_index", "from_timestamp", "to_timestamp")]])
    assert tuple(planning.unpivot_cameras(d).first()) == (0, 9, "a.b", 1.0, 2.0, 0.5, 1.5)
    left = spark.createDataFrame([(1, 0), (1, 7)], "k int, i int")
    right = spark.createDataFrame([(1, 5), (1, 3)], "k int, i int")
    assert sorted(map(tuple, indexing.first_match(left, right, ["k"], "i", [1, 2, 3, 5, 6]).collect())) == [(1, 0, 3), (1, 7, None)]



def test_images_of_flows_of_more_than_four_digits(spark):
    flow = lambda n: f"/a/train/flows/s/data/data_{n}.npz"
    image = lambda n: f"/a/train/images/s/{n}"
    flows = spark.createDataFrame([(flow(n),) for n in ("9999", "12345", "0007", "1403636579763555584")], "flow string")
    names = ["9999.png", "1000.png", "1234.png", "1235.png", "10000.jpg", "12345.png", "12345.jpg", "12346.jpg", "0007.jpg", "0007.jpg", "0008.png", "1403636579763555584.png", "1403636579763555585.png"]
    found = indexing.images_of_flows(flows, spark.createDataFrame([(image(n),) for n in names], "path string"))
    want = {"9999": ("9999.png", "10000.jpg", 1), "12345": ("12345.png", "12346.jpg", 1), "0007": ("0007.jpg", "0008.png", 2), "1403636579763555584": ("1403636579763555584.png", "1403636579763555585.png", 1)}
    assert {r["flow"]: tuple(r)[1:] for r in found.collect()} == {flow(n): (int(n), image(a), image(b), c) for n, (a, b, c) in want.items()}


def test_repeated_counts_beyond_a_block(spark):
    d = spark.createDataFrame([(1, 1), (2, 3), (3, indexing.REPEATS), (4, indexing.REPEATS + 1), (5, 3 * indexing.REPEATS), (6, 0)], "k int, n long")
    assert {r["k"]: r["count"] for r in indexing.repeated(d, "n").groupBy("k").count().collect()} == {1: 1, 2: 3, 3: 4096, 4: 4097, 5: 12288}


@pytest.mark.parametrize("n, most", [(20 << 20, 3 << 20), ((9 << 24) + 5, 1 << 24)])
def test_repeated_deals_the_copies_of_a_row_to_tasks(spark, n, most):
    made = indexing.repeated(spark.createDataFrame([(1, n), (2, 1), (3, -1), (4, None)], "k int, n long"), "n")
    by = [tuple(r) for r in made.groupBy("k", F.spark_partition_id()).count().collect()]
    assert {k: sum(c for x, _, c in by if x == k) for k, _, _ in by} == {1: n, 2: 1}
    assert max(c for _, _, c in by) <= most


def test_annotation_pipeline_finds_a_moving_block(spark):
    a, b = np.zeros((32, 32), np.uint8), np.zeros((32, 32), np.uint8)
    a[8:20, 8:20] = b[8:20, 10:22] = np.random.default_rng(0).integers(50, 255, (12, 12))
    row = [(1, 5, "long", 32, 32, bytearray(a.tobytes()), bytearray(b.tobytes())), (2, 5, "long", 32, 32, bytearray(a.tobytes()), bytearray(b"x"))]
    d = spark.createDataFrame(row, "episode long, tgt_long long, pair_type string, h int, w int, first_image binary, second_image binary")
    out = {r["episode"]: r for r in annotate(d, BlockMatching(), min_area=20).collect()}
    assert sum(out[1]["mask"]) > 60 and out[1]["error"] is None and out[2]["error"] and sum(out[2]["mask"]) == 0
    assert motion_mask(np.zeros((4, 4)), np.zeros((4, 4))).sum() == 0


def test_padded_code_of_a_large_frame_is_linear(spark):
    import time

    from flowframe.operators import rle
    from pyspark.sql import functions as F

    n = 100_000
    bits = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i % 7 < 3).cast("int")).alias("b"))
    began = time.perf_counter()
    row = bits.select(rle.padded(F.col("b")).alias("c"), "b").select("c", (rle.unpadded(F.col("c"), F.lit(n)) == F.col("b")).alias("same")).first()
    assert row["same"] and sum(row["c"]) == n + 2 and time.perf_counter() - began < 20


def test_triplets_with_a_short_offset_beyond_the_long_one(spark):
    from flowframe.operators import planning

    frames = spark.createDataFrame([(1, i) for i in range(8)], "user_id int, idx int")
    for long_, short in ((5, 2), (2, 5), (1, 3), (3, 3)):
        got = sorted((r["src"], r["tgt_long"], r["tgt_short"]) for r in planning.triplets(frames, ["user_id"], 1, long_, short).collect())
        assert got == [(i, i + long_, max(0, i + long_ - short)) for i in range(8 - long_)]


def test_components_of_a_large_mask(spark):
    import numpy as np
    from flowframe.operators import masks

    h, w = 250, 400
    rng = np.random.default_rng(0)
    on = rng.random((h, w)) < 0.3
    df = spark.createDataFrame([(1, int(y), int(x), 1) for y, x in zip(*np.nonzero(on))], "k int, y int, x int, mask int")
    lab = masks.labels(on.astype(np.uint8))
    area = np.bincount(lab.ravel())
    got = {(r["y"], r["x"]): (r["label"], r["area"]) for r in masks.large_components(df, "k", h, w, 3).collect()}
    assert got == {(int(y), int(x)): (lab[y, x], area[lab[y, x]]) for y, x in zip(*np.nonzero(on)) if area[lab[y, x]] > 3}


def test_colours_by_their_definition(spark):
    import math

    from flowframe.functions import colour

    rows = [(1, 0, i, math.cos(i) * (i + 0.3), math.sin(i) * (i + 0.3)) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, y int, x int, u double, v double")
    wheel = [r[1:] for r in colour.wheel_rows()]
    for clip in (None, 5.0):
        uv = [(u, v) if clip is None else tuple(min(max(c, 0.0), clip) for c in (u, v)) for *_, u, v in rows]
        top = max(math.hypot(*c) for c in uv) + 1e-5
        for r in colour.coloured(df, "k", clip).collect():
            u, v = (c / top for c in uv[r["x"]])
            at = (math.atan2(-v, -u) / math.pi + 1) / 2 * (len(wheel) - 1)
            k, rad = int(at), math.hypot(u, v)
            for name, i in zip("rgb", range(3)):
                c = ((1 - at + k) * wheel[k][i] + (at - k) * wheel[(k + 1) % len(wheel)][i]) / 255
                assert abs(r[name] - math.floor((1 - rad * (1 - c)) * 255)) <= 1
