"""The data source, discovery, table functions, order statistics and pair flows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowframe.functions.registry import register
from flowframe.operators import geometry, masks, ordering, planning
from flowframe.sources import codecs, datasource, discovery, readers


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Fields of every format in two datasets, junk, hidden files and an empty folder."""
    root, rng = tmp_path_factory.mktemp("fields"), np.random.default_rng(0)
    (root / "temp_a/flow").mkdir(parents=True)
    (root / "temp_b #1%").mkdir()
    (root / "other").mkdir()
    (root / "temp_empty").mkdir()
    f = rng.normal(size=(4, 6, 2)).astype(np.float32)
    for i in range(5):
        (root / f"temp_a/flow/{i}.flo").write_bytes(codecs.write_flo(f + i))
    (root / "temp_a/k.png").write_bytes(codecs.write_png(codecs.to_kitti(f)))
    (root / "temp_b #1%/d.png").write_bytes(codecs.write_png(np.array([[256, 0]], np.uint16)))
    (root / "temp_b #1%/x.pfm").write_bytes(b"Pf\n2 2\n-1.0\n" + np.array([3, 4, 1, 2], "<f4").tobytes())
    np.savez(root / "temp_b #1%/z.npz", flow=np.moveaxis(f, -1, 0), covisibility=np.full((4, 6), 0.5))
    (root / "other/junk.flo").write_bytes(b"junk")
    (root / "other/cut.flo").write_bytes(codecs.write_flo(f)[:50])
    (root / "other/read.me").write_bytes(b"text")
    (root / "other/_hidden.flo").write_bytes(codecs.write_flo(f))
    return root


def rows(df):
    text = lambda v: None if v is None else np.asarray(v, np.float32).tobytes()
    return {r["path"]: (r["h"], r["w"], text(r["u"]), text(r["v"]), text(r["valid"]), r["error"] is None) for r in df.collect()}


def test_the_source_reads_what_the_reader_reads(spark, folder):
    datasource.register(spark)
    got = rows(spark.read.format("flowfields").load(str(folder)))
    want = rows(readers.read_fields(spark, str(folder)).where("path not like '%read.me'"))
    plain = lambda d: {k.replace("%20", " ").replace("%23", "#").replace("%25", "%"): v for k, v in d.items()}
    assert plain(got) == plain(want) and len(got) == 11
    assert sum(not v[-1] for v in got.values()) == 2
    z = next(v for k, v in got.items() if k.endswith("z.npz"))
    assert np.frombuffer(z[4], np.float32).tolist() == [0.5] * 24
    d = next(v for k, v in got.items() if k.endswith("d.png"))
    assert np.frombuffer(d[4], np.float32).tolist() == [1, 0]


def test_the_source_plans_partitions_and_prunes(spark, folder):
    datasource.register(spark)
    read = lambda **o: spark.read.format("flowfields").options(**o).load(str(folder))
    size = 12 + 8 * 24
    assert read(kinds="flo", partitionBytes=size).rdd.getNumPartitions() >= 6
    assert read(kinds="flo", partitionBytes=10 * size).rdd.getNumPartitions() == 1
    assert spark.read.format("flowfields").load(f"{folder}/temp_*/flow/[0-2].flo").count() == 3
    assert spark.read.format("flowfields").load(f"{folder}/temp_a/{{k.png,flow/4.flo}}").count() == 2
    assert spark.read.format("flowfields").load(f"{folder}/temp_a/flow/3.flo").first()["h"] == 4
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        some = read(pushdown="true", partitionBytes=1)
        assert some.rdd.getNumPartitions() == 11
        for test, n in ((F.col("path").endswith("/3.flo"), 1), (F.col("path").contains("temp_a"), 6), (F.col("path").startswith(f"file:{folder}/other"), 2), (F.col("path").isin(f"file:{folder}/temp_a/k.png", "file:/none"), 1), (F.col("path") == f"file:{folder}/temp_a/k.png", 1)):
            assert some.where(test).count() == n and some.where(test).rdd.getNumPartitions() == n
        assert some.where(F.col("path").contains("temp_a") & (F.col("h") > 4)).count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    with pytest.raises(Exception, match="no such path"):
        spark.read.format("flowfields").load(str(folder / "nowhere")).count()


def test_the_source_writes_fields(spark, tmp_path):
    datasource.register(spark)
    rng = np.random.default_rng(1)
    f = [(np.round(rng.normal(size=(3, 5, 2)) * 64) / 64).astype(np.float32) for _ in range(4)]
    data = [(f"s{i % 2}/{i}.{'flo' if i < 3 else 'png'}", 3, 5, x[..., 0].ravel().tolist(), x[..., 1].ravel().tolist(), None, None) for i, x in enumerate(f)]
    spark.createDataFrame(data, datasource.SCHEMA).repartition(3).write.format("flowfields").mode("append").save(str(tmp_path))
    back = {r["path"].split("/")[-1]: r for r in spark.read.format("flowfields").load(str(tmp_path)).collect()}
    assert sorted(back) == ["0.flo", "1.flo", "2.flo", "3.png"]
    assert all(np.array_equal(back[d[0].split("/")[1]]["u"], d[3]) and np.array_equal(back[d[0].split("/")[1]]["v"], d[4]) for d in data)
    with pytest.raises(Exception, match="below the sink"):
        spark.createDataFrame([("../x.flo", *data[0][1:])], datasource.SCHEMA).write.format("flowfields").mode("append").save(str(tmp_path))


def test_datasets_of_a_folder(spark, folder):
    plain = lambda df: [(r["name"], r["files"], r["warning"]) for r in df.collect()]
    assert plain(discovery.datasets(spark, str(folder), prefixes=["temp_"])) == [("temp_a", 6, None), ("temp_b #1%", 3, None)]
    assert plain(discovery.datasets(spark, str(folder))) == [("other", 3, None), ("temp_a", 6, None), ("temp_b #1%", 3, None)]
    asked = discovery.datasets(spark, str(folder), names=["temp_c", "other", "temp_c", "temp_a"])
    assert plain(asked) == [("other", 3, None), ("temp_a", 6, None), ("temp_c", 0, "Dataset not found: temp_c")]
    assert plain(discovery.datasets(spark, str(folder), names=[])) == []
    assert {r["path"] for r in asked.collect() if r["path"]} == {f"file:{folder}/other", f"file:{folder}/temp_a"}
    assert "content" not in discovery.listing(spark, str(folder))._jdf.queryExecution().executedPlan().toString()


def test_triplets_by_sql_equal_the_window(spark):
    register(spark)
    frames = spark.createDataFrame([(k, c, i) for k in range(5) for c in "ab" for i in range(3 * k + 1)], "k int, c string, idx long").repartition(4)
    for step, long_, short in ((1, 5, 2), (2, 2, 1), (1, 2, 5), (3, 0, 0), (2, 1, 3)):
        got = spark.sql(f"select * from frame_triplets(table({{f}}) partition by (k, c) order by (idx), {step}, {long_}, {short})", f=frames)
        want = planning.triplets(frames, ["k", "c"], step, long_, short)
        assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(Exception, match="needs a column idx"):
        spark.sql("select * from frame_triplets(table(select 1 as k) partition by (k) order by (k), 1, 1, 1)").collect()
    with pytest.raises(Exception, match="step"):
        spark.sql("select * from frame_triplets(table(select 1 as k, 1 as idx) partition by (k) order by (idx), 0, 1, 1)").collect()


def test_triplets_of_tasks_equal_those_of_frames(spark):
    tasks = [(0, 12, 10.0, 5.0), (1, 100, 30.0, 5.0), (2, 3, 30.0, None), (3, 0, 24.0, 5.0), (4, 64, 29.97, 5.0)]
    d = spark.createDataFrame(tasks, "k int, n int, fps double, cap double")
    got = {}
    for r in d.select("k", F.inline(planning.task_triplets(F.col("n"), F.col("fps"), F.col("cap"), 1.0, 0.3))).collect():
        got.setdefault(r["k"], []).append((r["src"], r["tgt_long"], r["tgt_short"]))
    for k, n, fps, cap in tasks:
        step = -int(-fps // cap) if cap and fps > cap else 1
        long_, short = int(fps / step), max(1, int(0.3 * fps / step))
        at = list(range(0, n, step))
        want = [(at[i], at[i + long_], at[max(0, i + long_ - short)]) for i in range(max(0, len(at) - long_))]
        assert got.get(k, []) == want


@pytest.mark.parametrize("ranges", [256, 4096])
def test_quantiles_by_ranges(spark, ranges):
    rng = np.random.default_rng(2)
    data = {"a": rng.normal(size=900), "b": np.full(500, 3.0), "c": np.concatenate([rng.integers(0, 3, 400), [1e300, -1e300, 1.7e308, -1.7e308]]).astype(float), "d": rng.normal(size=3), "e": 10.0 ** rng.uniform(-300, 300, 300), None: rng.integers(-5, 5, 200).astype(float)}
    d = spark.createDataFrame([(k, float(x)) for k, v in data.items() for x in v] + [("f", None), ("a", None), ("a", float("nan"))], "k string, v double").repartition(5)
    q = [0.0, 0.1, 0.5, 0.777, 1.0]
    for whole in (10, 10**6):
        got = {r["k"]: r["quantiles"] for r in ordering.quantiles(d, "k", "v", q, whole, ranges).collect()}
        assert set(got) == set(data)
        assert all(np.allclose(got[k], np.quantile(v, q), rtol=1e-12) for k, v in data.items())


def test_percentile_mask_and_normalising_need_no_window(spark):
    d = spark.createDataFrame([("a", m) for m in (0.5, 2.0, 4.0, 6.0, 8.0)] + [("b", 0.1), (None, 3.0), ("c", None)], "k string, m double")
    out = masks.percentile_mask(d, "k")
    got = {(r["k"], r["m"]): (round(r["threshold"], 6), r["mask"]) for r in out.collect()}
    assert [got["a", m] for m in (0.5, 2.0, 4.0, 6.0, 8.0)] == [(2.6, 0), (2.6, 0), (2.6, 1), (2.6, 1), (2.6, 1)]
    assert got["b", 0.1] == (0.0, 0) and got[None, 3.0][0] == 3.0 and got["c", None] == (0.0, None)
    small = masks.percentile_mask(d, "k", whole=1)
    assert {(r["k"], r["m"]): (round(r["threshold"], 6), r["mask"]) for r in small.collect()} == got
    level = {(r["k"], r["m"]): r["level"] for r in ordering.min_max(d, "k", "m").collect()}
    assert level["a", 8.0] == 1.0 and level["a", 0.5] == 0.0 and level[None, 3.0] == 0.0
    for df in (out, ordering.min_max(d, "k", "m"), ordering.max_share(d, "k", "m")):
        assert "Window" not in df._jdf.queryExecution().executedPlan().toString()


def test_ranks_of_one_value_a_hundred_thousand_times(spark):
    d = spark.range(100_000).selectExpr("7 as v", "id").repartition(6)
    out = ordering.ranked(d, "v", parts=8)
    assert out.agg(F.count_distinct("pos"), F.min("pos"), F.max("pos")).first()[:] == (100_000, 0, 99_999)
    biggest = out.groupBy((F.col("pos") / 25_000).cast("int")).count()
    assert biggest.count() == 4
    seen = d.select("v", F.xxhash64("v", "id").alias("d")).sample(0.01, seed=1).collect()
    limits = sorted((r[0], r[1]) for r in seen)[:: max(1, len(seen) // 8)]
    size = d.groupBy(ordering.cut_at(limits, F.struct("v", F.xxhash64("v", "id")), "int").alias("r")).count().agg(F.max("count")).first()[0]
    assert size < 50_000  # equal values are spread over the ranges


def test_morphology_has_no_explode(spark):
    d = spark.range(64).selectExpr("1 as k", "cast(id div 8 as int) as y", "cast(id % 8 as int) as x", "cast(id % 3 = 0 as int) as mask")
    plan = masks.opened(d, "k", 7)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Window" in plan


def spiral(n):
    """One path of width 1 that winds inwards, with gaps of width 1."""
    m = np.zeros((n, n), np.uint8)
    y = x = 0
    dy, dx = 0, 1
    m[0, 0] = 1
    while True:
        ahead = lambda k: (y + k * dy, x + k * dx)  # noqa: E731, B023
        inside = lambda p: 0 <= p[0] < n and 0 <= p[1] < n
        if not inside(ahead(1)) or (inside(ahead(2)) and m[ahead(2)]):
            dy, dx = dx, -dy
            if not inside(ahead(1)) or m[ahead(1)] or (inside(ahead(2)) and m[ahead(2)]):
                return m
        y, x = ahead(1)
        m[y, x] = 1


def flood(mask):
    """Components by searching from pixel to pixel."""
    h, w = mask.shape
    out = np.zeros((h, w), int)
    for y in range(h):
        for x in range(w):
            if mask[y, x] and not out[y, x]:
                name, todo = y * w + x + 1, [(y, x)]
                out[y, x] = name
                while todo:
                    a, b = todo.pop()
                    for c in range(max(0, a - 1), min(h, a + 2)):
                        for d in range(max(0, b - 1), min(w, b + 2)):
                            if mask[c, d] and not out[c, d]:
                                out[c, d] = name
                                todo.append((c, d))
    return out


@pytest.mark.parametrize(("h", "w", "share"), [(1, 1, 1.0), (1, 30, 0.5), (30, 1, 0.5), (20, 31, 0.35), (40, 40, 0.6), (9, 9, 0.0), (9, 9, 1.0)])
def test_labels_equal_a_flood(h, w, share):
    for seed in range(5):
        m = (np.random.default_rng(seed).random((h, w)) < share).astype(np.uint8)
        assert (masks.labels(m) == flood(m)).all()


def test_labels_of_a_long_spiral():
    import time

    m = spiral(450)
    assert m.sum() > 10**5
    began = time.perf_counter()
    assert set(np.unique(masks.labels(m))) == {0, 1} and time.perf_counter() - began < 3
    comb = np.zeros((600, 600), np.uint8)
    comb[:, ::2] = 1
    comb[-1] = 1
    assert set(np.unique(masks.labels(comb))) == {0, 1}


def test_pair_flows_by_matrices(spark):
    """Against 4 x 4 matrices and a sampler of one point at a time."""
    rng, h, w, k = np.random.default_rng(4), 5, 7, [6.0, 7.0, 3.0, 2.0]
    t, q, z = rng.normal(size=(3, 3)) * 0.2, np.concatenate([rng.normal(size=(3, 3)) * 0.05, np.ones((3, 1))], axis=1), rng.uniform(1.5, 4, (3, h, w))
    z[1, 0, 0] = 0.0

    def matrix(t, q):
        x, y, z_, w_ = q / np.linalg.norm(q)
        r = np.array([[1 - 2 * (y * y + z_ * z_), 2 * (x * y - z_ * w_), 2 * (x * z_ + y * w_)], [2 * (x * y + z_ * w_), 1 - 2 * (x * x + z_ * z_), 2 * (y * z_ - x * w_)], [2 * (x * z_ - y * w_), 2 * (y * z_ + x * w_), 1 - 2 * (x * x + y * y)]])
        m = np.eye(4)
        m[:3, :3], m[:3, 3] = r.T, -r.T @ t
        return np.array([[0, 1, 0, 0], [0, 0, 1, 0], [1, 0, 0, 0], [0, 0, 0, 1.0]]) @ m

    pose = [matrix(*p) for p in zip(t, q)]
    inner = np.array([[k[0], 0, k[2]], [0, k[1], k[3]], [0, 0, 1]])

    def flow(a, b):
        rel, out = pose[b] @ np.linalg.inv(pose[a]), np.zeros((h, w, 2))
        for y in range(h):
            for x in range(w):
                p = rel[:3, :3] @ (np.linalg.inv(inner) @ [x, y, 1] * z[a, y, x]) + rel[:3, 3]
                p = inner @ p
                out[y, x] = p[:2] / p[2] - [x, y]
        return out

    def at(f, y, x):
        y0, x0 = int(np.floor(y)), int(np.floor(x))
        return sum(((y - y0) if a else 1 - y + y0) * ((x - x0) if b else 1 - x + x0) * (f[y0 + a, x0 + b] if 0 <= y0 + a < h and 0 <= x0 + b < w else 0) for a in (0, 1) for b in (0, 1))

    e = lambda n, s: [F.get(n, F.lit(i)) for i in range(s)]
    poses = spark.createDataFrame([(i, t[i].tolist(), q[i].tolist()) for i in range(3)], "frame int, t array<double>, q array<double>")
    poses = poses.select("frame", geometry.camera_pose(e("t", 3), e("q", 4)).alias("pose"))
    depths = spark.createDataFrame([(i, y, x, float(z[i, y, x])) for i in range(3) for y in range(h) for x in range(w)], "frame int, y int, x int, depth double")
    got = {(r["i"], r["j"], r["y"], r["x"]): r for r in geometry.pair_flows(spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "i int, j int"), poses, depths, h, w, k).collect()}
    assert len(got) == 3 * h * w
    seen = set()
    for i, j in ((0, 1), (0, 2), (1, 2)):
        there, back = flow(i, j), flow(j, i)
        for y in range(h):
            for x in range(w):
                f = there[y, x]
                ok = np.linalg.norm(f + at(back, y + f[1], x + f[0])) < 0.1 * h
                r = got[i, j, y, x]
                assert r["valid"] == ok and np.allclose([r["u"], r["v"]], f if ok else 0)
                seen.add(bool(ok))
    assert seen == {True, False}


def lowest(py, px, valid):
    """The triangle of valid points around a pixel over which the paraboloid is lowest, by all triples."""
    from itertools import combinations

    from flowframe.operators.holes import height

    best = None
    for t in combinations(np.argwhere(valid).tolist(), 3):
        (a, b), (c, d), (e, f) = t
        det = (c - a) * (f - b) - (e - a) * (d - b)
        if det:
            l1, l2 = ((py - a) * (f - b) - (e - a) * (px - b)) / det, ((c - a) * (px - b) - (py - a) * (d - b)) / det
            wt = (1 - l1 - l2, l1, l2)
            if min(wt) > -1e-12:
                z = sum(k * height(y - py, x - px) for k, (y, x) in zip(wt, t))
                if best is None or z < best[0] - 1e-12:
                    best = z, t, wt
    return best


@pytest.mark.parametrize(("seed", "h", "w", "share"), [(0, 5, 6, 0.7), (1, 6, 5, 0.4), (2, 1, 8, 0.5), (3, 5, 5, 0.1), (4, 7, 4, 0.9)])
def test_holes_are_filled_from_empty_circles(spark, seed, h, w, share):
    from flowframe.operators import holes

    rng = np.random.default_rng(seed)
    valid, u, v = rng.random((h, w)) < share, rng.normal(size=(h, w)), rng.normal(size=(h, w))
    d = spark.createDataFrame([(1, h, w, u.ravel().tolist(), v.ravel().tolist(), valid.astype(float).ravel().tolist())], "k int, h int, w int, u array<double>, v array<double>, valid array<double>")
    r = holes.without_holes(d, "k", ["u", "v"]).first()
    got = np.array(r["u"]).reshape(h, w), np.array(r["v"]).reshape(h, w)
    for y in range(h):
        for x in range(w):
            if valid[y, x]:
                assert got[0][y, x] == u[y, x] and got[1][y, x] == v[y, x]
                continue
            best = lowest(y, x, valid)
            for out, plane in zip(got, (u, v)):
                assert np.isclose(out[y, x], 0 if best is None else sum(k * plane[tuple(p)] for k, p in zip(best[2], best[1])))
            if best is not None and min(best[2]) > 1e-9:  # on an edge any third corner would do; else the circle holds no valid point
                (a, b), (c, d_), (e, f) = np.array(best[1], float)
                m = np.linalg.solve(2 * np.array([[c - a, d_ - b], [e - a, f - b]]), [c * c + d_ * d_ - a * a - b * b, e * e + f * f - a * a - b * b])
                apart = np.hypot(*(np.argwhere(valid) - m).T)
                assert (apart > np.hypot(a - m[0], b - m[1]) - 1e-6).all()


def test_a_plane_survives_a_large_hole():
    import time

    from flowframe.operators import holes

    y, x = np.mgrid[0:90, 0:120].astype(float)
    plane, valid = 3 * y - 2 * x + 1, np.ones((90, 120), bool)
    valid[20:60, 30:90] = False
    valid[np.random.default_rng(0).random((90, 120)) < 0.1] = False
    valid[[0, 0, -1, -1], [0, -1, 0, -1]] = True
    began = time.perf_counter()
    out = holes.filled([plane], valid)[0]
    assert np.allclose(out, plane) and time.perf_counter() - began < 30
    valid[0] = False
    assert (holes.filled([plane], valid)[0][0] == 0).all()


def test_sheets_become_files(spark, tmp_path):
    from flowframe.operators import panels
    from flowframe.sources import exports

    h, w = 3, 4
    pixels = [(k, y, x, float(40 * k + 10 * y + x)) for k in (1, 2) for y in range(h) for x in range(w)]
    d = spark.createDataFrame(pixels, "k int, y int, x int, c double")
    parts = [(0, 0, panels.gray(d, "k", F.col("c"))), (0, 1, panels.gray(d, "k", F.col("c") * 1000)), (1, 1, panels.gray(d, "k", -F.col("c")).withColumn("r", F.lit(7)))]
    high, wide = panels.extent(parts, h, w, 1)
    assert (high, wide) == (7, 9)
    done = panels.whole(panels.sheet(parts, "k", h, w, 1), "k", high, wide, 9)
    exports.write_files(exports.encoded(done, F.concat(F.lit("sheets/"), F.col("k").cast("string"), F.lit(".png")), codecs.write_png_bytes, ["r", "g", "b"]), str(tmp_path))
    for k in (1, 2):
        image = codecs.read_png((tmp_path / f"sheets/{k}.png").read_bytes())
        own = np.array([[40 * k + 10 * y + x for x in range(w)] for y in range(h)])
        assert image.shape == (7, 9, 3) and (image[:3, :4] == own[..., None]).all() and (image[:3, 5:] == 255).all()
        assert (image[4:, 5:] == [7, 0, 0]).all() and (image[3] == 9).all() and (image[4:, :5] == 9).all()


def test_prefetch_skips_before_it_decodes(spark):
    import io

    from flowframe.plans.prefetch import prefetched
    from flowframe.sources.frames import Stack

    def clip(n, value):
        out = io.BytesIO()
        np.save(out, (np.arange(1, n + 1)[:, None, None] * value + np.zeros((n, 2, 3))).astype(np.uint8))
        return bytearray(out.getvalue())

    lit = np.zeros((12, 2, 3), np.uint8)
    lit[1:] = 9  # the first frame alone is black
    late = io.BytesIO()
    np.save(late, lit)
    tasks = [(1, 10.0, 0.0, 1.25, clip(12, 3)), (2, 10.0, 0.0, 1.25, clip(12, 3)), (3, 10.0, 0.0, 0.2, clip(2, 3)), (4, 10.0, 0.0, 1.25, bytearray(b"junk")), (5, 10.0, 0.0, 1.25, clip(12, 0)), (6, 10.0, 0.0, 1.25, bytearray(late.getvalue())), (7, 10.0, 0.5, 1.75, bytearray(clip(17, 7)))]
    d = spark.createDataFrame(tasks, "k int, fps double, start double, end double, clip binary")
    opened = spark.sparkContext.accumulator(0)

    def counted(raw):
        opened.add(1)
        return Stack(raw)

    pairs, told = prefetched(d, spark.createDataFrame([(2,)], "k int"), ["k"], [counted], source="clip")
    assert {r["k"]: r["status"] for r in told.collect()} == {1: "ready", 2: "skipped", 3: "empty", 4: "failed", 5: "black", 6: "black", 7: "ready"}
    assert all((r["error"] is not None) == (r["status"] == "failed") for r in told.collect())
    got = {(r["k"], r["pair_type"]): (r["tgt_long"], r["first_image"][0], r["second_image"][0]) for r in pairs.collect()}
    # 10 frames a second sampled at 5: every second one, long offset 5 samples, short offset 1
    assert got == {(1, "long"): (10, 33, 3), (1, "short_fwd"): (10, 33, 27), (1, "short_bwd"): (10, 27, 33), (7, "long"): (10, 112, 42), (7, "short_fwd"): (10, 112, 98), (7, "short_bwd"): (10, 98, 112)}
    assert opened.value == 5  # neither the one that is done nor the one without a triplet


def test_metadata_and_episodes_of_a_folder(spark, tmp_path):
    import json

    (tmp_path / "a/meta/episodes/chunk").mkdir(parents=True)
    (tmp_path / "b/meta").mkdir(parents=True)
    (tmp_path / "a/meta/info.json").write_text(json.dumps({"robot_type": "arm", "fps": 24, "video_path": "videos/{x}.mp4", "more": [1]}, indent=1))
    (tmp_path / "b/meta/info.json").write_text("{}")
    info = {r["file"].split("/")[-3]: (r["robot_type"], r["fps"], r["video_path"]) for r in readers.read_info(spark, str(tmp_path / "*/meta/info.json")).collect()}
    assert info == {"a": ("arm", 24.0, "videos/{x}.mp4"), "b": ("unknown", 30.0, None)}
    names = [f"videos/{c}/{f}" for c in ("left.eye", "top") for f in ("chunk_index", "file_index", "from_timestamp", "to_timestamp")]
    spark.createDataFrame([(0, 9, 1, 2, 0.5, 1.5, 3, 4, 0.0, 2.0), (1, 7, 1, 3, 1.5, 2.5, 3, 5, 2.0, 3.0)], ["episode_index", "length", *names]).write.parquet(str(tmp_path / "a/meta/episodes/chunk/p"))
    got = sorted(map(tuple, readers.read_episodes(spark, str(tmp_path / "a/meta/episodes")).collect()))
    assert got == [(0, 9, "left.eye", 1, 2, 0.5, 1.5), (0, 9, "top", 3, 4, 0.0, 2.0), (1, 7, "left.eye", 1, 3, 1.5, 2.5), (1, 7, "top", 3, 5, 2.0, 3.0)]
