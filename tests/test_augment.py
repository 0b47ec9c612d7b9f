import colorsys

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowframe.functions.registry import register
from flowframe.operators import augment, ordering
from flowframe.sources import codecs


def pixels(image):
    return [tuple(float(c) for c in p) for p in image.reshape(-1, 3)]


PIXELS = "array<struct<r:double,g:double,b:double>>"


def test_hue_is_that_of_the_colour_circle(spark):
    rng = np.random.default_rng(0)
    image = rng.integers(0, 256, (42, 3)).astype(float)
    image[0] = 9
    d = spark.createDataFrame([(pixels(image),)], f"p {PIXELS}")
    for turn in (0.0, 0.13, -0.4):
        got = d.select(F.transform("p", lambda p: augment.turned(p, F.lit(turn))).alias("q")).first()["q"]  # noqa: B023
        for p, q in zip(image, got):
            h, s, v = colorsys.rgb_to_hsv(*p / 255)
            assert np.allclose(np.array(q) / 255, colorsys.hsv_to_rgb((h + turn) % 1, s, v))


def test_colours_and_holes_by_their_definition(spark):
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (6, 8, 3)).astype(float)
    d = spark.createDataFrame([(pixels(image), (1.3, 0.7, 1.4, 0.0), [(1, 2, 3, 100), (5, 0, 1, 1)], [])], f"p {PIXELS}, c struct<brightness:double,contrast:double,saturation:double,hue:double>, holes array<struct<y:int,x:int,dy:int,dx:int>>, none array<struct<y:int,x:int,dy:int,dx:int>>")
    cut = lambda a: np.clip(a, 0, 255)
    gray = lambda a: a @ np.array([0.299, 0.587, 0.114])
    want = cut(image * 1.3)
    want = cut(want * 0.7 + gray(want).mean() * 0.3)
    want = cut(want * 1.4 + gray(want)[..., None] * -0.4)
    r = d.select(augment.coloured(F.col("p"), F.col("c")).alias("a"), augment.erased(F.col("p"), F.col("holes"), F.lit(8)).alias("b"), (augment.erased(F.col("p"), F.col("none"), F.lit(8)) == F.col("p")).alias("same")).first()
    assert np.allclose(np.array(r["a"]).reshape(6, 8, 3), want) and r["same"]
    gone = image.copy()
    gone[1:4, 2:] = gone[5, 0] = image.reshape(-1, 3).mean(axis=0)
    assert np.allclose(np.array(r["b"]).reshape(6, 8, 3), gone)


def by_pixel(field, valid, place, crop):
    """The cut of a field, one pixel after the other."""
    to_h, to_w, flip_x, flip_y, top, left = place
    h, w = (max(n, c) for n, c in zip(valid.shape, crop))
    out, ok = np.zeros((*crop, 2)), np.zeros(crop, bool)
    for y in range(crop[0]):
        for x in range(crop[1]):
            i, j = top + y, left + x
            i, j = to_h - 1 - i if flip_y else i, to_w - 1 - j if flip_x else j
            sy, sx = min(max((i + 0.5) * h / to_h - 0.5, 0), h - 1), min(max((j + 0.5) * w / to_w - 0.5, 0), w - 1)
            share, total = 0.0, np.zeros(2)
            for a in (0, 1):
                for b in (0, 1):
                    p, q = min(int(sy) + a, h - 1), min(int(sx) + b, w - 1)
                    wt = (sy % 1 if a else 1 - sy % 1) * (sx % 1 if b else 1 - sx % 1)
                    if p < valid.shape[0] and q < valid.shape[1] and valid[p, q] > 0.5:
                        share, total = share + wt, total + wt * field[p, q]
            if share > 0.5:
                ok[y, x] = True
                out[y, x] = total / (share + 1e-5) * [to_w / w * (-1 if flip_x else 1), to_h / h * (-1 if flip_y else 1)]
    return out, ok


@pytest.mark.parametrize(("h", "w", "crop"), [(10, 14, (6, 7)), (4, 5, (6, 7)), (6, 7, (6, 7))])
def test_places_equal_one_pixel_after_the_other(spark, h, w, crop):
    rng, rows, want = np.random.default_rng(h), [], {}
    for k in range(6):
        field, valid = rng.normal(size=(h, w, 2)), (rng.random((h, w)) < 0.8).astype(float)
        to = [int(rng.integers(c, 2 * c)) for c in crop]
        place = (*to, bool(k % 2), bool(k % 3), *[int(rng.integers(0, t - c + 1)) for t, c in zip(to, crop)])
        rows.append((k, h, w, field[..., 0].ravel().tolist(), field[..., 1].ravel().tolist(), valid.ravel().tolist(), place, [(1.0, 2.0, 3.0)] * (h * w)))
        want[k] = by_pixel(field, valid, place, crop)
    d = spark.createDataFrame(rows, f"k int, h int, w int, u array<double>, v array<double>, valid array<double>, place struct<h:int,w:int,flip_x:boolean,flip_y:boolean,top:int,left:int>, image {PIXELS}")
    got = augment.placed(d, "k", crop, ("image",)).collect()
    assert len(got) == 6 * crop[0] * crop[1]
    for r in got:
        out, ok = want[r["k"]]
        assert r["valid"] == ok[r["y"], r["x"]] and np.allclose([r["u"], r["v"]], out[r["y"], r["x"]])
        assert not r["valid"] or r["image"]["r"] > 0.5 * 1.0 - 1e-9


def test_recipes_hang_on_the_key_and_the_seed_and_keep_their_ranges(spark):
    crop = (16, 24)
    sizes = [(40, 60), (10, 12), (16, 24), (17, 90)]
    d = spark.createDataFrame([(k, *sizes[k % 4], -0.3, 0.6, k % 5 > 0) for k in range(2000)], "k int, h int, w int, min_scale double, max_scale double, do_flip boolean")
    rows = {r["k"]: r for r in augment.recipes(d, "k", crop, 3).collect()}
    assert rows == {r["k"]: r for r in augment.recipes(d.repartition(5), "k", crop, 3).collect()}
    other = {r["k"]: r for r in augment.recipes(d, "k", crop, 3, epoch=1).collect()}
    assert sum(rows[k]["place"] == other[k]["place"] for k in rows) < 200
    for k, r in rows.items():
        p, (h, w) = r["place"], sizes[k % 4]
        for to, start, c, n in ((p["h"], p["top"], crop[0], h), (p["w"], p["left"], crop[1], w)):
            assert c <= to <= max(c + 2, max(n, c) * 2**0.8 + 1) and 0 <= start <= to - c
        assert r["do_flip"] or not (p["flip_x"] or p["flip_y"])
        assert all(0.6 <= r["colours"][i][c] <= 1.4 for i in ("first", "second") for c in ("brightness", "contrast", "saturation"))
        assert len(r["holes"]) <= 2 and all(50 <= o["dy"] < 100 and 50 <= o["dx"] < 100 and 0 <= o["y"] < h and 0 <= o["x"] < w for o in r["holes"])
    share = lambda f: sum(map(f, rows.values())) / len(rows)
    assert abs(share(lambda r: len(r["holes"]) > 0) - 0.5) < 0.05 and abs(share(lambda r: r["colours"]["first"] != r["colours"]["second"]) - 0.2) < 0.05
    assert abs(share(lambda r: r["place"]["flip_x"]) - 0.4) < 0.05 and abs(share(lambda r: r["place"]["flip_y"]) - 0.08) < 0.03


def test_augmented_samples(spark):
    rng, h, w, crop = np.random.default_rng(0), 20, 30, (8, 12)
    rows = [(k, h, w, pixels(rng.integers(0, 256, (h, w, 3))), pixels(rng.integers(0, 256, (h, w, 3))), rng.normal(size=h * w).tolist(), rng.normal(size=h * w).tolist(), [1.0] * (h * w), -0.2, 0.6, True) for k in range(5)]
    d = spark.createDataFrame(rows, f"k int, h int, w int, first {PIXELS}, second {PIXELS}, u array<double>, v array<double>, valid array<double>, min_scale double, max_scale double, do_flip boolean")
    out = augment.augment(d, "k", crop, 7)
    got = out.collect()
    assert len(got) == 5 * 96 and all(r["valid"] and 0 <= r["first"]["r"] <= 255 and 0 <= r["second"]["b"] <= 255 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, augment.augment(d.repartition(3), "k", crop, 7).collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_mixes_and_shuffles(spark):
    d = spark.range(6).withColumnRenamed("id", "k")
    order = lambda epoch: [r["k"] for r in augment.shuffled(d.repartition(3), ["k"], 1, epoch).collect()]
    assert order(0) == order(0) and sorted(order(0)) == list(range(6)) and order(0) != order(1)
    with pytest.raises(KeyError):
        augment.mix(spark, "unknown")


@pytest.mark.parametrize("values", [[], [5], [3, 3, 3, 3], list("banana"), [None, 2, None, 1], list(range(1000, 0, -1))])
def test_ranks_over_ranges(spark, values):
    kind = "string" if values and isinstance(values[0], str) else "int"
    d = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(3)
    want = sorted(values, key=lambda v: (v is not None, v if v is not None else 0))
    for whole in (0, 1 << 16):
        got = sorted(((r["pos"], r["v"]) for r in ordering.ranked(d, "v", parts=7, whole=whole).collect()), key=lambda r: r[0])
        assert [v for _, v in got] == want and [p for p, _ in got] == list(range(len(values)))


def test_functions_of_sql(spark):
    assert "flo_decode" in register(spark)
    raw = codecs.write_flo(np.arange(12, dtype=np.float32).reshape(2, 3, 2))
    d = spark.createDataFrame([(bytearray(raw),), (bytearray(b"junk"),), (None,)], "raw binary")
    rows = [r["f"] for r in d.selectExpr("flo_decode(raw) as f").collect()]
    assert rows[0]["h"] == 2 and rows[0]["u"] == [0, 2, 4, 6, 8, 10] and rows[1]["h"] is None and rows[2]["h"] is None
    again = d.limit(1).selectExpr("flo_decode(raw) as f").selectExpr("flo_encode(f.h, f.w, f.u, f.v) as raw").first()["raw"]
    assert bytes(again) == raw
    assert spark.sql("select coco_decode(coco_encode(array(0, 1, 1, 1, 0, 0), 2, 3), 2, 3) as b").first()["b"] == [0, 1, 1, 1, 0, 0]
