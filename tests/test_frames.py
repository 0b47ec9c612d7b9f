import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowframe.operators import imaging
from flowframe.plans.annotate import BlockMatching, annotate
from flowframe.plans.inference import Wrapped, estimated
from flowframe.sources import codecs, exports, frames, readers


def _filtered(image, kind):
    """PNG of an image with one filter, by the definition of each filter."""
    h, w = image.shape[:2]
    step = (image.shape[2] if image.ndim == 3 else 1) * image.dtype.itemsize
    raw = np.ascontiguousarray(image.astype(f">u{image.dtype.itemsize}")).view(np.uint8).reshape(h, -1).astype(int)
    out = bytearray()
    for y in range(h):
        out.append(kind)
        for i in range(raw.shape[1]):
            a = raw[y, i - step] if i >= step else 0
            b = raw[y - 1, i] if y else 0
            c = raw[y - 1, i - step] if y and i >= step else 0
            p = a + b - c
            best = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out.append((raw[y, i] - [0, a, b, (a + b) // 2, best][kind]) % 256)
    chunk = lambda k, body: struct.pack(">I", len(body)) + k + body + struct.pack(">I", zlib.crc32(k + body))
    colour = {1: 0, 2: 4, 3: 2, 4: 6}[image.shape[2] if image.ndim == 3 else 1]
    head = struct.pack(">IIBBBBB", w, h, 8 * image.dtype.itemsize, colour, 0, 0, 0)
    return codecs.PNG + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(bytes(out))) + chunk(b"IEND", b"")


@pytest.mark.parametrize("kind", range(5))
@pytest.mark.parametrize("channels", range(1, 5))
@pytest.mark.parametrize("kind_of_number", [np.uint8, np.uint16])
def test_png_filters(kind, channels, kind_of_number):
    rng = np.random.default_rng(kind)
    image = rng.integers(0, 2 ** (8 * kind_of_number().itemsize), (4, 5, channels), dtype=kind_of_number)
    image = image[..., 0] if channels == 1 else image
    assert (codecs.read_png(_filtered(image, kind)) == image).all()


def test_disparity():
    field, valid = codecs.from_disparity(np.array([[0, 512]], np.uint16))
    assert field.tolist() == [[[0, 0], [-2, 0]]] and valid.tolist() == [[False, True]]
    assert codecs.read_field_valid("a.png", codecs.write_png(np.array([[256]], np.uint16)))[0].tolist() == [[[-1, 0]]]


def test_frames_by_time_range_and_fallback(spark, tmp_path):
    stack = np.random.default_rng(0).integers(0, 256, (40, 3, 4, 3), dtype=np.uint8)
    np.save(tmp_path / "a.npy", stack)
    path = str(tmp_path / "a.npy")

    def broken(p):
        raise OSError("no codec")

    tasks = spark.createDataFrame([(1, path, 10.0, 1.0, [0, 3, 7]), (2, path + "x", 10.0, 0.0, [0]), (3, path, 10.0, 3.5, [0, 30])], "k int, path string, fps double, start double, idx array<int>")
    rows = frames.decoded(tasks, ["k"], [broken, frames.Stack], batch=2).collect()
    got = {(r["k"], r["idx"]): r for r in rows}
    for i in (0, 3, 7):
        r = got[1, i]
        assert (np.frombuffer(r["pixels"], np.uint8).reshape(r["h"], r["w"], r["channels"]) == stack[10 + i]).all()
    assert "no codec" in got[2, None]["error"] and "FileNotFound" in got[2, None]["error"]
    assert (3, 0) in got and "no frame at" in got[3, None]["error"] and len(rows) == 6
    ranges = spark.createDataFrame([(1, path, 10.0, 1.0, 1.45), (2, path, 10.0, 3.8, 9.0), (3, path, 10.0, 5.0, 6.0)], "k int, path string, fps double, start double, end double")
    rows = frames.decoded(ranges, ["k"], [frames.Stack], by="range").collect()
    assert sorted((r["k"], r["idx"]) for r in rows if r["error"] is None) == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 1)]
    assert [r["k"] for r in rows if r["error"]] == [3]
    assert frames.decoded(ranges.limit(0), ["k"], [frames.Stack], by="range").count() == 0
    assert frames.byte_image(np.array([0.5, 1.0], np.float32)).tolist() == [127, 255]


def test_files_are_written_whole_and_again(spark, tmp_path):
    d = spark.createDataFrame([(i, 2, 3, [int(b) for b in f"{i:06b}"]) for i in range(9)], "k int, h int, w int, mask array<int>")
    files = exports.encoded(d, F.format_string("s/%04d.png", "k"), exports.mask_png, ["mask"])
    for _ in range(2):
        exports.write_files(files, str(tmp_path))
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == [f"{i:04d}.png" for i in range(9)]
    assert codecs.read_png((tmp_path / "s" / "0005.png").read_bytes()).tolist() == [[0, 0, 0], [255, 0, 255]]
    field = spark.createDataFrame([("clean", "a", 0, 1, 2, [1.0, 2.0], [3.0, 4.0])], "dstype string, seq string, frame int, h int, w int, u array<double>, v array<double>")
    exports.write_files(exports.encoded(field, exports.sintel_path(F.col("dstype"), F.col("seq"), F.col("frame")), codecs.write_flo, ["u", "v"]), str(tmp_path))
    assert codecs.read_flo((tmp_path / "clean" / "a" / "frame0001.flo").read_bytes()).tolist() == [[[1, 3], [2, 4]]]
    images = {r["path"][-8:]: r for r in readers.read_images(spark, str(tmp_path / "s")).collect()}
    assert len(images) == 9 and images["0005.png"]["h"] == 2 and images["0005.png"]["channels"] == 3 and images["0005.png"]["error"] is None


def test_mask_documents_are_read_back(spark, tmp_path):
    m = spark.createDataFrame([("a", 7, [4, 3, 3], [2, 4]), ("a", 2, [10], [2, 4])], "seq string, frame_idx int, counts array<int>, size array<int>")
    r = exports.mask_documents(m, ["seq"]).first()
    doc = json.loads(r["doc"])
    assert doc["metadata"] == {"num_frames": 2, "frame_indices": [2, 7], "image_size": [2, 4]} and r["num_frames"] == 2
    (tmp_path / "m.json").write_text(r["doc"])
    back = readers.read_masks(spark, str(tmp_path)).collect()
    assert sorted((b["frame_idx"], b["counts"]) for b in back) == [(2, [10]), (7, [4, 3, 3])]


@pytest.fixture
def difference():
    class Difference:  # local, so that workers get it by value
        def calc_flow(self, first, second):
            d = second.astype(float) - first
            return np.stack([d, -d, d * d])

    return Difference


def test_wrapping_a_pixel_wise_estimator_changes_nothing(difference):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 256, (2, 21, 34)).astype(float)
    want = difference().calc_flow(a, b)
    for size, tiled in ((None, False), ((16, 16), True), ((40, 16), True), ((40, 50), True), ((30, 40), False)):
        assert np.allclose(Wrapped(difference(), size=size, tiled=tiled).calc_flow(a, b), want)
    twice = Wrapped(difference(), scale=1.0).calc_flow(np.full((4, 4), 1.0), np.full((4, 4), 5.0))
    assert twice.shape == (3, 4, 4) and np.allclose(twice[0], 2) and np.allclose(twice[2], 16)


def test_convex_upsampling_is_its_definition():
    rng = np.random.default_rng(2)
    f, logits = rng.normal(size=(3, 4, 2)), rng.normal(size=(3, 4, 9, 2, 2))
    got = imaging.convex_upsampled(f, logits, 2.0)
    for y in range(6):
        for x in range(8):
            e = np.exp(logits[y // 2, x // 2, :, y % 2, x % 2])
            e /= e.sum()
            want = np.zeros(2)
            for k in range(9):
                yy, xx = y // 2 + k // 3 - 1, x // 2 + k % 3 - 1
                if 0 <= yy < 3 and 0 <= xx < 4:
                    want += e[k] * 2 * f[yy, xx]
            assert np.allclose(got[y, x], want)


def test_annotation_of_a_region_and_a_large_image(spark):
    rng = np.random.default_rng(0)
    a, b = np.zeros((48, 64), np.uint8), np.zeros((48, 64), np.uint8)
    a[16:32, 20:36] = b[16:32, 22:38] = rng.integers(50, 255, (16, 16))
    schema = "episode long, tgt_long long, pair_type string, h int, w int, first_image binary, second_image binary"
    rows = [(e, 5, kind, 48, 64, bytearray(a.tobytes()), bytearray(b.tobytes())) for e in range(5) for kind in ("long", "short_fwd", "short_bwd")]
    d = spark.createDataFrame(rows, schema)
    whole = {r["episode"]: np.array(r["mask"]).reshape(48, 64) for r in annotate(d, BlockMatching, min_area=20, batch=2).collect()}
    assert len(whole) == 5 and all((m == whole[0]).all() and m.sum() > 100 for m in whole.values())
    part = np.array(annotate(d.where("episode = 0"), BlockMatching, min_area=20, roi=(8, 12, 40, 99)).first()["mask"]).reshape(48, 64)
    assert part[:8].sum() == 0 and part[40:].sum() == 0 and part[:, :12].sum() == 0 and part.sum() > 100
    small = annotate(d.where("episode = 0"), BlockMatching, long_floor=0.5, min_area=4, limit=32).first()
    assert small["error"] is None and len(small["mask"]) == 48 * 64 and sum(small["mask"]) > 50
    assert annotate(d.limit(0), BlockMatching).count() == 0


def test_estimates_keep_rows_that_fail(spark, difference):
    d = spark.createDataFrame([(1, 2, 2, bytearray(b"\0\1\2\3"), bytearray(b"\1\1\1\1")), (2, 2, 2, bytearray(b"\0"), bytearray(b"\0\0\0\0"))], "k int, h int, w int, first_image binary, second_image binary")
    got = {r["k"]: r for r in estimated(d, ["k"], difference).collect()}
    assert got[1]["u"] == [1, 0, -1, -2] and got[1]["error"] is None and got[2]["u"] is None and got[2]["error"]
