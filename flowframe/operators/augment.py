"""Training mixes and seeded augmentation of samples, as column plans.

What happens to a sample is a *recipe*, a struct of numbers that are drawn from hashes of its key, the seed and the epoch
(``recipes``), or given by the caller. Recipes are carried out by expressions: colours and erased rectangles on the packed
image, and scale, stretch, mirroring and cut by looking up, for each pixel that is kept, the four source pixels around the
place it comes from. Nothing is shuffled, no pixel that is cut away is made, and a task that runs again gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .rle import _let

# fixed values: strengths and chances of the augmentations
BRIGHTNESS, CONTRAST, SATURATION, HUE = 0.4, 0.4, 0.4, 0.5 / 3.14
APART, ERASE, SPATIAL, STRETCH, FLIP_X, FLIP_Y = 0.2, 0.5, 0.8, 0.8, 0.5, 0.1
MAX_STRETCH = 0.2
# fixed values: the least side of an erased rectangle, and how many sides there are from it on
HOLE = (50, 50)

# fixed values: parts of each training mix as (dataset, pass, copies, least scale, greatest scale, flips)
MIXES = {
    "chairs": [("chairs", None, 1, -0.1, 1.0, True)],
    "things": [("things", "clean", 1, -0.4, 0.8, True), ("things", "final", 1, -0.4, 0.8, True)],
    "cplust": [("things", "clean", 1, -0.4, 0.8, True), ("things", "final", 1, -0.4, 0.8, True), ("chairs", None, 1, -0.4, 0.8, True)],
    "sintel": [("sintel", "clean", 1, -0.2, 0.6, True), ("sintel", "final", 1, -0.2, 0.6, True)],
    "kitti": [("kitti", None, 1, -0.2, 0.4, False)],
    "spring": [("spring", "train", 1, 0.0, 0.2, True), ("spring", "val", 1, 0.0, 0.2, True)],
    "tartanair": [("tartanair", None, 1, -0.2, 0.2, True)],
    "TSKH": [("sintel", "clean", 20, -0.2, 0.6, True), ("sintel", "final", 20, -0.2, 0.6, True), ("kitti", None, 80, -0.3, 0.5, True), ("hd1k", None, 30, -0.5, 0.2, True), ("things", "clean", 1, -0.4, 0.8, True), ("things", "final", 1, -0.4, 0.8, True)],
}


def mix(spark: SparkSession, name: str, scale: float = 0.0) -> DataFrame:
    """The parts of a training mix as rows; the scales are moved by ``scale``. An unknown name is an error."""
    rows = [(d, p, n, a + scale, b + scale, f) for d, p, n, a, b, f in MIXES[name]]
    return spark.createDataFrame(rows, "dataset string, pass string, copies int, min_scale double, max_scale double, do_flip boolean")


def mixed(samples: DataFrame, parts: DataFrame) -> DataFrame:
    """Samples (dataset, pass, ...) of the mix with their part's settings, each as often as its part says (``copy`` from 1).

    A part has few rows, six at most, so it is sent to every task and samples are not shuffled.
    """
    p = parts.select(F.col("dataset").alias("__d"), F.col("pass").alias("__p"), "copies", "min_scale", "max_scale", "do_flip")
    hit = samples.join(F.broadcast(p), (F.col("dataset") == F.col("__d")) & F.col("pass").eqNullSafe(F.col("__p")))
    return hit.select(*samples.columns, "min_scale", "max_scale", "do_flip", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))


def shuffled(samples: DataFrame, key: list[str], seed: int, epoch: int = 0) -> DataFrame:
    """Samples in an order that hangs on key, seed and epoch alone, sorted over all tasks."""
    return samples.orderBy(F.xxhash64(*key, F.lit(seed), F.lit(epoch)), *key)


def drawn(key: str, seed: int, epoch: int, name: str) -> Column:
    """A number from 0 to below 1 that hangs on these alone."""
    return F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed), F.lit(epoch), F.lit(name)), 11) / F.lit(float(1 << 53))


def recipes(samples: DataFrame, key: str, crop: tuple[int, int], seed: int, epoch: int = 0) -> DataFrame:
    """``samples`` (key, h, w, min_scale, max_scale, do_flip, ...) with ``first`` and ``second`` colours as ``colours``, the
    rectangles of the second image to be erased as ``holes``, and ``place``: the size that the sample takes, whether it is
    mirrored, and where the cut of size ``crop`` begins.

    A sample smaller than the cut counts as padded below and on the right; no axis gets smaller than the cut.
    """
    u = lambda name: drawn(key, seed, epoch, name)
    within = lambda name, a, b: F.lit(a) + u(name) * (F.lit(b) - F.lit(a)) if not isinstance(a, str) else F.col(a) + u(name) * (F.col(b) - F.col(a))
    near = lambda name, reach: within(name, max(0.0, 1 - reach), 1 + reach)
    colour = lambda i: F.struct(near(f"brightness{i}", BRIGHTNESS).alias("brightness"), near(f"contrast{i}", CONTRAST).alias("contrast"), near(f"saturation{i}", SATURATION).alias("saturation"), within(f"hue{i}", -HUE, HUE).alias("hue"))
    whole = lambda name, a, n: (F.lit(a) + F.floor(u(name) * n)).cast("int")
    hole = lambda i: F.struct(whole(f"top{i}", 0, F.col("h")).alias("y"), whole(f"left{i}", 0, F.col("w")).alias("x"), whole(f"height{i}", *HOLE).alias("dy"), whole(f"width{i}", *HOLE).alias("dx"))
    holes = F.when(u("erase") < ERASE, F.when(u("twice") < 0.5, F.array(hole(0), hole(1))).otherwise(F.array(hole(0)))).otherwise(F.array().cast("array<struct<y:int,x:int,dy:int,dx:int>>"))
    sides = {}
    for n, c in zip("hw", crop):
        full = F.greatest(F.col(n), F.lit(c))
        by = F.pow(F.lit(2.0), within("scale", "min_scale", "max_scale") + F.when(u("stretch") < STRETCH, within(f"stretch {n}", -MAX_STRETCH, MAX_STRETCH)).otherwise(0.0))
        to = F.greatest(F.round(full * F.greatest(by, (c + 1) / full)).cast("int"), F.lit(c))
        sides[n] = F.when(u("spatial") < SPATIAL, to).otherwise(full).cast("int")
    start = lambda n, c: F.floor(u(f"cut {n}") * F.greatest(sides[n] - c, F.lit(1))).cast("int")
    flip = lambda name, chance: F.col("do_flip") & (u(name) < chance)
    place = F.struct(sides["h"].alias("h"), sides["w"].alias("w"), flip("mirror x", FLIP_X).alias("flip_x"), flip("mirror y", FLIP_Y).alias("flip_y"), start("h", crop[0]).alias("top"), start("w", crop[1]).alias("left"))
    second = F.when(u("apart") < APART, colour(1)).otherwise(colour(0))
    return samples.withColumns({"colours": F.struct(colour(0).alias("first"), second.alias("second")), "holes": holes, "place": place})


_GRAY = (0.299, 0.587, 0.114)


def _gray(p: Column) -> Column:
    return p["r"] * _GRAY[0] + p["g"] * _GRAY[1] + p["b"] * _GRAY[2]


def _each(p: Column, f) -> Column:
    return F.struct(*[F.greatest(F.lit(0.0), F.least(F.lit(255.0), f(p[c]))).alias(c) for c in "rgb"])


def _mean(pixels: Column, f) -> Column:
    return F.aggregate(pixels, F.lit(0.0), lambda a, p: a + f(p)) / F.size(pixels)


def turned(p: Column, turn: Column) -> Column:
    """A colour moved by a share of the colour circle; its largest and its smallest channel stay what they are."""
    top, low = F.greatest(p["r"], p["g"], p["b"]), F.least(p["r"], p["g"], p["b"])
    span = F.when(top > low, top - low).otherwise(1.0)
    hue = F.when(top == p["r"], (p["g"] - p["b"]) / span).when(top == p["g"], 2 + (p["b"] - p["r"]) / span).otherwise(4 + (p["r"] - p["g"]) / span) / 6 + turn

    def channel(middle: float) -> Column:
        away = F.abs(F.pmod(hue - middle + 0.5, F.lit(1.0)) - 0.5) * 6
        return low + (top - low) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 - away))

    return F.struct(channel(0.0).alias("r"), channel(1 / 3).alias("g"), channel(2 / 3).alias("b"))


def coloured(pixels: Column, colour: Column) -> Column:
    """Packed pixels (array of struct r, g, b, from 0 to 255) under brightness, contrast around the mean gray, saturation and
    hue, in this order; every step stays within the range."""
    bright = F.transform(pixels, lambda p: _each(p, lambda c: c * colour["brightness"]))
    flat = _let(bright, lambda a: _let(_mean(a, _gray), lambda m: F.transform(a, lambda p: _each(p, lambda c: c * colour["contrast"] + m * (1 - colour["contrast"])))))
    deep = F.transform(flat, lambda p: _each(p, lambda c: c * colour["saturation"] + _gray(p) * (1 - colour["saturation"])))
    return F.transform(deep, lambda p: turned(p, colour["hue"]))


def erased(pixels: Column, holes: Column, w: Column) -> Column:
    """Packed pixels of an image ``w`` wide with each rectangle (y, x, dy, dx) in the mean colour of the image."""

    def hit(i: Column) -> Column:
        y, x = F.floor(i / w), i % w
        return F.exists(holes, lambda r: (y >= r["y"]) & (y < r["y"] + r["dy"]) & (x >= r["x"]) & (x < r["x"] + r["dx"]))

    mean = lambda a: F.struct(*[_mean(a, lambda p, c=c: p[c]).alias(c) for c in "rgb"])
    gone = lambda a: _let(mean(a), lambda m: F.transform(a, lambda p, i: F.when(hit(i), m).otherwise(p)))
    return F.when(F.size(holes) == 0, pixels).otherwise(_let(pixels, gone))


def placed(samples: DataFrame, key: str, crop: tuple[int, int], images: tuple[str, ...] = ()) -> DataFrame:
    """(key, y, x, u, v, valid, images) of the cut that ``place`` makes of packed fields (h, w, u, v, valid) and images.

    A displacement is the mean of the valid ones around it by their weights, times the scale of its axis, with the sign that
    mirroring gives it; where valid pixels weigh half or less, and in padding, it is 0 and not valid.
    """
    ch, cw = crop
    rows = samples.select(key, "h", "w", "u", "v", "valid", "place", *images, F.explode(F.sequence(F.lit(0), F.lit(ch * cw - 1))).alias("q"))
    y, x = F.floor(F.col("q") / cw).cast("int"), (F.col("q") % cw).cast("int")
    rows = rows.withColumns({"y": y, "x": x, "full_h": F.greatest("h", F.lit(ch)), "full_w": F.greatest("w", F.lit(cw))})

    def source(n: str, at: str, start: str, flip: str) -> Column:
        to, full = F.col(f"place.{n}"), F.col(f"full_{n}")
        i = F.col(f"place.{start}") + F.col(at)
        i = F.when(F.col(f"place.{flip}"), to - 1 - i).otherwise(i)
        return F.least(F.greatest((i + 0.5) * (full / to) - 0.5, F.lit(0.0)), (full - 1).cast("double"))

    rows = rows.withColumns({"sy": source("h", "y", "top", "flip_y"), "sx": source("w", "x", "left", "flip_x")})
    rows = rows.withColumns({"y0": F.floor("sy").cast("int"), "x0": F.floor("sx").cast("int")}).withColumns({"fy": F.col("sy") - F.col("y0"), "fx": F.col("sx") - F.col("x0")})
    corners = [(a, b, (F.col("fy") if a else 1 - F.col("fy")) * (F.col("fx") if b else 1 - F.col("fx"))) for a in (0, 1) for b in (0, 1)]

    def at(name: str, a: int, b: int) -> Column:
        yy, xx = F.least(F.col("y0") + a, F.col("full_h") - 1), F.least(F.col("x0") + b, F.col("full_w") - 1)
        return F.when((yy < F.col("h")) & (xx < F.col("w")), F.get(F.col(name), yy * F.col("w") + xx))

    good = [wt * F.when(F.coalesce(at("valid", a, b) > 0.5, F.lit(False)), 1.0).otherwise(0.0) for a, b, wt in corners]
    rows = rows.withColumns({f"g{i}": c for i, c in enumerate(good)}).withColumn("share", F.col("g0") + F.col("g1") + F.col("g2") + F.col("g3"))
    mean = lambda name: sum((F.col(f"g{i}") * F.coalesce(at(name, a, b), F.lit(0.0)) for i, (a, b, _) in enumerate(corners)), F.lit(0.0)) / (F.col("share") + 1e-5)
    signed = lambda name, n, flip: F.when(F.col("share") > 0.5, mean(name) * F.col(f"place.{n}") / F.col(f"full_{n}") * F.when(F.col(f"place.{flip}"), -1.0).otherwise(1.0)).otherwise(0.0).alias(name)
    shade = lambda name: F.struct(*[sum((wt * F.coalesce(at(name, a, b)[c], F.lit(0.0)) for a, b, wt in corners), F.lit(0.0)).alias(c) for c in "rgb"]).alias(name)
    return rows.select(key, "y", "x", signed("u", "w", "flip_x"), signed("v", "h", "flip_y"), (F.col("share") > 0.5).alias("valid"), *[shade(n) for n in images])


def augment(samples: DataFrame, key: str, crop: tuple[int, int], seed: int, epoch: int = 0) -> DataFrame:
    """(key, y, x, u, v, valid, first, second) of the cut of each sample, a row a pixel; ``fields.packed`` packs them again.

    ``samples`` has (key, h, w, first, second, u, v, valid, min_scale, max_scale, do_flip); images are packed pixels, arrays of
    struct (r, g, b). Keys that repeat get the same recipe.
    """
    rows = recipes(samples, key, crop, seed, epoch)
    rows = rows.withColumns({"first": coloured(F.col("first"), F.col("colours.first")), "second": erased(coloured(F.col("second"), F.col("colours.second")), F.col("holes"), F.col("w"))})
    return placed(rows, key, crop, ("first", "second"))
