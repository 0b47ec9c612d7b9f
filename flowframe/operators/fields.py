"""Two-component displacement fields: packed arrays, exploded pixels, and pixel-wise operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pixels(df: DataFrame, id_: str, array: str, h: int, w: int, scale: float = 1.0) -> DataFrame:
    """Packed (u then v, row-major) to one row a pixel: (id, y, x, u, v)."""
    n = h * w
    p = df.select(F.col(id_), F.posexplode(F.slice(array, 1, n)).alias("p", "u"), F.slice(array, n + 1, n).alias("vs"))
    d = lambda c: c.cast("double") * F.lit(scale)
    return p.select(F.col(id_), (F.col("p") / w).cast("int").alias("y"), (F.col("p") % w).alias("x"), d(F.col("u")).alias("u"), d(F.get("vs", F.col("p"))).alias("v"))


def coordinates(h: Column, w: Column) -> Column:
    """Array of (y, x) of an image's pixels, row by row."""
    return F.transform(F.sequence(F.lit(0), (h * w).cast("int") - 1), lambda i: F.struct(F.floor(i / w).cast("int").alias("y"), (i % w).cast("int").alias("x")))


def magnitude(u: Column | str = "u", v: Column | str = "v") -> Column:
    u, v = (F.col(c) if isinstance(c, str) else c for c in (u, v))
    return F.sqrt(u * u + v * v)


def finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def validity(limit: float = 1000.0) -> Column:
    """Both components finite and below the limit."""
    u, v = F.col("u"), F.col("v")
    return F.coalesce(finite(u) & finite(v) & (F.abs(u) < limit) & (F.abs(v) < limit), F.lit(False))


def scrubbed(df: DataFrame) -> DataFrame:
    """Non-finite components as 0, marked invalid."""
    ok = validity()
    zero = lambda c: F.when(finite(F.col(c)), F.col(c)).otherwise(F.lit(0.0)).alias(c)
    return df.select(*[c for c in df.columns if c not in ("u", "v")], zero("u"), zero("v"), ok.alias("valid"))


def cropped(df: DataFrame, y0: int, x0: int, y1: int, x1: int, h: int, w: int) -> DataFrame:
    """Pixels of a region clamped to the image, moved to its origin."""
    y0, y1, x0, x1 = max(0, y0), min(h, y1), max(0, x0), min(w, x1)
    return df.where(F.col("y").between(y0, y1 - 1) & F.col("x").between(x0, x1 - 1)).withColumns({"y": F.col("y") - y0, "x": F.col("x") - x0})


def subsampled(df: DataFrame, step: int = 2) -> DataFrame:
    return df.where((F.col("y") % step == 0) & (F.col("x") % step == 0)).withColumns({c: (F.col(c) / step).cast("int") for c in ("y", "x")})


def flipped(df: DataFrame, h: int, w: int, horizontal: bool = True) -> DataFrame:
    """Mirrored field; the component along the mirrored axis changes sign."""
    axis, part, n = ("x", "u", w) if horizontal else ("y", "v", h)
    return df.withColumns({axis: F.lit(n - 1) - F.col(axis), part: -F.col(part)})


def rescaled(df: DataFrame, sx: float, sy: float) -> DataFrame:
    return df.withColumns({"u": F.col("u") * sx, "v": F.col("v") * sy})


def resized_nearest(df: DataFrame, id_: str, h: int, w: int, to_h: int, to_w: int) -> DataFrame:
    """Each target pixel takes the source pixel at floor(i * size / target size), by fan-out of source pixels."""
    span = lambda c, n, m: F.filter(F.sequence(F.lit(0), F.lit(m - 1)), lambda i: F.floor(i * n / m) == F.col(c))
    out = df.withColumn("ty", F.explode(span("y", h, to_h))).withColumn("tx", F.explode(span("x", w, to_w)))
    return out.withColumns({"y": F.col("ty"), "x": F.col("tx")}).drop("ty", "tx")


def resized_area(df: DataFrame, id_: str, factor: int) -> DataFrame:
    """Means of factor x factor blocks, components divided by the factor."""
    out = df.groupBy(id_, (F.col("y") / factor).cast("int").alias("y"), (F.col("x") / factor).cast("int").alias("x"))
    return out.agg((F.avg("u") / factor).alias("u"), (F.avg("v") / factor).alias("v"))


def resized_linear(df: DataFrame, id_: str, parts: list[str], h: int, w: int, to_h: int, to_w: int, aligned: bool = False) -> DataFrame:
    """(id, y, x, parts) of packed row-major arrays ``parts``, sampled from the four source pixels around each target pixel.

    ``aligned`` maps corner pixels on corner pixels; otherwise pixels are areas, and what lies beyond the last centres takes
    their value. Arrays are read in place, so nothing is shuffled.
    """
    out = df.select(id_, *parts, F.explode(F.sequence(F.lit(0), F.lit(to_h * to_w - 1))).alias("q"))
    out = out.select(id_, *parts, F.floor(F.col("q") / to_w).cast("int").alias("y"), (F.col("q") % to_w).alias("x"))

    def source(t: str, n: int, m: int) -> Column:
        if aligned:
            return F.col(t) * ((n - 1) / (m - 1) if m > 1 else 0.0)
        return F.least(F.greatest((F.col(t) + 0.5) * (n / m) - 0.5, F.lit(0.0)), F.lit(n - 1.0))

    out = out.withColumns({"sy": source("y", h, to_h), "sx": source("x", w, to_w)})
    y0, x0 = F.least(F.floor("sy").cast("int"), F.lit(h - 1)), F.least(F.floor("sx").cast("int"), F.lit(w - 1))
    out = out.withColumns({"y0": y0, "x0": x0, "fy": F.col("sy") - y0, "fx": F.col("sx") - x0})
    y1, x1 = F.least(F.col("y0") + 1, F.lit(h - 1)), F.least(F.col("x0") + 1, F.lit(w - 1))
    fy, fx = F.col("fy"), F.col("fx")

    def value(a: str) -> Column:
        at = lambda y, x: F.get(F.col(a), y * w + x).cast("double")
        return (1 - fy) * ((1 - fx) * at(F.col("y0"), F.col("x0")) + fx * at(F.col("y0"), x1)) + fy * ((1 - fx) * at(y1, F.col("x0")) + fx * at(y1, x1))

    return out.select(id_, "y", "x", *[value(a).alias(a) for a in parts])


def packed(df: DataFrame, id_: str, parts: list[str]) -> DataFrame:
    """Pixels (id, y, x, parts) as one row an image with row-major arrays; an image must fit a row."""
    s = F.sort_array(F.collect_list(F.struct("y", "x", *parts)))
    return df.groupBy(id_).agg(s.alias("s")).select(id_, *[F.col(f"s.{p}").alias(p) for p in parts])


def kitti_raw(c: Column) -> Column:
    """A displacement as the whole number of its 16-bit channel: 64 steps a pixel around 2**15."""
    return F.floor(F.lit(64.0) * c + 2**15)


def kitti_value(raw: Column) -> Column:
    return (raw - 2**15) / 64


def disparity_field(raw: Column) -> tuple[Column, Column]:
    """The horizontal displacement and validity of a 16-bit disparity of 256 steps a pixel; 0 is unknown."""
    return -raw / 256, raw > 0


def blended(tiles: DataFrame, id_: str, parts: list[str], tile_h: int, tile_w: int) -> DataFrame:
    """(id, y, x, parts): means of the tiles (id, oy, ox, y, x, parts) over each pixel, weighted by a bell around each tile's
    middle, one tile's side wide. Sums are made in each task first."""
    off = lambda c, o, n: F.pow((F.col(c) - F.col(o) - F.lit((n - 1) / 2)) / n, F.lit(2.0))
    rows = tiles.withColumn("__wt", F.exp(-(off("y", "oy", tile_h) + off("x", "ox", tile_w)) / 2))
    return rows.groupBy(id_, "y", "x").agg(*[(F.sum(F.col("__wt") * F.col(p)) / F.sum("__wt")).alias(p) for p in parts])


def mask_share(c: Column) -> Column:
    """Validity of a mask in percent of what is hidden."""
    return 1 - c / 100


def three_channels(channels: Column) -> Column:
    """Gray as three equal channels; colours without alpha."""
    return F.when(F.size(channels) == 1, F.array_repeat(F.get(channels, F.lit(0)), 3)).otherwise(F.slice(channels, 1, 3))


# fixed values: means and deviations of the ImageNet channels
MEANS, DEVIATIONS = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)


def image_normalised(c: Column, channel: int) -> Column:
    return (c / 255 - MEANS[channel]) / DEVIATIONS[channel]


def strictly_inside(y: Column, x: Column, h: int, w: int) -> Column:
    """Whether a place lies between the centres of the outermost pixels, not on them."""
    return (y > 0) & (y < h - 1) & (x > 0) & (x < w - 1)


def sampled_bilinear(image: DataFrame, at: DataFrame, id_: str, h: int, w: int, value: str = "value") -> DataFrame:
    """``image`` (id, y, x, value) sampled at (id, y, x, py, px); zero outside. One equi-join for four corners."""
    y0, x0 = F.floor("py").cast("int"), F.floor("px").cast("int")
    fy, fx = F.col("py") - F.floor("py"), F.col("px") - F.floor("px")
    corner = lambda dy, dx: F.struct((y0 + dy).alias("cy"), (x0 + dx).alias("cx"), ((fy if dy else 1 - fy) * (fx if dx else 1 - fx)).alias("wt"))
    four = at.select(id_, "y", "x", F.inline(F.array(*[corner(a, b) for a in (0, 1) for b in (0, 1)])))
    src = image.select(F.col(id_), F.col("y").alias("cy"), F.col("x").alias("cx"), F.col(value).alias("value"))
    return four.join(src, [id_, "cy", "cx"], "left").groupBy(id_, "y", "x").agg(F.sum(F.col("wt") * F.coalesce("value", F.lit(0.0))).alias(value))
