"""Colours of displacement fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: steps of the wheel from red to yellow, green, cyan, blue, magenta and back
STEPS = (15, 6, 4, 11, 13, 6)


def wheel_rows() -> list[tuple[int, int, int, int]]:
    """(row, r, g, b): in each part one channel is full and one rises or falls over its steps."""
    parts, out = [(0, 1, 1), (1, 0, -1), (1, 2, 1), (2, 1, -1), (2, 0, 1), (0, 2, -1)], []
    for n, (full, moves, up) in zip(STEPS, parts):
        for i in range(n):
            rgb = [0, 0, 0]
            rgb[full] = 255
            ramp = 255 * i // n
            rgb[moves] = ramp if up > 0 else 255 - ramp
            out.append((len(out), *rgb))
    return out


def wheel(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(wheel_rows(), "row int, r int, g int, b int")


def coloured(df: DataFrame, key: str, clip: float | None = None) -> DataFrame:
    """(key, y, x, r, g, b) of (key, y, x, u, v): hue by angle, saturation by length over the field's longest.

    ``clip`` holds both components between 0 and itself first.
    """
    if clip is not None:
        df = df.withColumns({c: F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(float(clip))) for c in ("u", "v")})
    rows = wheel_rows()
    n = len(rows)
    top = df.groupBy(key).agg(F.max(F.sqrt(F.col("u") * F.col("u") + F.col("v") * F.col("v"))).alias("top"))
    d = df.join(top, key).select(key, "y", "x", *[(F.col(c) / (F.col("top") + F.lit(1e-5))).alias(c) for c in ("u", "v")])
    rad = F.sqrt(F.col("u") * F.col("u") + F.col("v") * F.col("v"))
    # straight to the right is -pi, the begin of the wheel: atan2 drops the sign of a negative zero
    turn = F.when((F.col("v") == 0) & (F.col("u") >= 0), -F.pi()).otherwise(F.atan2(-F.col("v"), -F.col("u")))
    at = (turn / F.pi() + 1) / 2 * (n - 1)
    d = d.select(key, "y", "x", rad.alias("rad"), F.floor(at).cast("int").alias("k0"), (at - F.floor(at)).alias("f"))
    table = [F.array(*[F.lit(float(r[i])) for r in rows]) for i in (1, 2, 3)]
    k1 = F.when(F.col("k0") + 1 == n, F.lit(0)).otherwise(F.col("k0") + 1)
    out = []
    for name, t in zip("rgb", table):
        c = ((1 - F.col("f")) * F.get(t, F.col("k0")) + F.col("f") * F.get(t, k1)) / 255
        c = F.when(F.col("rad") <= 1, 1 - F.col("rad") * (1 - c)).otherwise(c * 0.75)
        out.append(F.floor(c * 255).cast("int").alias(name))
    return d.select(key, "y", "x", *out)
