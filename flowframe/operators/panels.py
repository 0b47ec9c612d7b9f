"""Sheets of several images as pixels: what is looked at side by side becomes one image."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fields import coordinates, packed

RGB = ["r", "g", "b"]


def byte(c: Column) -> Column:
    """A channel's value: fractions cut off, kept from 0 to 255."""
    return F.greatest(F.lit(0), F.least(F.lit(255), F.floor(c))).cast("int")


def gray(df: DataFrame, key: str, c: Column) -> DataFrame:
    """(key, y, x, r, g, b) of one value a pixel."""
    return df.select(key, "y", "x", *[byte(c).alias(n) for n in RGB])


def sheet(panels: list[tuple[int, int, DataFrame]], key: str, h: int, w: int, gap: int = 0) -> DataFrame:
    """(key, y, x, r, g, b) of panels (row, column, pixels of h x w), ``gap`` pixels apart.

    Pixels are moved to their panel's place and put together, without a shuffle; between panels there are no rows.
    """
    moved = [p.select(key, (F.col("y") + row * (h + gap)).alias("y"), (F.col("x") + col * (w + gap)).alias("x"), *[F.col(c).cast("int").alias(c) for c in RGB]) for row, col, p in panels]
    return reduce(DataFrame.unionByName, moved)


def extent(panels: list[tuple[int, int, DataFrame]], h: int, w: int, gap: int = 0) -> tuple[int, int]:
    """Height and width of the sheet."""
    rows, cols = 1 + max(r for r, _, _ in panels), 1 + max(c for _, c, _ in panels)
    return rows * (h + gap) - gap, cols * (w + gap) - gap


def whole(pixels: DataFrame, key: str, h: int, w: int, ground: int = 0) -> DataFrame:
    """(key, h, w, r, g, b) with packed channels, ``ground`` where an image has no pixel; ``exports.encoded`` makes files of it."""
    every = pixels.select(key).distinct().select(key, F.inline(coordinates(F.lit(h), F.lit(w))))
    full = every.join(pixels, [key, "y", "x"], "left").select(key, "y", "x", *[F.coalesce(c, F.lit(ground)).alias(c) for c in RGB])
    return packed(full, key, RGB).select(key, F.lit(h).alias("h"), F.lit(w).alias("w"), *RGB)
