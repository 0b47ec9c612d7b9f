"""Episode catalogs to frame work: cameras, strides, sampled frames, triplets, typed pairs, tiles.

Frames are rows with a key (dataset, episode, camera, ...) and an index ``idx`` from 0. Everything is a projection or a
window over the key, so one exchange by the key serves the whole plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def indexed(df: DataFrame, key: list[str], order: list[str], name: str = "idx") -> DataFrame:
    """Position from 0 within the key."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*key).orderBy(*order)) - 1)


def frame_count(start: Column, end: Column, fps: Column) -> Column:
    """Frames of a clip; the fraction is cut off."""
    return ((end - start) * fps).cast("int")


def stride(fps: Column, cap: Column) -> Column:
    """Sampling step: only above the cap, and rounded up."""
    return F.when(cap.isNotNull() & (fps > cap), F.ceil(fps / cap)).otherwise(F.lit(1)).cast("int")


def offsets(fps: Column, step: Column, long_s: float, short_s: float) -> tuple[Column, Column]:
    """Long and short offsets in sampled frames at the effective rate; the short one is at least 1."""
    rate = fps / step
    return (F.lit(long_s) * rate).cast("int"), F.greatest(F.lit(1), (F.lit(short_s) * rate).cast("int"))


def triplets(frames: DataFrame, key: list[str], step: int, long_: int, short: int) -> DataFrame:
    """(key, src, tgt_long, tgt_short) over every ``step``-th frame; the short target precedes the long one by ``short``.

    Where the short offset is the longer one, the short target lies before the source, at the first frame at least.
    """
    w = W.partitionBy(*key).orderBy("idx")
    sampled = frames.where(F.col("idx") % step == 0)
    near = F.lead("idx", long_ - short).over(w) if long_ >= short else F.coalesce(F.lag("idx", short - long_).over(w), F.first("idx").over(w))
    out = sampled.select(*key, F.col("idx").alias("src"), F.lead("idx", long_).over(w).alias("tgt_long"), near.alias("tgt_short"))
    return out.where("tgt_long is not null")


def task_triplets(n: Column, fps: Column, cap: Column, long_s: float, short_s: float) -> Column:
    """Array of (src, tgt_long, tgt_short) of a task with ``n`` frames at ``fps``, sampled at ``cap`` a second at most."""
    step = stride(fps, cap)
    long_, short = offsets(fps, step, long_s, short_s)
    last = F.floor((n + step - 1) / step) - long_ - 1  # the last sample that has a long target
    frame = lambda i: F.struct((i * step).alias("src"), ((i + long_) * step).alias("tgt_long"), (F.greatest(F.lit(0), i + long_ - short) * step).alias("tgt_short"))
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0).cast("long"), last), frame))


def needed_frames(trip: DataFrame, key: list[str]) -> DataFrame:
    """Distinct frames that any triplet uses: what a decoder has to read."""
    return trip.select(*key, F.explode(F.array("src", "tgt_long", "tgt_short")).alias("idx")).distinct().orderBy(*key, "idx")


def typed_pairs(trip: DataFrame, key: list[str], bidirectional: bool = True) -> DataFrame:
    """Pairs (pair_type, a, b, tgt_long) of each triplet; short pairs only where both targets differ."""
    pair = lambda t, a, b: F.struct(F.lit(t).alias("pair_type"), F.col(a).alias("a"), F.col(b).alias("b"))
    pairs = [pair("long", "tgt_long", "src"), pair("short_fwd", "tgt_long", "tgt_short")]
    pairs += [pair("short_bwd", "tgt_short", "tgt_long")] * bidirectional
    out = trip.select(*key, "tgt_long", "tgt_short", F.explode(F.array(*pairs)).alias("p"))
    return out.where((F.col("p.pair_type") == "long") | (F.col("tgt_short") != F.col("tgt_long"))).select(*key, "tgt_long", "p.*")


def cameras(robot: Column, known: dict[str, list[str]], targets: list[str], default: list[str]) -> Column:
    """Cameras of a robot that are wanted, in the robot's order."""
    lit = lambda xs: F.array(*[F.lit(x) for x in xs])
    table = F.create_map(*[x for k, v in known.items() for x in (F.lit(k), lit(v))])
    return F.array_intersect(F.coalesce(F.try_element_at(table, robot), lit(default)), lit(targets))


def fan_out(tasks: DataFrame, cams: Column) -> DataFrame:
    """One row for each task and camera."""
    return tasks.withColumn("camera", F.explode(cams))


def skip_existing(tasks: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    return tasks.join(done, on, "left_anti")


def unpivot_cameras(episodes: DataFrame) -> DataFrame:
    """Columns ``videos/<camera>/<field>`` of an episode table as rows (episode_index, length, camera, fields)."""
    names = [c.split("/") for c in episodes.columns if c.startswith("videos/") and c.count("/") == 2]
    cams = sorted({n[1] for n in names})
    fields = ("chunk_index", "file_index", "from_timestamp", "to_timestamp")
    have = {tuple(n[1:]) for n in names}
    rows = [F.struct(F.lit(c).alias("camera"), *[(F.col(f"`videos/{c}/{f}`") if (c, f) in have else F.lit(None)).cast("double").alias(f) for f in fields]) for c in cams]
    return episodes.select("episode_index", "length", F.inline(F.array(*rows)))


def scale_plan(h: Column, w: Column, limit: int = 640) -> tuple[Column, Column]:
    """Height and width with the longest edge at ``limit`` at most; fractions are cut off."""
    s = F.lit(float(limit)) / F.greatest(h, w)
    small = F.greatest(h, w) <= limit
    return F.when(small, h).otherwise((h * s).cast("int")), F.when(small, w).otherwise((w * s).cast("int"))


def pad_plan(x: Column, factor: int = 32) -> Column:
    """Padding that the padder adds to one dimension."""
    return ((F.floor((x + 8) / factor) + 1) * factor - x).cast("int")


def pad_split(h: Column, w: Column, factor: int = 32, centred: bool = True) -> Column:
    """Struct (top, bottom, left, right) of the padder: centred, or all of the height's padding at the bottom."""
    ph, pw = pad_plan(h, factor), pad_plan(w, factor)
    half = lambda p: F.floor(p / 2).cast("int")
    top = half(ph) if centred else F.lit(0)
    return F.struct(top.alias("top"), (ph - top).alias("bottom"), half(pw).alias("left"), (pw - half(pw)).alias("right"))


def train_pad(h: Column, w: Column, train_h: int, train_w: int) -> Column:
    """Struct (top, bottom, left, right): centred zero padding up to the training size."""
    ph, pw = F.greatest(F.lit(train_h) - h, F.lit(0)), F.greatest(F.lit(train_w) - w, F.lit(0))
    half = lambda p: F.floor(p / 2).cast("int")
    return F.struct(half(ph).alias("top"), (ph - half(ph)).alias("bottom"), half(pw).alias("left"), (pw - half(pw)).alias("right"))


def tile_starts(n: Column, tile: int) -> Column:
    """Where overlapping tiles begin along a side of ``n``, three quarters of a tile apart, the last ones moved inside."""
    return F.array_distinct(F.transform(F.sequence(F.lit(0), n.cast("int") - 1, F.lit(max(1, tile // 4 * 3))), lambda i: F.least(i, n.cast("int") - tile)))
