"""From tasks to frame pairs in one plan: what is skipped is skipped before anything is decoded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import planning
from ..sources.frames import Opener, decoded
from ..sources.store import kept


def planned(tasks: DataFrame, done: DataFrame, key: list[str], cap: float | None = 5.0, long_s: float = 1.0, short_s: float = 0.3) -> DataFrame:
    """Tasks (key, fps, start, end, ...) that are not in ``done`` (key) and have a triplet at all, with ``triplets`` and the
    sorted frames ``idx`` that these use."""
    n = planning.frame_count(F.col("start"), F.col("end"), F.col("fps"))
    left = planning.skip_existing(tasks, done, key)
    left = left.withColumn("triplets", planning.task_triplets(n, F.col("fps"), F.lit(cap).cast("double"), long_s, short_s)).where("triplets is not null")
    return left.withColumn("idx", F.array_sort(F.array_distinct(F.flatten(F.array("triplets.src", "triplets.tgt_long", "triplets.tgt_short")))))


def without_black(ready: DataFrame, frames: DataFrame, key: list[str]) -> DataFrame:
    """Decoded frames of tasks whose first frame is not black all over; tasks that failed have no frame and are gone too."""
    frames = frames.where("error is null")
    first = frames.join(ready.select(*key, F.get("idx", F.lit(0)).alias("idx")), [*key, "idx"])  # no other frame is looked at
    black = first.where(F.col("pixels") == F.unhex(F.repeat(F.lit("00"), F.length("pixels")))).select(*key)
    return frames.join(black, key, "left_anti")


def pairs(ready: DataFrame, frames: DataFrame, key: list[str], bidirectional: bool = True) -> DataFrame:
    """(key, tgt_long, pair_type, h, w, first_image, second_image) of the triplets of tasks whose frames are there."""
    typed = planning.typed_pairs(ready.select(*key, F.inline("triplets")), key, bidirectional)
    image = lambda at, name, *more: frames.select(*key, F.col("idx").alias(at), F.col("pixels").alias(name), *more)
    out = typed.join(image("a", "first_image", "h", "w"), [*key, "a"]).join(image("b", "second_image"), [*key, "b"])
    return out.select(*key, "tgt_long", "pair_type", "h", "w", "first_image", "second_image")


def prefetched(tasks: DataFrame, done: DataFrame, key: list[str], openers: Sequence[Opener], cap: float | None = 5.0, long_s: float = 1.0, short_s: float = 0.3, bidirectional: bool = True, source: str = "path") -> tuple[DataFrame, DataFrame]:
    """(pairs, outcomes): what the estimator gets, and (key, status, error) of every task.

    A status is ``skipped`` (in ``done``), ``empty`` (no triplet), ``failed`` (no opener could read it), ``black`` or ``ready``.
    Frames are decoded once and kept in the folder of ``checkpoint``, as pairs and outcomes both read them.
    """
    ready = planned(tasks, done, key, cap, long_s, short_s)
    frames = kept(decoded(ready, key, openers, source=source))
    seen = without_black(ready, frames, key)
    told = frames.groupBy(*key).agg(F.max("error").alias("error"))
    lit = seen.select(*key).distinct().withColumn("__lit", F.lit(True))
    out = tasks.select(*key).join(done.select(*key).distinct().withColumn("__done", F.lit(True)), key, "left").join(told.withColumn("__told", F.lit(True)), key, "left").join(lit, key, "left")
    status = F.when(F.col("__done"), "skipped").when(F.col("__told").isNull(), "empty").when(F.col("error").isNotNull(), "failed").when(F.col("__lit").isNull(), "black").otherwise("ready")
    return pairs(ready, seen, key, bidirectional), out.select(*key, status.alias("status"), "error")
