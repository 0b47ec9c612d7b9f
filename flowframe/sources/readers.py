"""Scans of field files and dataset metadata, and the JSON sinks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.planning import unpivot_cameras
from .codecs import read_field_valid, read_png, read_pnm, three_bytes

FIELD = "path string, h int, w int, u array<float>, v array<float>, valid array<float>, error string"


def read_fields(spark: SparkSession, path: str) -> DataFrame:
    """Field files of any known format as packed rows; ``valid`` is the validity or covisibility of formats that have one. A
    file that cannot be read keeps its row and its error."""

    def run(parts):
        for pdf in parts:
            rows = []
            for p, raw in zip(pdf.path, pdf.content):
                try:
                    f, ok = read_field_valid(p, raw)
                    rows.append((p, *f.shape[:2], *[np.ravel(f[..., i]).astype(np.float32) for i in (0, 1)], None if ok is None else np.ravel(ok).astype(np.float32), None))
                except Exception as x:  # the row tells
                    rows.append((p, None, None, None, None, None, str(x) or type(x).__name__))
            yield pd.DataFrame(rows, columns=["path", "h", "w", "u", "v", "valid", "error"]).astype({"h": "Int32", "w": "Int32"})

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content").mapInPandas(run, FIELD)


IMAGE = "path string, h int, w int, channels int, pixels binary, error string"


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """PNG and binary PPM or PGM images as three bytes a pixel; a file that cannot be read keeps its row and its error."""

    def run(parts):
        for pdf in parts:
            rows = []
            for p, raw in zip(pdf.path, pdf.content):
                try:
                    a = three_bytes(read_pnm(raw) if p.lower().endswith((".ppm", ".pgm")) else read_png(raw))
                    rows.append((p, *a.shape, a.tobytes(), None))
                except Exception as x:  # the row tells
                    rows.append((p, None, None, None, None, str(x) or type(x).__name__))
            yield pd.DataFrame(rows, columns=["path", "h", "w", "channels", "pixels", "error"]).astype({c: "Int32" for c in ("h", "w", "channels")})

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content").mapInPandas(run, IMAGE)


def read_info(spark: SparkSession, path: str) -> DataFrame:
    """Dataset descriptions (robot_type, fps, video_path) with their defaults."""
    info = spark.read.schema("robot_type string, fps double, video_path string").json(path, multiLine=True)
    return info.select(F.input_file_name().alias("file"), F.coalesce("robot_type", F.lit("unknown")).alias("robot_type"), F.coalesce("fps", F.lit(30.0)).alias("fps"), "video_path")


def read_episodes(spark: SparkSession, path: str) -> DataFrame:
    """Episode tables under a folder, one row for each camera."""
    return unpivot_cameras(spark.read.option("recursiveFileLookup", True).parquet(path))


def annotation_documents(masks: DataFrame, key: list[str]) -> DataFrame:
    """(key, num_frames, doc): frames of a key in order as one JSON text; ``masks`` has frame_idx, size and counts."""
    frames = F.sort_array(F.collect_list(F.struct("frame_idx", "size", "counts")))
    return masks.groupBy(*key).agg(F.count(F.lit(1)).alias("num_frames"), F.to_json(F.struct(frames.alias("frames"))).alias("doc"))


def write_annotations(masks: DataFrame, key: list[str], path: str) -> None:
    """One JSON line for each key, in folders by the key's columns; a key without frames has no file."""
    annotation_documents(masks, key).write.partitionBy(*key[:-1]).mode("append").json(path)


def read_masks(spark: SparkSession, path: str) -> DataFrame:
    """(file, frame_idx, counts, size) of run-length files that map frames to codes."""
    d = spark.read.schema("frames map<string, struct<counts:array<int>,size:array<int>>>").json(path, multiLine=True)
    e = d.select(F.input_file_name().alias("file"), F.explode("frames").alias("k", "f"))
    return e.select("file", F.col("k").cast("int").alias("frame_idx"), "f.counts", "f.size")
