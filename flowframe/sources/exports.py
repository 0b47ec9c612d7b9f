"""Files as rows (path, content), documents and leaderboard exports; one writer puts rows under any file system's root."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import codecs

# fixed values: path patterns of the leaderboards
SINTEL, SPRING = "%s/%s/frame%04d.flo", "%s/flow_%s_%s/flow_%s_%s_%04d.flo5"


def sintel_path(dstype: Column, sequence: Column, frame: Column) -> Column:
    """Frames count from 1 in the file's name."""
    return F.format_string(SINTEL, dstype, sequence, frame + 1)


def spring_path(scene: Column, way: Column, cam: Column, frame: Column) -> Column:
    return F.format_string(SPRING, scene, way, cam, way, cam, frame)


def encoded(df: DataFrame, path: Column, encode: Callable[[np.ndarray], bytes], planes: list[str]) -> DataFrame:
    """(path, content) of packed images (h, w, planes): ``encode`` gets (h, w), or (h, w, planes) of more than one."""

    def run(parts):
        for pdf in parts:
            out = []
            for r in pdf.itertuples(index=False):
                image = np.dstack([np.asarray(a).reshape(r.h, r.w) for a in r[3:]])
                out.append(encode(image[..., 0] if len(planes) == 1 else image))
            yield pd.DataFrame({"path": pdf["path"], "content": out})

    return df.select(path.alias("path"), "h", "w", *planes).mapInPandas(run, "path string, content binary")


def mask_png(mask: np.ndarray) -> bytes:
    """Masks of 0 and 1 as black and white."""
    return codecs.write_png((mask * 255).astype(np.uint8))


def kitti_png(field: np.ndarray) -> bytes:
    return codecs.write_png(codecs.to_kitti(field))


def write_files(files: DataFrame, root: str) -> None:
    """Writes rows (path, content) under ``root``. A file appears whole under its name, so a task may run again."""

    def run(rows):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        for r in rows:
            path = f"{base}/{r['path']}"
            system.create_dir(path.rpartition("/")[0], recursive=True)
            part = f"{path}.{uuid.uuid4().hex}.part"
            with system.open_output_stream(part) as out:
                out.write(bytes(r["content"]))
            system.move(part, path)

    files.foreachPartition(run)


def mask_documents(masks: DataFrame, key: list[str]) -> DataFrame:
    """(key, num_frames, doc): frames of a key as a map from number to code, with count, numbers in order and image size.

    ``masks`` has frame_idx, counts and size; the image size is that of the first frame. A frame must not come twice.
    """
    frames = F.sort_array(F.collect_list(F.struct("frame_idx", "counts", "size")))
    d = masks.groupBy(*key).agg(frames.alias("s"))
    named = F.map_from_entries(F.transform("s", lambda f: F.struct(f["frame_idx"].cast("string"), F.struct(f["counts"].alias("counts"), f["size"].alias("size")))))
    meta = F.struct(F.size("s").alias("num_frames"), F.col("s.frame_idx").alias("frame_indices"), F.get("s", F.lit(0))["size"].alias("image_size"))
    return d.select(*key, F.size("s").alias("num_frames"), F.to_json(F.struct(named.alias("frames"), meta.alias("metadata"))).alias("doc"))


def run_summary(outcomes: DataFrame) -> DataFrame:
    """(doc): one JSON text of a run: tasks in all and, by camera, tasks, successes, failures, frames and bytes.

    ``outcomes`` has camera, status (success, failed or skipped), frames and bytes. Cameras are few; rows are counted first.
    """
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    one = outcomes.groupBy("camera").agg(F.count(F.lit(1)).alias("total"), n("success"), n("failed"), F.coalesce(F.sum("frames"), F.lit(0)).alias("frames"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    rows = F.sort_array(F.collect_list(F.struct("camera", "total", "success", "failed", "frames", "bytes")))
    return one.agg(F.to_json(F.struct(F.coalesce(F.sum("total"), F.lit(0)).alias("total_tasks"), rows.alias("cameras"))).alias("doc"))
