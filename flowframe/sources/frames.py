"""Frames of clips, decoded where the tasks run; the decoders are plug-ins that open a clip by its path."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Clip(Protocol):
    """An open clip: ``fps`` (0 where unknown), ``n`` frames, ``read(i)`` as (h, w) or (h, w, c)."""

    fps: float
    n: int

    def read(self, i: int) -> np.ndarray: ...


Opener = Callable[[str | bytes], Clip]


class Stack:
    """A clip in .npy form of (n, h, w[, c]): the path of a file, which is mapped instead of read, or its bytes. Its rate is
    not stored."""

    fps = 0.0

    def __init__(self, source: str | bytes):
        self.frames = np.load(source, mmap_mode="r") if isinstance(source, str) else np.load(io.BytesIO(source))
        self.n = len(self.frames)

    def read(self, i: int) -> np.ndarray:
        return np.asarray(self.frames[i])


def byte_image(frame: np.ndarray) -> np.ndarray:
    """Bytes as they are, floats up to 1 times 255, other numbers cut off."""
    if frame.dtype == np.uint8:
        return frame
    return (frame * 255 if frame.dtype.kind == "f" and frame.size and frame.max() <= 1 else frame).astype(np.uint8)


def at_times(clip: Clip, times: Sequence[float], fps: float) -> Iterator[np.ndarray]:
    """The frame nearest to each time; an error if it is farther than one frame of ``fps``."""
    rate = clip.fps or fps
    for t in times:
        i = min(max(int(np.floor(t * rate + 0.5)), 0), clip.n - 1)
        if i < 0 or abs(i / rate - t) > 1 / fps:
            raise ValueError(f"no frame at {t}")
        yield byte_image(clip.read(i))


def in_range(clip: Clip, start: float, end: float, fps: float) -> Iterator[np.ndarray]:
    """Frames from one time to another by number, up to the clip's end; an error if there is none."""
    rate = clip.fps or fps
    first, last = int(start * rate), min(int(end * rate), clip.n)
    if first >= last:
        raise ValueError(f"no frames from {start} to {end}")
    for i in range(first, last):
        yield byte_image(clip.read(i))


def clip_path(root: Column, camera: Column, chunk: Column, file: Column) -> Column:
    """Where an episode's merged clip lies."""
    return F.concat(root, F.lit("/videos/"), camera, F.format_string("/chunk-%03d/file-%03d.mp4", chunk.cast("int"), file.cast("int")))


def decoded(tasks: DataFrame, key: list[str], openers: Sequence[Opener], by: str = "times", batch: int = 32, source: str = "path") -> DataFrame:
    """(key, idx, h, w, channels, pixels, error): one row a frame of each task (key, path, fps, ...).

    ``times`` takes columns ``idx`` (array) and ``start``: frame i lies at start + i / fps. ``range`` takes ``start`` and
    ``end`` and numbers frames from 0. Openers get the column ``source``, a path or the clip's bytes; they are tried in order, and a task that none can read is one row with its
    error. Tasks are dealt by ranges of path and start: neighbours share an open clip, and a clip with many tasks is
    split. At most ``batch`` frames are held at once, so the task's frames, once given out, are not taken back: an
    opener that fails midway is replaced from the frame that it failed on.
    """
    fields = ", ".join(f"`{k}` {tasks.schema[k].dataType.simpleString()}" for k in key)
    names = [*key, "idx", "h", "w", "channels", "pixels", "error"]

    def frames(task, clips) -> Iterator[tuple]:
        numbers = list(task["idx"]) if by == "times" else None
        done, errors = 0, []
        for n, opener in enumerate(openers):
            try:
                if clips.get(n, (None,))[0] != task[source]:
                    clips[n] = (task[source], opener(task[source]))
                clip = clips[n][1]
                if by == "times":
                    out = at_times(clip, [task["start"] + i / task["fps"] for i in numbers[done:]], task["fps"])
                else:
                    out = in_range(clip, task["start"] + done / (clip.fps or task["fps"]), task["end"], task["fps"])
                for image in out:
                    yield numbers[done] if by == "times" else done, image
                    done += 1
                return
            except Exception as e:  # the next opener, or the row tells
                errors.append(f"{type(e).__name__}: {e}")
        yield None, "; ".join(errors)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clips, rows = {}, []
        table = lambda: pd.DataFrame(rows, columns=names).astype({"idx": "Int64", "h": "Int32", "w": "Int32", "channels": "Int32"})
        for pdf in parts:
            for task in pdf.to_dict("records"):
                own = [task[k] for k in key]
                for idx, image in frames(task, clips):
                    if idx is None:
                        rows.append((*own, None, None, None, None, None, image))
                    else:
                        rows.append((*own, int(idx), *image.shape[:2], image.shape[2] if image.ndim == 3 else 1, image.tobytes(), None))
                    if len(rows) == batch:
                        yield table()
                        rows.clear()
        if rows:
            yield table()

    dealt = tasks.repartitionByRange(source, "start") if tasks.schema[source].dataType.simpleString() == "string" else tasks
    return dealt.mapInPandas(run, f"{fields}, idx long, h int, w int, channels int, pixels binary, error string")
