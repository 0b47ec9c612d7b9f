"""Functions of SQL that take a table and make one."""

from __future__ import annotations

from collections import deque

from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


class FrameTriplets:
    """``frame_triplets(TABLE(frames) PARTITION BY key ORDER BY (idx), step, long, short)``: (key, src, tgt_long, tgt_short).

    ``frames`` has the key's columns and ``idx``. Every ``step``-th frame is sampled; the long target stands ``long`` samples
    behind the source, the short one ``short`` before the long one, or at the first sample where there are not so many. Rows
    of a key come in order, and no more of them are held than the longer offset spans.
    """

    @staticmethod
    def analyze(frames: AnalyzeArgument, step: AnalyzeArgument, long: AnalyzeArgument, short: AnalyzeArgument) -> AnalyzeResult:
        names = [f.name for f in frames.dataType.fields]
        if "idx" not in names:
            raise ValueError("frame_triplets needs a column idx")
        for name, a in (("step", step), ("long", long), ("short", short)):
            if not isinstance(a.dataType, (IntegerType, LongType)) or a.value is None or a.value < (1 if name == "step" else 0):
                raise ValueError(f"{name} must be a whole number, and step above 0")
        index = frames.dataType["idx"].dataType
        key = [f for f in frames.dataType.fields if f.name != "idx"]
        return AnalyzeResult(StructType([*key, *[StructField(n, index) for n in ("src", "tgt_long", "tgt_short")]]))

    def __init__(self):
        self.held: deque = deque()
        self.first = None

    def eval(self, row, step: int, long: int, short: int):
        idx = row["idx"]
        if idx is None or idx % step:
            return
        if self.first is None:
            self.first = idx
        self.held.append(idx)
        if len(self.held) > max(long, short) + 1:
            self.held.popleft()
        if len(self.held) > long:
            near = self.held[-1 - short] if len(self.held) > short else self.first
            yield (*[row[n] for n in row.__fields__ if n != "idx"], self.held[-1 - long], idx, near)


FUNCTIONS = {"frame_triplets": FrameTriplets}
