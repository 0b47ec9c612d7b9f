"""Codecs and mask codes as functions of SQL."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf

from ..operators import rle
from ..sources import codecs
from . import tables


def flo_decode(raw: pd.Series) -> pd.DataFrame:
    """The field of a .flo file; nulls where the tag is wrong."""
    fields = [None if r is None else codecs.read_flo(r) for r in raw]
    rows = [(None,) * 4 if f is None else (*f.shape[:2], f[..., 0].ravel(), f[..., 1].ravel()) for f in fields]
    return pd.DataFrame(rows, columns=["h", "w", "u", "v"]).astype({"h": "Int32", "w": "Int32"})


def flo_encode(h: pd.Series, w: pd.Series, u: pd.Series, v: pd.Series) -> pd.Series:
    return pd.Series([codecs.write_flo(np.stack([np.asarray(a), np.asarray(b)], axis=-1).reshape(int(n), int(m), 2)) for n, m, a, b in zip(h, w, u, v)])


FUNCTIONS = {
    "flo_decode": (flo_decode, "struct<h int, w int, u array<float>, v array<float>>"),
    "flo_encode": (flo_encode, "binary"),
}


#: Functions written in SQL: parameters, type and body.
SQL_FUNCTIONS = {
    "coco_encode": ("bits array<int>, h int, w int", "string", rle.coco_sql("bits", "h", "w")),
    "coco_decode": ("code string, h int, w int", "array<int>", rle.from_coco_sql("code", "h", "w")),
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to SQL, those that make tables too, and tells their names."""
    for name, (f, kind) in FUNCTIONS.items():
        spark.udf.register(name, pandas_udf(f, kind))
    for name, (takes, gives, body) in SQL_FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name}({takes}) returns {gives} return {body}")
    for name, f in tables.FUNCTIONS.items():
        spark.udtf.register(name, udtf(f))
    return [*FUNCTIONS, *SQL_FUNCTIONS, *tables.FUNCTIONS]
