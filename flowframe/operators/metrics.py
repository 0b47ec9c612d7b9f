"""Errors of displacement fields against ground truth, at macro and micro grain, and training losses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def epe() -> Column:
    """End-point error of (u, v) against (gu, gv)."""
    du, dv = F.col("u") - F.col("gu"), F.col("v") - F.col("gv")
    return F.sqrt(du * du + dv * dv)


def outlier(e: Column, g: Column) -> Column:
    """Above 3 pixels and above 5 % of the true magnitude, written without a division."""
    return (e > 3) & (e > F.lit(0.05) * g)


def per_image(df: DataFrame, key: str) -> DataFrame:
    """(key, epe, px1, n_out, n_valid) over valid pixels; an image without any has null means."""
    e, g = epe(), F.sqrt(F.col("gu") * F.col("gu") + F.col("gv") * F.col("gv"))
    ok = F.col("valid")
    rows = df.select(key, F.when(ok, e).alias("e"), F.when(ok, outlier(e, g)).alias("o"))
    return rows.groupBy(key).agg(F.avg("e").alias("epe"), F.avg((F.col("e") < 1).cast("int")).alias("px1"), F.count_if("o").alias("n_out"), F.count("e").alias("n_valid"))


def summary(images: DataFrame) -> DataFrame:
    """EPE and 1px failure rate as means of images, Fl as a share of all valid pixels."""
    fl = F.try_divide(F.lit(100.0) * F.sum("n_out"), F.sum("n_valid"))
    return images.agg(F.avg("epe").alias("epe"), (F.lit(100.0) * (1 - F.avg("px1"))).alias("px1_fail"), fl.alias("fl_all"), F.count_if(F.col("n_valid") == 0).alias("n_empty"))


def log_sum_exp(a: Column, b: Column) -> Column:
    m = F.greatest(a, b)
    return m + F.ln(F.exp(a - m) + F.exp(b - m))


def mixture_nll(w0: Column, w1: Column, b0: Column, b1: Column, delta: Column, var_min: float = 0.0, var_max: float = 10.0) -> Column:
    """Negative log likelihood of a two-component Laplace mixture; b are raw log scales, clamped each to its side."""
    b0, b1 = F.least(F.greatest(b0, F.lit(0.0)), F.lit(var_max)), F.least(F.greatest(b1, F.lit(var_min)), F.lit(0.0))
    term = lambda w, b: w - F.lit(0.6931471805599453) - b - F.abs(delta) * F.exp(-b)
    return log_sum_exp(w0, w1) - log_sum_exp(term(w0, b0), term(w1, b1))


def sequence_loss(df: DataFrame, key: str, order: str, loss: str, gamma: float) -> DataFrame:
    """(key, loss): sum of gamma^(n-1-i) * loss_i."""
    back = F.row_number().over(W.partitionBy(key).orderBy(F.desc(order))) - 1
    return df.select(key, (F.pow(F.lit(gamma), back) * F.col(loss)).alias("l")).groupBy(key).agg(F.sum("l").alias("loss"))


def masked_mean(df: DataFrame, keys: list[str], loss: str, max_flow: float = 40000.0) -> DataFrame:
    """(keys, loss): mean of the finite losses of valid pixels whose true magnitude is below ``max_flow``; 0 without any."""
    x, g = F.col(loss).cast("double"), F.sqrt(F.col("gu") * F.col("gu") + F.col("gv") * F.col("gv"))
    ok = (F.col("valid").cast("double") >= 0.5) & (g < max_flow) & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return df.groupBy(*keys).agg(F.coalesce(F.avg(F.when(ok, x)), F.lit(0.0)).alias("loss"))


def masked_sequence_loss(df: DataFrame, key: str, order: str, loss: str, gamma: float, max_flow: float = 40000.0) -> DataFrame:
    """(key, loss): ``sequence_loss`` over the masked mean of each prediction ``order``."""
    return sequence_loss(masked_mean(df, [key, order], loss, max_flow), key, order, "loss", gamma)


def running_meter(df: DataFrame, key: str, order: list[str], value: str, weight: str, every: int) -> DataFrame:
    """Weighted running mean that starts anew every ``every`` rows."""
    i = df.withColumn("step", F.row_number().over(W.partitionBy(key).orderBy(*order)) - 1).withColumn("part", (F.col("step") / every).cast("int"))
    w = W.partitionBy(key, "part").orderBy("step")
    return i.withColumn("mean", F.try_divide(F.sum(F.col(value) * F.col(weight)).over(w), F.sum(weight).over(w)))
