"""Datasets below a folder, as a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(name, path, file, bytes): every file below ``root`` with the folder of ``root`` that it lies in.

    Only names and sizes are read, by Spark's own reader of the store; the listing of a large tree runs in tasks. Files that lie
    in ``root`` itself are in no folder, and names that begin with a dot or an underscore are hidden.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    inner = F.substring(F.col("path"), F.lit(len(base) + 2), F.length("path"))
    name = F.substring_index(inner, "/", 1)
    return files.where(inner.contains("/")).select(name.alias("name"), F.concat(F.lit(base + "/"), name).alias("path"), inner.alias("file"), F.col("length").alias("bytes"))


def _begins(prefixes: list[str]) -> Column:
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | F.col("name").startswith(p)
    return hit


def selected(found: DataFrame, names: list[str] | None = None, prefixes: list[str] | None = None) -> DataFrame:
    """The rows of ``found`` (name, ...) that are wanted, with ``missing``.

    An explicit list takes what it names, whatever the prefixes, each name once, and a name that is not there is a row of
    nulls marked as missing; without one, names that begin with one of ``prefixes`` are taken, all of them if there is none.
    """
    if names is None:
        return (found.where(_begins(prefixes)) if prefixes else found).withColumn("missing", F.lit(False))
    wanted = found.sparkSession.createDataFrame([(n,) for n in dict.fromkeys(names)], "name string")
    rows = found.withColumn("missing", F.lit(False))
    return wanted.join(rows, "name", "left").withColumn("missing", F.col("missing").isNull())


def datasets(spark: SparkSession, root: str, names: list[str] | None = None, prefixes: list[str] | None = None) -> DataFrame:
    """(name, path, files, bytes, warning) of the datasets below ``root``, in order of their names; one that is asked for and
    not there keeps its row, without files and with a warning."""
    found = listing(spark, root).groupBy("name", "path").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    told = F.when(F.col("missing"), F.concat(F.lit("Dataset not found: "), F.col("name")))
    return selected(found, names, prefixes).select("name", "path", F.coalesce("files", F.lit(0).cast("long")).alias("files"), F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes"), told.alias("warning")).orderBy("name")
