"""A corpus pipeline in five stages; each one works on all that the stage before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.llm import bpe, decontamination, minhash, quality, secrets
from flowframe.llm.common import free_name, joined_on_id, remove, shared_dir, staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class stays: that of the least doc_id, null last, then by text digest and row.

    Where a doc_id is null or repeated, every row gets a number of its own first, so that classes are of rows. Null and
    empty texts are one class.
    """
    n, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if n == ids:
        classes = minhash.row_classes(docs)
        return joined_on_id(docs, classes.where("doc_id = class_id").select("doc_id"), "left_semi")
    row = free_name(docs, "row")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    classes = minhash.row_classes(rows.select(F.col(row).alias("doc_id"), "text"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), F.col(row).alias("row"))
    named = classes.withColumnRenamed("doc_id", row).hint("merge").join(rows.select(row, order.alias("order")), row)
    first = named.groupBy("class_id").agg(F.min("order").alias("order")).select(F.col("order.row").alias(row))
    return rows.join(first.hint("merge"), row, "left_semi").select(*[rows[c] for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none, equal rows are judged alike."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret, plain or encoded, is replaced by a mark; every row stays, a null or empty text as it is."""
    return secrets.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with count and digests; one row for each row, none for a null or empty text's tokens."""
    return bpe.digests(docs)


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("bpe", encode),
]

#: A stage that SQL cannot express makes the whole inexpressible; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        if before:
            remove(spark, before)  # only the last stage's table is read from here on
        before = f"{base}/{name}"
    return docs
