"""Inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.operators.split import is_train, key_bucket

CHARGE = "l_quantity * l_extendedprice * (1 - l_discount)"

# The bucket of a row and its side, written once more in SQL.
BUCKET_SQL = "(l_orderkey * 2654435761 + l_linenumber * 40503) % 10007"
TRAIN_SQL = f"{BUCKET_SQL} < 0.8 * 10007"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a label that depends on a product of two columns."""
    return table(spark, sf_dir, "lineitem").withColumn("charge", F.expr(CHARGE))


def line_bucket():
    return key_bucket("l_orderkey", "l_linenumber")


def training_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charges(spark, sf_dir).filter(is_train(line_bucket()))
