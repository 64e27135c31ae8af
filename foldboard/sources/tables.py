"""Reading, landing, previewing and profiling data sets."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PREVIEW_ROWS = 10
# Columns of landed files: the raw line, and whether it became a row.
LINE = "_line"
PART = "part"


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """Headed CSV, only files named ``*.csv``.

    Without a schema Spark reads the files an extra time to infer one, so pass
    it for anything large, or land the data once with :func:`ingest_csv`.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv")
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    try:
        df = reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise ValueError(f"no .csv file at {path}") from error
        raise
    # Inference over no file yields an empty schema, and a given schema hides it.
    if not df.columns or (schema is not None and not _has_csv(spark, path)):
        raise ValueError(f"no .csv file at {path}")
    return df


def _has_csv(spark: SparkSession, path: str) -> bool:
    """Whether some file named ``*.csv`` lies at or below ``path``; stops at the first one."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
    try:
        return not names.load(path).select("path").limit(1).isEmpty()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """CSV by its suffix, parquet otherwise."""
    if path.rstrip("/").endswith(".csv"):
        return read_csv(spark, path, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def from_rows(spark: SparkSession, rows: Iterable[tuple], columns: Sequence[str]) -> DataFrame:
    """Table from a handful of rows in memory."""
    return spark.createDataFrame(list(rows), list(columns))


def ingest_csv(
    spark: SparkSession,
    csv_path: str,
    root: str,
    schema: StructType | str | None = None,
) -> str:
    """Land an uploaded CSV as parquet under a fresh data set id; returns its path."""
    path = f"{root.rstrip('/')}/datasets/dataset_id={uuid.uuid4()}"
    read_csv(spark, csv_path, schema).write.parquet(path)
    return path


@dataclass(frozen=True)
class Landing:
    """Where an upload went: its rows, and the lines that are none."""

    path: str
    schema: StructType

    def rows(self, spark: SparkSession) -> DataFrame:
        return self._part(spark, "rows", self.schema)

    def rejected(self, spark: SparkSession) -> DataFrame:
        """``(line, reason, fault_column)``: reason is field_count or wrong_type, the latter with the first such column."""
        schema = StructType().add("line", "string").add("reason", "string").add("fault_column", "string")
        return self._part(spark, "rejected", schema)

    def _part(self, spark: SparkSession, part: str, schema: StructType) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(f"{self.path}/{PART}={part}")
        except AnalysisException as error:
            # A part without lines has no folder.
            if error.getCondition() == "PATH_NOT_FOUND":
                return spark.createDataFrame([], schema)
            raise


def land_csv(
    spark: SparkSession, csv_path: str, root: str, schema: StructType | str, *, header: bool = True
) -> Landing:
    """Land a CSV under a fresh data set id, with the lines that do not fit the schema set aside and told why.

    One read and one write. A line is rejected if it has another number of fields than the schema, or a field that is not
    of its column's type; no part of it is landed. Empty fields are NULL, blank lines are nothing.
    """
    schema = spark.createDataFrame([], schema).schema
    clash = {LINE, PART, "line", "reason", "fault_column"} & set(schema.names)
    if clash:
        raise ValueError(f"a landed table cannot have columns named {', '.join(sorted(clash))}")
    path = f"{root.rstrip('/')}/datasets/dataset_id={uuid.uuid4()}"
    wide = StructType([*schema.fields, StructField(LINE, StringType())])
    read = (
        spark.read.option("header", header)
        .option("pathGlobFilter", "*.csv")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .schema(wide)
        .csv(csv_path)
    )
    if not _has_csv(spark, csv_path):
        raise ValueError(f"no .csv file at {csv_path}")
    # As texts every field fits, so what is still corrupt has another number of them.
    names = [f.name.replace("`", "``") for f in wide.fields]
    texts = ", ".join(f"`{name}` string" for name in names)
    fields = F.from_csv(F.col(LINE), texts, {"columnNameOfCorruptRecord": LINE})
    bad = F.col(LINE).isNotNull()
    own = lambda name: F.col("_fields").getField(name)
    wrong = [
        F.when(own(f.name).isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for f in schema.fields
    ]
    counted = own(LINE).isNull()
    (
        read.withColumn("_fields", F.when(bad, fields))
        .select(
            *[F.when(~bad, F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields],
            F.col(LINE).alias("line"),
            F.when(bad, F.when(counted, "wrong_type").otherwise("field_count")).alias("reason"),
            F.when(bad & counted, F.coalesce(*wrong)).alias("fault_column"),
            F.when(bad, "rejected").otherwise("rows").alias(PART),
        )
        .write.partitionBy(PART)
        .parquet(path)
    )
    return Landing(path, schema)


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """First ``n`` rows, in reading order or by the given key."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def profile(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    width = len(df.columns)
    return df.agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(width))


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share when the source comes in fewer partitions than cores.

    One small file is read by a single task. Large sources have more partitions
    than cores and pass through without a shuffle. For plans without a shuffle:
    counting partitions may otherwise run some of their stages. It changes the
    partition layout, and with it random splits and the bagging of forests.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
