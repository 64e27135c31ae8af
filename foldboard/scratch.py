"""Shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of a small table that one task works on without shuffles; larger tables are always dealt out.
ROWS_PER_TASK = 100_000


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, also registered for ``checkpoint()``.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder, because there driver and executors share
    one machine.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    registered = context.getCheckpointDir()
    if configured:
        if registered is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if registered is not None:
        return registered.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="foldboard-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`scratch_path` once nothing reads it any more."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and continue from the files.

    Unlike a cached copy the files outlive the executors that wrote them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """A written table of so many ``rows``: in one partition if they are few, else as it is.

    Windows, groups and joins of a few rows need no shuffle then, which would cost more than they do.
    """
    return df.coalesce(1) if rows <= ROWS_PER_TASK else df
