"""Published runs: which models were trained on which data set, and which of them to use.

A run's models lie in a folder of their own below their data set. Publishing overwrites this folder alone, so doing it again, after a
failure or by mistake, leaves one run. A run counts once its marker is there, which is written last and tells how many
models it has: what a broken publication left behind is never read.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.plans.run import RunResult

KEYS = ["dataset", "run_id"]
SCORES = "model string, rmse double, r2 double, avg_cv_rmse double, is_best boolean, model_path string"
RUNS_SCHEMA = f"finished_at timestamp, {SCORES}, dataset string, run_id string"
MARKER_SCHEMA = "finished_at timestamp, models long, dataset string, run_id string"


def _replace(rows: DataFrame, path: str) -> None:
    """Write ``rows`` in place of the runs that they belong to."""
    rows.write.partitionBy(*KEYS).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def publish(runs: DataFrame, root: str, *, finished: bool = True) -> None:
    """Add runs, a row per model: dataset, run_id, finished_at, model, rmse, r2, avg_cv_rmse, is_best, model_path.

    Runs that are published already are replaced. With ``finished=False`` their markers wait for another call, and so do
    readers. ``runs`` is read twice: give a table, or few rows.
    """
    root = root.rstrip("/")
    columns = [f.split(" ")[0] for f in RUNS_SCHEMA.split(", ")]
    # One task per run and few files, whatever the partitions of the rows.
    rows = runs.select(*columns).repartition(*KEYS)
    _replace(rows, f"{root}/catalogue/models")
    if not finished:
        return
    markers = rows.groupBy(*KEYS).agg(F.max("finished_at").alias("finished_at"), F.count("*").alias("models"))
    _replace(markers.select("finished_at", "models", *KEYS), f"{root}/catalogue/finished")


def publish_result(spark: SparkSession, result: RunResult, dataset: str, root: str, finished_at: datetime) -> None:
    """Add the outcome of :func:`foldboard.run`."""
    path = F.when(F.col("is_best"), F.lit(result.model_path)).cast("string")
    rows = result.leaderboard.withColumns(
        {"dataset": F.lit(dataset), "finished_at": F.lit(finished_at), "model_path": path}
    )
    publish(rows, root)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def published(spark: SparkSession, root: str) -> DataFrame:
    """The models of all runs that are complete."""
    root = root.rstrip("/")
    models = _read(spark, f"{root}/catalogue/models", RUNS_SCHEMA)
    markers = _read(spark, f"{root}/catalogue/finished", MARKER_SCHEMA)
    whole = (
        models.groupBy(*KEYS).agg(F.count("*").alias("models")).join(markers, [*KEYS, "models"], "left_semi")
    )
    return models.join(whole, KEYS, "left_semi")


def chosen_models(spark: SparkSession, root: str) -> DataFrame:
    """Per data set the winner of its latest run and the best winner of all its runs (column ``kind``: latest, best).

    Equal times go to the larger run id, equal errors to the smaller one. Runs without a winner are passed over.
    """
    winners = published(spark, root).filter("is_best")
    fields = ["run_id", "finished_at", "model", "rmse", "model_path"]
    row = F.struct(*fields)
    found = winners.groupBy("dataset").agg(
        F.max_by(row, F.struct("finished_at", "run_id")).alias("latest"),
        F.min_by(row, F.struct("rmse", "run_id")).alias("best"),
    )
    both = F.inline(
        F.array(
            *[F.struct(F.lit(k).alias("kind"), *[F.col(f"{k}.{f}").alias(f) for f in fields]) for k in ("latest", "best")]
        )
    )
    return found.select("dataset", both)
