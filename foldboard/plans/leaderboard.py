"""Ranking of models by hold-out error and the result document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_models(scores: DataFrame, run: str = "run_id") -> DataFrame:
    """Adds ``rank`` and ``is_best`` to ``(run, model, rmse, …)``.

    Lowest RMSE first, ties by name; NaN and infinity come last and never win.
    The window holds one run, so as many rows as a run has models.
    """
    by_error = Window.partitionBy(run).orderBy(F.col("rmse").asc_nulls_last(), F.col("model"))
    ranked = scores.withColumn("rank", F.row_number().over(by_error))
    wins = (F.col("rank") == 1) & (F.col("rmse") < F.lit(float("inf")))
    return ranked.withColumn("is_best", F.coalesce(wins, F.lit(False)))


def winners(ranked: DataFrame) -> DataFrame:
    """The best model of every run; runs without a finite error have none."""
    return ranked.filter("is_best")


def result_documents(ranked: DataFrame, run: str = "run_id", path: str | None = None) -> DataFrame:
    """``(run, document)``: one JSON document per run.

    Names the best model, its path (a column of ``ranked``, if given) and error,
    and lists all models by name.
    """
    entry = F.struct("model", "rmse", "r2", "avg_cv_rmse")
    best = [
        F.max(F.when(F.col("is_best"), F.col(source))).alias(name)
        for name, source in [("best_model_name", "model"), ("model_path", path), ("best_rmse", "rmse")]
        if source
    ]
    names = (["best_model_name", "model_path"] if path else ["best_model_name"]) + ["best_rmse", "results"]
    return (
        ranked.groupBy(run)
        .agg(*best, F.array_sort(F.collect_list(entry)).alias("results"))
        .select(run, F.to_json(F.struct(*names)).alias("document"))
    )
