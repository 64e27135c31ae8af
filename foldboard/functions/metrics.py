"""Regression metrics as aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_label(label: Column) -> Column:
    """One rule everywhere: a label that is NULL or NaN is missing."""
    return label.isNotNull() & ~F.isnan(label.cast("double"))


def present(label: Column, prediction: Column) -> Column:
    """The label of rows that can be scored: neither it nor the prediction is missing."""
    return F.when(has_label(label) & prediction.isNotNull(), label)


def rmse(label: Column, prediction: Column) -> Column:
    label = present(label, prediction)
    return F.sqrt(F.avg((label - prediction) * (label - prediction)))


def r2(label: Column, prediction: Column) -> Column:
    """Share of variance explained; -inf for an error on a constant label, NaN for none."""
    label = present(label, prediction)
    residual = F.sum((label - prediction) * (label - prediction))
    total = F.var_pop(label) * F.count(label)
    degenerate = F.when(residual > 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    return F.coalesce(1 - F.try_divide(residual, total), degenerate)


def evaluate(
    df: DataFrame,
    label: str,
    predictions: Mapping[str, str],
    by: Sequence[str] = (),
    rows: str | None = None,
) -> DataFrame:
    """``(*by, model, rmse, r2)`` for every prediction column, in one pass.

    ``predictions`` maps model names to columns of ``df``. Rows whose label is
    missing (NULL or NaN) do not count in the errors; ``rows`` names a column for
    the number of all rows.
    """
    y = F.col(label).cast("double")
    scores = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                rmse(y, F.col(column)).alias("rmse"),
                r2(y, F.col(column)).alias("r2"),
            )
            for model, column in predictions.items()
        ]
    )
    return df.groupBy(*by).agg(F.count("*").alias("_rows"), scores.alias("_scores")).filter(
        "_rows > 0"
    ).select(*by, *([F.col("_rows").alias(rows)] if rows else []), F.inline("_scores"))
