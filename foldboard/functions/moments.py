"""Moments of many terms against one label, in one pass over the rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to this many terms get aggregate expressions of their own. Wider vectors are
# turned into (position, value) rows, which keeps the plan the same at any width
# and is the faster way from about a dozen terms on.
WIDEST_UNROLLED = 8


@dataclass(frozen=True)
class TermMoments:
    """Population moments of one term ``x`` and its covariance with the label."""

    mean: float
    std: float
    covariance: float


@dataclass(frozen=True)
class LabelMoments:
    count: int
    missing: int
    mean: float
    std: float


def correlation(term: TermMoments, label: LabelMoments) -> float:
    """Pearson correlation; 0 where it is undefined.

    Not ``corr``: with a constant argument that divides by zero, an error in ANSI mode.
    """
    product = term.std * label.std
    if not product > 0 or math.isnan(product):
        return 0.0
    return term.covariance / product


def moments(
    df: DataFrame, terms: Column, width: int, label: Column
) -> tuple[LabelMoments, list[TermMoments]]:
    """Moments of ``width`` terms, given as one ``array<double>`` column.

    Only ``width`` rows reach the driver.
    """
    rows = df.select(terms.alias("terms"), label.cast("double").alias("label"))
    unusable = F.col("label").isNull() | F.isnan("label")
    about_label = [
        F.count("*").alias("count"),
        F.count(F.when(unusable, 1)).alias("missing"),
        F.avg("label").alias("label_mean"),
        F.stddev_pop("label").alias("label_std"),
    ]
    if width <= WIDEST_UNROLLED:
        row = rows.agg(
            *about_label,
            F.array(*[_term(F.col("terms")[i]) for i in range(width)]).alias("terms"),
        ).first()
        found = list(row["terms"])
    else:
        # Partial aggregation leaves `width` rows per task to shuffle.
        by_position = (
            rows.select("label", F.posexplode("terms").alias("position", "term"))
            .groupBy("position")
            .agg(*about_label, _term(F.col("term")).alias("terms"))
            .orderBy("position")
            .collect()
        )
        row = by_position[0] if by_position else {"count": 0, "missing": 0, "label_mean": None, "label_std": None}
        found = [r["terms"] for r in by_position]
    if not row["count"]:
        return LabelMoments(0, 0, math.nan, math.nan), []
    label_moments = LabelMoments(
        row["count"], row["missing"], _number(row["label_mean"]), _number(row["label_std"])
    )
    return label_moments, [
        TermMoments(_number(t["mean"]), _number(t["std"]), _number(t["covariance"])) for t in found
    ]


def _term(x: Column) -> Column:
    return F.struct(
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("std"),
        F.covar_pop(x, F.col("label")).alias("covariance"),
    )


def _number(value: float | None) -> float:
    return math.nan if value is None else value
