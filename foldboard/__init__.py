"""Training, comparing and applying regression models on tables, on Spark."""

from foldboard.operators.weighted_average import (
    WeightedAverageRegressionModel,
    WeightedAverageRegressor,
)
from foldboard.plans.run import RunResult, run, run_file
from foldboard.plans.spec import RunSpec

__all__ = [
    "RunResult",
    "RunSpec",
    "WeightedAverageRegressionModel",
    "WeightedAverageRegressor",
    "run",
    "run_file",
]
