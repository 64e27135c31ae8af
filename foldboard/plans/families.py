"""The competing model families and their parameter grids."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Estimator
from pyspark.ml.param import Param
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import ParamGridBuilder

from foldboard.operators.weighted_average import WeightedAverageRegressor

SEED = 42


@dataclass(frozen=True)
class Family:
    """A regressor, the values to try, and how its grid points may share work."""

    name: str
    estimator: Callable[[], Estimator]
    grid: Mapping[str, Sequence]
    # Parameter whose smaller values give a prefix of the model for the largest.
    staged_by: str | None = None
    # Params without effect on an estimator as it is set, given the vector size.
    ignores: Callable[[Estimator, int], set[str]] | None = None
    # Penalty of a regression that sums of products suffice for, given the vector size; None for others.
    ridge: Callable[[Estimator, int], float | None] | None = None
    # The estimator's fitMultiple shares passes over the data between grid points.
    joint_fit: bool = False

    def with_grid(self, **grid: Sequence) -> Family:
        return replace(self, grid=grid)

    def param_maps(self, estimator: Estimator) -> list[dict[Param, object]]:
        """All combinations of the grid's values."""
        builder = ParamGridBuilder()
        for name, values in self.grid.items():
            builder = builder.addGrid(estimator.getParam(name), list(values))
        return builder.build()


# Fixed value: the widest vector for which Spark solves normal equations by default.
WIDEST_NORMAL_EQUATIONS = 4096


def solved_directly(estimator: LinearRegression, width: int) -> bool:
    """Whether normal equations with a ridge are solved.

    Decided by what the estimator is set to, its own defaults included.
    """
    return (
        width <= WIDEST_NORMAL_EQUATIONS
        and estimator.getLoss() == "squaredError"
        and estimator.getSolver() != "l-bfgs"
        and estimator.getRegParam() > 0
        and estimator.getElasticNetParam() == 0
    )


def ignored_by_linear(estimator: LinearRegression, width: int) -> set[str]:
    """Normal equations are solved whatever the iteration limit."""
    return {"maxIter"} if solved_directly(estimator, width) else set()


def ridge_penalty(estimator: LinearRegression, width: int) -> float | None:
    plain = estimator.getStandardization() and estimator.getFitIntercept() and not estimator.isSet("weightCol")
    return estimator.getRegParam() if plain and solved_directly(estimator, width) else None


# Names and grids of the families below are those a run is expected to report.


LINEAR = Family(
    "Linear Regression",
    LinearRegression,
    {"regParam": [0.1, 0.01], "maxIter": [10, 100]},
    ignores=ignored_by_linear,
    ridge=ridge_penalty,
)
FOREST = Family(
    "Random Forest",
    lambda: RandomForestRegressor(seed=SEED),
    {"maxDepth": [5, 10], "numTrees": [10, 20]},
)
TREE = Family(
    "Decision Tree",
    lambda: DecisionTreeRegressor(seed=SEED),
    {"maxDepth": [5, 10]},
)
BOOSTED = Family(
    "Gradient Boosted Trees",
    lambda: GBTRegressor(seed=SEED),
    {"maxDepth": [5, 8], "maxIter": [10, 20]},
    staged_by="maxIter",
)
WEIGHTED_AVERAGE = Family(
    "Weighted Average Regressor",
    WeightedAverageRegressor,
    {"regularization": [0.01, 0.1], "useInteractions": [True, False]},
    joint_fit=True,
)

DEFAULT_FAMILIES = (LINEAR, FOREST, TREE, BOOSTED, WEIGHTED_AVERAGE)
