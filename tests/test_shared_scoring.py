"""Errors of many grid points from one pass: ridge regressions from sums of products, boosted ensembles from their trees."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from foldboard.functions.metrics import evaluate
from foldboard.operators import gram
from foldboard.operators.features import FEATURES, plan_features, preprocessing
from foldboard.operators.fold_statistics import fit_per_fold
from foldboard.operators.gram import ridge_errors
from foldboard.plans.families import LINEAR, ridge_penalty
from foldboard.plans.tuning import tune, with_stages

FOLDS = 3


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(400).selectExpr(
        "CASE WHEN id % 7 > 0 THEN CAST(id * 37 % 101 AS INT) END AS whole",
        "CASE WHEN id % 5 > 0 THEN 1e6 + (id * 53 % 89) / 10.0D END AS far",
        "CASE WHEN id % 9 > 0 THEN concat('k', id * id % 5) END AS kind",
        "IF(id % 3 = 1 AND id % 50 = 1, 'seldom', concat('p', id % 4)) AS place",
        "CAST(id % 4 AS INT) AS level",
        "5.0D AS same",
        "1e5 + (id * 41 % 97) / 3.0D + id % 4 AS target",
        "concat('y', id % 3 * (id % 2)) AS named",
        "CAST(id % 3 AS INT) AS fold",
    )


def folds_of(rows, label):
    types = dict.fromkeys(["whole", "far", "same"], "numerical") | dict.fromkeys(["kind", "place", "level"], "categorical")
    plan = plan_features(list(types), label, types, rows.schema)
    prep = preprocessing(plan)
    return prep, plan.label, fit_per_fold(prep, rows, "fold", FOLDS, label=plan.label)


@pytest.mark.parametrize("label", ["target", "named"])
def test_ridge_errors_are_those_of_fits(rows, label):
    """Missing values, unseen labels, constant columns, numbers far from zero, indexed labels."""
    _, column, preps = folds_of(rows, label)
    penalties = [0.01, 3.0]
    found = ridge_errors(rows, "fold", preps, column, penalties)
    for f in range(FOLDS):
        train, held_out = (preps.models[f].transform(rows.filter(c)) for c in (f"fold <> {f}", f"fold = {f}"))
        for k, penalty in enumerate(penalties):
            model = LinearRegression(labelCol=column, regParam=penalty).fit(train)
            expected = evaluate(model.transform(held_out), column, {"m": "prediction"}).first()["rmse"]
            assert found[f][k] == pytest.approx(expected, rel=1e-8)


def test_one_pass_for_all_folds_and_penalties(spark, rows):
    _, column, preps = folds_of(rows, "target")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    ridge_errors(rows.mapInArrow(count, rows.schema), "fold", preps, column, [0.1, 1.0, 10.0])
    assert seen.value == 400


def test_what_sums_do_not_answer(rows, monkeypatch):
    _, column, preps = folds_of(rows, "target")
    holes = rows.withColumn("target", F.when(F.col("whole") > 3, F.col("target")))
    assert ridge_errors(holes, "fold", preps, column, [0.1]) is None
    assert ridge_errors(rows, "fold", preps, column, []) is None
    monkeypatch.setattr(gram, "WIDEST_BASIS", 10)
    assert ridge_errors(rows, "fold", preps, column, [0.1]) is None


def test_constant_label(rows):
    flat = rows.withColumn("target", F.lit(7.0))
    _, column, preps = folds_of(flat, "target")
    assert ridge_errors(flat, "fold", preps, column, [0.5]) == [[0.0]] * FOLDS


def test_penalties_of_estimators():
    assert ridge_penalty(LinearRegression(regParam=0.5), 10) == 0.5
    for other in (
        LinearRegression(),
        LinearRegression(regParam=0.5, elasticNetParam=0.2),
        LinearRegression(regParam=0.5, standardization=False),
        LinearRegression(regParam=0.5, fitIntercept=False),
        LinearRegression(regParam=0.5, solver="l-bfgs"),
        LinearRegression(regParam=0.5, weightCol="w"),
    ):
        assert ridge_penalty(other, 10) is None


def test_mixed_grids_are_solved_and_fitted(rows):
    """Penalty 0 needs fits; the choice is made among all points."""
    prep, column, _ = folds_of(rows, "target")
    train = rows.select("whole", "far", "same", "kind", "place", "level", "target", "fold")
    (found,) = tune(train, "fold", prep, [LINEAR.with_grid(regParam=[0.0, 0.1], maxIter=[10])], column)
    (fitted,) = tune(train, "fold", prep, [LINEAR.with_grid(regParam=[0.0], maxIter=[10])], column)
    assert found.avg_metrics[0] == pytest.approx(fitted.avg_metrics[0], rel=1e-9)
    assert len(found.avg_metrics) == 2 and all(e > 0 for e in found.avg_metrics)


def test_stages_are_those_of_each_iteration(spark):
    draw = np.random.default_rng(6)
    data = [(row.tolist(), float(row[0] * row[1] + row[2])) for row in draw.normal(size=(300, 3))]
    df = spark.createDataFrame(data, "x array<double>, label double").select(
        array_to_vector("x").alias(FEATURES), "label"
    )
    model = GBTRegressor(maxIter=6, maxDepth=2, seed=1, stepSize=0.3).fit(df)
    expected = model.evaluateEachIteration(df, "squared")
    scored, columns = with_stages(df, model, [1, 4, 6], FEATURES, "trees")
    assert scored.columns == [FEATURES, "label", *columns.values()]
    errors = {r["model"]: r["rmse"] for r in evaluate(scored, "label", {str(k): c for k, c in columns.items()}).collect()}
    assert {int(k): e for k, e in errors.items()} == pytest.approx({k: math.sqrt(expected[k - 1]) for k in (1, 4, 6)})
