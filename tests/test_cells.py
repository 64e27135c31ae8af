"""Trees on rows summed up by cell: same trees as on the rows, same errors, bags drawn row by row."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from foldboard import RunSpec, run
from foldboard.operators import cells
from foldboard.operators.features import FEATURES, plan_features, preprocessing
from foldboard.operators.split import key_bucket
from foldboard.plans import tuning
from foldboard.plans.families import BOOSTED, FOREST, TREE, WEIGHTED_AVERAGE
from foldboard.plans.tuning import tune
from foldboard.sources.registry import score

SPEC = RunSpec(["x", "y", "kind"], "target", {"x": "numerical", "y": "numerical", "kind": "categorical"})
SMALL = (
    FOREST.with_grid(maxDepth=[3], numTrees=[1], bootstrap=[False]),
    TREE.with_grid(maxDepth=[2, 5]),
    BOOSTED.with_grid(maxDepth=[2], maxIter=[2, 4]),
    WEIGHTED_AVERAGE,
)


@pytest.fixture(scope="module")
def lines(spark):
    return spark.range(3000).selectExpr(
        "id",
        "IF(id % 13 = 0, NULL, (id * 37 % 29) / 10.0D) AS x",
        "(id * 53 % 31) / 7.0D AS y",
        "concat('k', id * id % 5) AS kind",
        "(id * 53 % 31) * (id * 37 % 29) + 40.0D * (id * id % 5) + (id * 7919 % 101) AS target",
        "CAST(id % 3 AS INT) AS fold",
    ).persist()


@pytest.fixture(scope="module")
def vectors(lines):
    whole = lines.fillna(0.0).selectExpr("id", "x", "y", "CAST(substr(kind, 2) AS DOUBLE) AS k", "target AS label")
    return VectorAssembler(inputCols=["x", "y", "k"], outputCol="features").transform(whole).persist()


@pytest.mark.parametrize(
    "kind, params",
    [
        (DecisionTreeRegressor, {"maxDepth": 6}),
        (GBTRegressor, {"maxIter": 4, "maxDepth": 3}),
        (RandomForestRegressor, {"numTrees": 4, "bootstrap": False, "maxDepth": 4}),
    ],
)
def test_trees_are_those_of_the_rows(vectors, monkeypatch, kind, params):
    estimator = kind(seed=1, **params)
    expected = estimator.fit(vectors)
    monkeypatch.setattr(cells, "FEWEST_ROWS", 1)
    found = cells.fit_tree(estimator, vectors, "features", "label", 3)
    assert found.toDebugString.count("Predict") == expected.toDebugString.count("Predict")
    predicted = [
        [r["prediction"] for r in m.transform(vectors).orderBy("id").collect()] for m in (expected, found)
    ]
    assert predicted[1] == pytest.approx(predicted[0], rel=1e-9)


def tuned(lines):
    train = lines.drop("id")
    plan = plan_features(SPEC.feature_cols, SPEC.label_col, SPEC.data_types, train.schema)
    return tune(train, "fold", preprocessing(plan), SMALL, plan.label)


def test_search_by_cell_gives_the_numbers_of_the_rows(lines, monkeypatch):
    by_row = tuned(lines)
    monkeypatch.setattr(cells, "FEWEST_ROWS", 1)
    learnt, original = [], tuning.fit_cells

    def fit_cells(estimators, table, together):
        learnt.append(table.count())
        return original(estimators, table, together)

    monkeypatch.setattr(tuning, "fit_cells", fit_cells)
    for one, other in zip(by_row, tuned(lines), strict=True):
        assert other.avg_metrics == pytest.approx(one.avg_metrics, rel=1e-9)
        assert other.params == one.params
    # Two trees, one forest and one ensemble a fold, and three of them at the end.
    assert len(learnt) == 4 * 3 + 3 and max(learnt) < 3000


def test_rows_of_a_cell_are_summed_up(spark, vectors):
    grid = cells.grid_of(vectors, "features", "label", 3)
    assert grid is None  # a small table
    grid = cells.Grid([np.array([0.0, 1.0]), np.array([2.0]), np.array([1.0, 3.0])], 5.0)
    table = spark.sql("SELECT * FROM VALUES (0.5D, 9D, 2D, 1D), (0.1D, 1D, 0D, 3D), (0.6D, 1D, 2.1D, 7D), (0.6D, 1D, 9D, NULL)")
    table = VectorAssembler(inputCols=["col1", "col2", "col3"], outputCol="f").transform(table)
    found = cells.cells_of(table, "f", "col4", grid).collect()
    # On a bound means below it; rows without label do not count.
    assert [(list(r["f"]), r["col4"], r["_rows"], r["_within"]) for r in found] == [
        ([0.0, 2.0, 1.0], 2.0, 2.0, 2.0),
        ([1.0, 2.0, 3.0], 7.0, 1.0, 0.0),
    ]


def test_grids(spark, vectors, monkeypatch):
    monkeypatch.setattr(cells, "FEWEST_ROWS", 1)
    grid = cells.grid_of(vectors, "features", "label", 3)
    seen = np.array([list(r["features"]) for r in vectors.collect()])
    for values, own in zip(grid.values, seen.T):
        assert values.tolist() == sorted(set(own))
    # Many values: as many as bins, at quantiles. Rare ones are never lost where all fit.
    many = spark.range(20_000).selectExpr("pow(id, 2) AS a", "IF(id = 77, 5D, id % 2) AS b", "id + 0D AS label")
    many = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(many)
    first, second = cells.grid_of(many, "features", "label", 2).values
    assert len(first) == cells.BINS and second.tolist() == [0.0, 1.0, 5.0]
    assert np.sqrt(first) == pytest.approx((np.arange(32) + 0.5) * 625, abs=20)
    # What learners refuse, and too many cells, is left to the rows.
    unlabelled = many.withColumn("label", F.expr("IF(a = 9, NULL, label)"))
    assert cells.grid_of(unlabelled, "features", "label", 2) is None
    monkeypatch.setattr(cells, "MAX_CELLS", 95)
    assert cells.grid_of(many, "features", "label", 2) is None


def test_bags_are_drawn_row_by_row(vectors):
    grid = cells.Grid([np.array([0.0]), np.array([0.0]), np.array([0.0])], 0.0)
    (row,) = cells.cells_of(vectors, "features", "label", grid, 3, 42).collect()
    sizes = [row[f"_rows_{t}"] for t in range(3)]
    assert len(set(sizes)) == 3 and all(abs(n - 3000) < 5 * 3000**0.5 for n in sizes)
    assert [row[f"_label_{t}"] for t in range(3)] == pytest.approx([row["label"]] * 3, rel=0.1)


def test_forests_share_trees_and_are_saved(vectors, lines, monkeypatch, tmp_path):
    monkeypatch.setattr(cells, "FEWEST_ROWS", 1)
    grid = cells.grid_of(vectors, "features", "label", 3)
    table = cells.cells_of(vectors, "features", "label", grid, 4, 42).persist()
    forests = [RandomForestRegressor(numTrees=n, maxDepth=3, seed=1) for n in (2, 4)]
    grown, original = [], cells._bagged_tree
    monkeypatch.setattr(cells, "_bagged_tree", lambda *own: grown.append(own) or original(*own))
    small, large = cells.fit_cells(forests, table)
    assert len(grown) == 4 and [m.getNumTrees for m in (small, large)] == [2, 4]
    assert small.trees == large.trees[:2]
    assert sum(large.featureImportances) == pytest.approx(1.0)
    row = vectors.orderBy("id").limit(5)
    means = [np.mean([t.predict(r["features"]) for t in large.trees]) for r in row.collect()]
    assert [r["prediction"] for r in large.transform(row).collect()] == pytest.approx(means)

    families = [FOREST.with_grid(maxDepth=[3], numTrees=[2, 3])]
    result = run(lines.drop("fold"), SPEC, families, bucket=key_bucket("id"), save_to=str(tmp_path))
    saved, own = (
        [r["prediction"] for r in score(m, lines).orderBy("id").collect()] for m in (result.model_path, result.best_model)
    )
    assert saved == own and len(set(own)) > 5


def test_other_learners_read_the_rows(spark):
    assert cells.learns_from_cells(GBTRegressor()) and cells.learns_from_cells(RandomForestRegressor())
    for other in (
        GBTRegressor(lossType="absolute"),
        GBTRegressor(subsamplingRate=0.5),
        RandomForestRegressor(subsamplingRate=0.5),
        DecisionTreeRegressor(maxBins=64),
        DecisionTreeRegressor(minInstancesPerNode=2),
        DecisionTreeRegressor(weightCol="w"),
    ):
        assert not cells.learns_from_cells(other)
