import math
from itertools import combinations

import numpy as np
import pytest
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import DoubleType, StructField, StructType

from foldboard import WeightedAverageRegressionModel, WeightedAverageRegressor
from foldboard.functions import moments as moments_module
from foldboard.operators import weighted_average
from foldboard.operators.tiles import CELLS, cell_batch, combined, few_tasks
from foldboard.sources.registry import save_model, score

# Two measures that rise together with a third, and one row that does not fit.
TIDES = [(0.5, 10.0, 20.5), (1.5, 14.0, 31.0), (2.0, 11.0, 29.0), (3.5, 18.0, 44.5), (4.0, 12.0, 52.0), (6.0, 21.0, 70.5)]


def frame(spark, matrix, labels):
    rows = [(Vectors.dense(x), None if y is None else float(y)) for x, y in zip(matrix, labels)]
    schema = StructType([StructField("features", VectorUDT()), StructField("label", DoubleType())])
    return spark.createDataFrame(rows, schema)


def by_hand(x, y, regularization=0.01):
    """The method in plain numpy, pair by pair."""
    mean, std = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-8)

    def r(values):
        if values.std() <= 1e-8 or y.std() == 0:
            return 0.0
        return np.mean((values - values.mean()) * (y - y.mean())) / (values.std() * y.std())

    w = np.array([r(x[:, i]) * abs(r(x[:, i])) for i in range(x.shape[1])]) / (1 + regularization)
    pairs = {}
    for i, j in combinations(range(x.shape[1]), 2):
        if abs(w[i]) > 0.1 and abs(w[j]) > 0.1 and abs(r(x[:, i] * x[:, j])) > 0.05:
            pairs[i, j] = r(x[:, i] * x[:, j]) / 2
    total = np.abs(w).sum() + sum(map(abs, pairs.values()))
    total = total if total > 1e-8 else 1.0
    z = (x - mean) / std
    prediction = z @ w / total + sum(v / total * z[:, i] * z[:, j] for (i, j), v in pairs.items()) + y.mean()
    return w / total, {p: v / total for p, v in pairs.items()}, prediction


def assembled(spark):
    df = spark.createDataFrame(TIDES, ["wind", "moon", "label"])
    return VectorAssembler(inputCols=["wind", "moon"], outputCol="features").transform(df)


def predictions(model, df):
    return [r["prediction"] for r in model.transform(df).orderBy("label").collect()]


def test_few_rows_with_and_without_interactions(spark):
    df = assembled(spark)
    x, y = np.array([r[:2] for r in TIDES]), np.array([r[2] for r in TIDES])
    weights, pairs, expected = by_hand(x, y)
    model = WeightedAverageRegressor().fit(df)
    assert model.getOrDefault(model.weights) == pytest.approx(list(weights), rel=1e-12)
    ((i, j, weight),) = model.interactions()
    assert {(i, j): weight} == pytest.approx(pairs, rel=1e-12)
    assert model.getOrDefault(model.bias) == pytest.approx(y.mean())
    assert model.numFeatures == 2
    halves = np.abs(weights) + abs(weight) / 2
    assert list(model.featureImportances()) == pytest.approx(list(halves / halves.sum()))
    assert predictions(model, df) == pytest.approx(sorted_by_label(expected, y), rel=1e-12)
    assert [model.predict(Vectors.dense(r[:2])) for r in TIDES] == pytest.approx(list(expected), rel=1e-12)

    plain = WeightedAverageRegressor(useInteractions=False).fit(df)
    alone = np.array(plain.getOrDefault(plain.weights))
    assert np.abs(alone).sum() == pytest.approx(1.0) and plain.interactions() == []
    assert alone[0] / alone[1] == pytest.approx(weights[0] / weights[1])


def sorted_by_label(values, labels):
    return [value for _, value in sorted(zip(labels, values))]


def test_saved_model_scores_rows_it_has_not_seen(spark, tmp_path):
    """Fit on some rows, save, score the others by location, compare with plain numpy."""
    random = np.random.default_rng(3)
    x = random.normal(size=(60, 2)) + [2.0, -1.0]
    y = 4 * x[:, 0] - 3 * x[:, 1] + random.normal(size=60)
    train, rest = frame(spark, x[:40], y[:40]), frame(spark, x[40:], y[40:])
    path = save_model(PipelineModel([WeightedAverageRegressor().fit(train)]), str(tmp_path / "model"))
    weights, pairs, _ = by_hand(x[:40], y[:40])
    mean, std = x[:40].mean(axis=0), x[:40].std(axis=0)
    z = (x[40:] - mean) / std
    expected = y[:40].mean() + z @ weights + sum(v * z[:, i] * z[:, j] for (i, j), v in pairs.items())
    found = {r["label"]: r["prediction"] for r in score(path, rest).collect()}
    assert [found[v] for v in y[40:]] == pytest.approx(list(expected), rel=1e-9)


def test_params_and_their_accessors():
    regressor = WeightedAverageRegressor()
    assert (regressor.getRegularization(), regressor.getUseInteractions()) == (0.01, True)
    regressor.setRegularization(0.5).setUseInteractions(False)
    assert (regressor.getRegularization(), regressor.getUseInteractions()) == (0.5, False)
    assert regressor.getFeaturesCol() == "features"


@pytest.mark.parametrize("width", [3, 30])
def test_any_width_matches_plain_numpy(spark, width):
    """30 features with all pairs tried take the exploded and folded forms."""
    random = np.random.default_rng(7)
    base = random.normal(size=200)
    x = base[:, None] + random.normal(scale=0.7, size=(200, width)) + 1.0
    x[:, 1] = -x[:, 1]
    y = 3 * base + random.normal(size=200)
    weights, pairs, expected = by_hand(x, y)
    assert len(pairs) > 2
    df = frame(spark, x, y)
    model = WeightedAverageRegressor().fit(df)
    assert model.getOrDefault(model.weights) == pytest.approx(list(weights), rel=1e-9)
    assert {(i, j): v for i, j, v in model.interactions()} == pytest.approx(pairs, rel=1e-8)
    scored = {r["label"]: r["prediction"] for r in model.transform(df).collect()}
    assert [scored[v] for v in y] == pytest.approx(list(expected), rel=1e-9)


def test_narrow_and_wide_forms_agree(spark, monkeypatch):
    df = assembled(spark)
    narrow = WeightedAverageRegressor().fit(df)
    expected = predictions(narrow, df)
    monkeypatch.setattr(moments_module, "WIDEST_UNROLLED", 0)
    monkeypatch.setattr(weighted_average, "WIDEST_UNROLLED", 0)
    wide = WeightedAverageRegressor().fit(df)
    assert predictions(wide, df) == pytest.approx(expected, rel=1e-12)


def test_grid_is_fitted_jointly_and_like_single_fits(spark):
    df = assembled(spark)
    regressor = WeightedAverageRegressor()
    grid = [
        {regressor.regularization: l, regressor.useInteractions: u}
        for l in (0.01, 20.0)
        for u in (True, False)
    ]
    joint = dict(regressor.fitMultiple(df, grid))
    for index, params in enumerate(grid):
        single = regressor.fit(df, params)
        assert joint[index].getOrDefault("weights") == single.getOrDefault("weights")
        assert joint[index].interactions() == single.interactions()
    # Strong shrinkage leaves no feature above the threshold, so no pair is tried.
    assert joint[0].interactions() and not joint[2].interactions()


def test_constant_feature_has_no_weight(spark):
    df = frame(spark, [[1.0, 5.0], [2.0, 5.0], [3.0, 5.0]], [1, 2, 3])
    model = WeightedAverageRegressor().fit(df)
    assert model.getOrDefault(model.weights) == pytest.approx([1.0, 0.0])
    assert predictions(model, df)[1] == pytest.approx(2.0)


def test_constant_label_is_predicted_everywhere(spark):
    df = frame(spark, [[1.0, 2.0], [2.0, 1.0], [3.0, 7.0]], [4, 4, 4])
    model = WeightedAverageRegressor().fit(df)
    assert predictions(model, df) == [4.0, 4.0, 4.0]
    assert list(model.featureImportances()) == [0.0, 0.0]


def test_one_row(spark):
    model = WeightedAverageRegressor().fit(frame(spark, [[1.0, 2.0]], [5]))
    assert model.predict(Vectors.dense([9.0, 9.0])) == 5.0


def test_empty_table_is_refused(spark):
    with pytest.raises(ValueError, match="no rows to fit on"):
        WeightedAverageRegressor().fit(frame(spark, [[1.0]], [1]).limit(0))


@pytest.mark.parametrize("missing", [None, math.nan])
def test_missing_label_is_refused(spark, missing):
    with pytest.raises(ValueError, match="MUST NOT be Null or NaN"):
        WeightedAverageRegressor().fit(frame(spark, [[1.0], [2.0]], [1, missing]))


def test_model_survives_saving_alone_and_in_a_pipeline(spark, tmp_path):
    df = assembled(spark)
    model = WeightedAverageRegressor().fit(df)
    model.write().overwrite().save(str(tmp_path / "alone"))
    alone = WeightedAverageRegressionModel.load(str(tmp_path / "alone"))
    assert predictions(alone, df) == predictions(model, df)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "pipeline"))
    again = PipelineModel.load(str(tmp_path / "pipeline"))
    assert predictions(again, df) == predictions(model, df)


@pytest.mark.parametrize("tile, cells", [(64, 2_000_000), (5, 80)])
def test_many_pairs_by_tiles(spark, monkeypatch, tile, cells):
    """Means far from zero, where products of raw features lose digits; one tile, and several in several passes; labels far away."""
    random = np.random.default_rng(11)
    base = random.normal(size=300)
    x = base[:, None] + random.normal(scale=0.5, size=(300, 16)) + np.linspace(-50, 80, 16)
    y = 1000 + base**2 + 4 * base
    weights, pairs, expected = by_hand(x, y)
    monkeypatch.setattr(weighted_average, "TILE", tile)
    monkeypatch.setattr(weighted_average, "MATRIX_CELLS", cells)
    model = WeightedAverageRegressor().fit(frame(spark, x, y))
    assert {(i, j): v for i, j, v in model.interactions()} == pytest.approx(pairs, rel=1e-6)
    assert list(model.interactions()) == sorted(model.interactions())
    assert model.getOrDefault(model.weights) == pytest.approx(list(weights), rel=1e-6)


def test_all_elements_of_the_embeddings(spark, sf_dir):
    """All pairs of 64 elements of real vectors against plain numpy."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("embedding").collect()
    x = np.array([r["embedding"] for r in table], "float64")
    x += 2 * x[:, :1]
    y = (1 + x[:, 0] / 3) ** 2
    weights, pairs, _ = by_hand(x, y)
    model = WeightedAverageRegressor().fit(frame(spark, x, y))
    assert len(pairs) > 500
    assert {(i, j): v for i, j, v in model.interactions()} == pytest.approx(pairs, rel=1e-6)
    assert model.getOrDefault(model.weights) == pytest.approx(list(weights), rel=1e-6)


def shuffled_records(spark, df):
    """Records that all exchanges of ``df`` wrote."""
    node = df._jdf.queryExecution().executedPlan()
    plans = [node.finalPhysicalPlan() if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else node]
    found = []
    while plans:
        plan = plans.pop()
        name = plan.getClass().getSimpleName()
        if name == "ShuffleQueryStageExec":
            plan = plan.shuffle()
            found.append(plan.metrics().apply("shuffleRecordsWritten").value())
        children = plan.children()
        plans += [children.apply(k) for k in range(children.size())]
    return found


def test_cells_do_not_follow_the_splits(spark):
    """As many cells are shuffled for 500 input splits as for 10, one per tile and core, and they meet in a tree."""
    sizes = []
    for splits in (10, 500):
        few, tasks = few_tasks(spark.range(5_000, numPartitions=splits))

        def add(batches):
            total = sum(b.column(0).to_numpy().sum() for b in batches)
            for tile in range(3):
                yield cell_batch(tile, TaskContext.get().partitionId(), np.array([total, tile]))

        result = combined(few.mapInArrow(add, CELLS), tasks)
        rows = result.collect()
        assert sorted((r["tile"], *np.frombuffer(r["sums"])) for r in rows) == [
            (t, 5_000 * 4_999 / 2, t * min(tasks, splits)) for t in range(3)
        ]
        sizes.append(shuffled_records(spark, result))
    assert sizes[0] == sizes[1] == [3 * spark.sparkContext.defaultParallelism]


def test_many_cells_meet_in_a_tree(spark):
    def add(batches):
        for batch in batches:
            for part in batch.column(0).to_pylist():
                yield cell_batch(0, part, np.array([float(part)]))

    result = combined(spark.range(100, numPartitions=7).mapInArrow(add, CELLS), 100)
    assert [np.frombuffer(r["sums"])[0] for r in result.collect()] == [4950.0]
    assert shuffled_records(spark, result) == [4, 100]


def test_too_many_pairs_are_refused(spark, monkeypatch):
    monkeypatch.setattr(weighted_average, "MOST_PAIRS", 50)
    random = np.random.default_rng(11)
    base = random.normal(size=200)
    x = base[:, None] + random.normal(scale=0.1, size=(200, 16))
    with pytest.raises(ValueError, match="interactions are to be kept"):
        WeightedAverageRegressor().fit(frame(spark, x, (3 + base) ** 2))


def test_inputs_are_stored_between_the_two_passes(spark, monkeypatch):
    seen = []
    original = weighted_average._fit_stored
    monkeypatch.setattr(
        weighted_average,
        "_fit_stored",
        lambda df, e: seen.append(df.storageLevel.useMemory) or original(df, e),
    )
    df = assembled(spark)
    WeightedAverageRegressor().fit(df)
    WeightedAverageRegressor(useInteractions=False).fit(df)
    assert seen == [True, False]


def test_prediction_stays_in_generated_code(spark):
    df = assembled(spark)
    plan = WeightedAverageRegressor().fit(df).transform(df)._jdf.queryExecution().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
