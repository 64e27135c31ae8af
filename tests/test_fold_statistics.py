"""Preprocessing of all folds from merged statistics, against stages fitted on the rows themselves."""

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foldboard.operators.features import FEATURES, plan_features, preprocessing
from foldboard.operators.fold_statistics import Spread, fit_per_fold, number_statistics
from foldboard.operators.indexing import CategoryIndexer

FOLDS = 3
NUMBERS = ["whole", "tenths", "single", "exact"]
STRINGS = ["kind", "place"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(400).selectExpr(
        "id",
        "CASE WHEN id % 7 > 0 THEN CAST(id * 37 % 101 AS INT) END AS whole",
        "CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') ELSE (id * 53 % 89) / 10.0D END AS tenths",
        "CASE WHEN id % 3 > 0 THEN CAST((id * 31 % 67) / 7.0D AS FLOAT) END AS single",
        "CASE WHEN id % 4 > 0 THEN CAST((id * 29 % 61) / 7.0D AS DECIMAL(9, 2)) END AS exact",
        "CASE WHEN id % 9 > 0 THEN concat('k', id * id % 5) END AS kind",
        "concat('p', CASE WHEN id < 200 THEN id % 2 ELSE id % 60 END) AS place",
        "CAST(id % 4 AS INT) AS level",
        "concat('y', id % 3) AS target",
        "CAST(id * 7 % 3 AS INT) AS fold",
    )


def stages_for(rows, **limits):
    types = dict.fromkeys(NUMBERS, "numerical") | dict.fromkeys([*STRINGS, "level"], "categorical")
    plan = plan_features([*NUMBERS, *STRINGS, "level"], "target", types, rows.schema)
    pipeline = preprocessing(plan)
    for stage in pipeline.getStages():
        if isinstance(stage, CategoryIndexer):
            stage._set(**limits)
    return pipeline, plan


def assert_same(found, plain, rows, plan):
    for one, other in zip(found, plain, strict=True):
        columns = ["id", vector_to_array(FEATURES).alias("features"), plan.label]
        a, b = ({r["id"]: r for r in m.transform(rows).select(*columns).collect()} for m in (one, other))
        assert a.keys() == b.keys()
        for key in a:
            assert a[key]["features"] == pytest.approx(b[key]["features"], rel=1e-9, abs=1e-9)
            assert a[key][plan.label] == b[key][plan.label]


@pytest.mark.parametrize("limits", [{}, {"maxLabels": 12, "headLabels": 4}], ids=["lists", "tables"])
def test_same_models_as_fitted_on_the_rows(rows, limits):
    prep, plan = stages_for(rows, **limits)
    found = fit_per_fold(prep, rows, "fold", FOLDS).models
    rests = [rows.filter(F.col("fold") != f) for f in range(FOLDS)]
    plain = [prep.copy().fit(rest) for rest in [*rests, rows]]
    assert_same(found, plain, rows, plan)


def scanned(spark, rows):
    """The rows, and how many of them were computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(pass_on, rows.schema), seen


def test_two_passes_for_all_folds(spark, rows):
    prep, _ = stages_for(rows)
    watched, seen = scanned(spark, rows)
    fit_per_fold(prep, watched, "fold", FOLDS)
    assert seen.value == 2 * 400
    # Fitted one by one, every stage reads its rows again.
    watched, seen = scanned(spark, rows)
    for fold in range(FOLDS):
        prep.copy().fit(watched.filter(F.col("fold") != fold))
    assert seen.value > 6 * 400


def test_one_pass_without_strings(spark, rows):
    plan = plan_features(NUMBERS[:2], "level", dict.fromkeys(NUMBERS[:2], "numerical"), rows.schema)
    watched, seen = scanned(spark, rows)
    fit_per_fold(preprocessing(plan), watched, "fold", FOLDS)
    assert seen.value == 400


def test_many_columns(spark, rows):
    """Beyond a few columns the plan stays the same."""
    wide = rows.select("id", "fold", "target", *[(F.col("tenths") * (k + 1) + k).alias(f"c{k}") for k in range(12)])
    plan = plan_features([f"c{k}" for k in range(12)], "target", {f"c{k}": "numerical" for k in range(12)}, wide.schema)
    prep = preprocessing(plan)
    found = fit_per_fold(prep, wide, "fold", FOLDS).models
    plain = [prep.copy().fit(wide.filter(F.col("fold") != f)) for f in range(FOLDS)]
    assert_same(found, [*plain, prep.copy().fit(wide)], wide, plan)


def test_other_pipelines_are_fitted_on_the_rows(rows):
    imputer = Imputer(inputCols=["tenths"], outputCols=["filled"], strategy="median")
    assembler = VectorAssembler(inputCols=["filled"], outputCol="raw")
    for prep in (
        Pipeline(stages=[imputer, assembler, StandardScaler(inputCol="raw", outputCol=FEATURES)]),
        Pipeline(stages=[imputer, assembler, MinMaxScaler(inputCol="raw", outputCol=FEATURES)]),
    ):
        found = fit_per_fold(prep, rows, "fold", FOLDS).models
        plain = prep.fit(rows.filter("fold <> 1"))
        pairs = [
            [r[0] for r in m.transform(rows).select(vector_to_array(FEATURES)).collect()] for m in (found[1], plain)
        ]
        assert pairs[0] == pairs[1]


def test_broken_input_is_refused(rows):
    prep, _ = stages_for(rows)
    with pytest.raises(ValueError, match="no rows"):
        fit_per_fold(prep, rows.filter("fold > 0"), "fold", FOLDS)
    with pytest.raises(ValueError, match="no mean to impute"):
        fit_per_fold(prep, rows.withColumn("whole", F.lit(None).cast("int")), "fold", FOLDS)


def test_spreads_add_up(rows):
    values = [float(v) for v in (3, 8, 8, 1, 12, -4, 0)]

    def spread(part):
        mean = sum(part) / len(part)
        return Spread(len(part), mean, sum((v - mean) ** 2 for v in part))

    for cut in range(1, len(values)):
        merged = spread(values[:cut]).merged(spread(values[cut:]))
        assert merged.n == len(values)
        assert math.isclose(merged.mean, spread(values).mean) and math.isclose(merged.squares, spread(values).squares)
    assert Spread().merged(spread(values)) == spread(values) == spread(values).merged(Spread())
    assert Spread().deviation == 0.0
    found = number_statistics(rows, "fold", ["tenths"])
    n, (own,) = found.without(2)
    plain = rows.filter("fold <> 2 AND NOT isnan(tenths)").agg(F.count("tenths"), F.avg("tenths"), F.stddev("tenths"))
    assert n == rows.filter("fold <> 2").count()
    assert (own.n, own.mean, own.deviation) == pytest.approx(tuple(plain.first()))
