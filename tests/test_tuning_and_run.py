import json
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from foldboard import RunSpec, run, run_file
from foldboard.functions.metrics import evaluate
from foldboard.operators.split import fold_number, hash_split, key_bucket
from foldboard.plans.families import (
    BOOSTED,
    DEFAULT_FAMILIES,
    FOREST,
    LINEAR,
    TREE,
    WEIGHTED_AVERAGE,
)
from foldboard.plans.leaderboard import rank_models, result_documents, winners
from foldboard.plans.tuning import Tuned, tune
from foldboard.operators.features import plan_features, preprocessing
from foldboard.sources.catalogue import chosen_models, publish_result
from foldboard.sources.registry import load_model, score

SPEC = RunSpec(
    ["x", "y", "kind"], "target", {"x": "numerical", "y": "numerical", "kind": "categorical"}
)
SMALL = (
    LINEAR.with_grid(regParam=[0.1]),
    TREE.with_grid(maxDepth=[3]),
    WEIGHTED_AVERAGE,
)


@pytest.fixture(scope="module")
def rows(spark):
    return (
        spark.range(600)
        .selectExpr(
            "id",
            "CASE WHEN id % 11 = 0 THEN NULL ELSE (id * 37 % 101) / 10.0D END AS x",
            "(id * 53 % 89) / 7.0D AS y",
            "concat('k', id % 4) AS kind",
            "'ignored' AS note",
        )
        .withColumn("target", F.coalesce("x", F.lit(5.0)) * F.col("y") + F.length("kind") + F.col("id") % 4)
        .repartition(4, "id")
        .sortWithinPartitions("id")
    )


def test_same_averages_and_choice_as_cross_validators_around_the_pipeline(rows):
    """The shared preprocessing and shared fits change the work, not the numbers."""
    train = rows.withColumn("fold", fold_number(key_bucket("id"))).drop("id").persist()
    plan = plan_features(SPEC.feature_cols, SPEC.label_col, SPEC.data_types, train.schema)
    families = (
        LINEAR.with_grid(regParam=[0.1, 100.0], maxIter=[10, 100]),
        TREE.with_grid(maxDepth=[2, 4]),
        BOOSTED.with_grid(maxDepth=[2], maxIter=[1, 3]),
        FOREST.with_grid(maxDepth=[3], numTrees=[2, 3]),
        WEIGHTED_AVERAGE,
    )
    for found in tune(train, "fold", preprocessing(plan), families, plan.label, parallelism=4):
        stages = [
            StringIndexer(inputCol="kind", outputCol="kind_indexed", handleInvalid="keep"),
            Imputer(inputCols=["x", "y"], outputCols=["x_imputed", "y_imputed"]),
            VectorAssembler(inputCols=["x_imputed", "y_imputed", "kind_indexed"], outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
        ]
        estimator = found.family.estimator().setLabelCol("target")
        plain = CrossValidator(
            estimator=Pipeline(stages=[*stages, estimator]),
            evaluator=RegressionEvaluator(labelCol="target"),
            estimatorParamMaps=found.family.param_maps(estimator),
            numFolds=3,
            foldCol="fold",
            parallelism=4,
        ).fit(train)
        # Forests bag rows by partition layout, which the two ways may not share.
        tolerance = 0.5 if found.family is families[3] else 1e-9
        assert found.avg_metrics == pytest.approx(plain.avgMetrics, rel=tolerance), found.family.name
        if found.family is not families[3]:
            expected = [r["prediction"] for r in plain.bestModel.transform(train).collect()]
            actual = [r["prediction"] for r in found.model.transform(train).collect()]
            assert actual == pytest.approx(expected, rel=1e-9)
    train.unpersist()


def test_default_grids(spark):
    sizes = {f.name: len(f.param_maps(f.estimator())) for f in DEFAULT_FAMILIES}
    assert sizes == {
        "Linear Regression": 4,
        "Random Forest": 4,
        "Decision Tree": 2,
        "Gradient Boosted Trees": 4,
        "Weighted Average Regressor": 4,
    }


def test_run_saves_the_winner(spark, rows, tmp_path):
    result = run(rows, SPEC, SMALL, bucket=key_bucket("id"), save_to=str(tmp_path), parallelism=2)
    board = result.leaderboard.orderBy("rank").collect()
    assert board[0]["model"] == result.best_model_name and board[0]["is_best"]
    assert " " not in result.model_path

    # Scores come from the held-out rows and the saved model.
    _, test = hash_split(rows, key_bucket("id"))
    predicted = score(result.model_path, test)
    check = evaluate(predicted, "target", {"saved": "prediction"}).first()
    assert check["rmse"] == pytest.approx(result.best_rmse)
    assert load_model(result.model_path).stages

    document = result.document()
    assert document["best_model_name"] == result.best_model_name
    assert document["model_path"] == result.model_path
    assert document["best_rmse"] == result.best_rmse
    assert [m["model"] for m in document["results"]] == sorted(f.name for f in SMALL)
    assert set(document["results"][0]) == {"model", "rmse", "r2", "avg_cv_rmse"}


def test_cache_holds_only_used_columns(rows, monkeypatch):
    import foldboard.plans.run as run_module

    seen = []
    original = run_module.tune
    monkeypatch.setattr(
        run_module, "tune", lambda train, *a, **k: seen.append(train.columns) or original(train, *a, **k)
    )
    run(rows, SPEC, SMALL[:1])
    assert seen == [["x", "y", "kind", "target", "_fold"]]


def test_run_from_csv_with_string_label_and_random_split(spark, rows, tmp_path):
    path = str(tmp_path / "rows.csv")
    rows.withColumn("target", F.when(F.col("target") > 60, "high").otherwise("low")).write.csv(path, header=True)
    result = run_file(spark, path, SPEC, families=SMALL[:2], split="random")
    assert result.leaderboard.count() == 2


def test_missing_labels_can_be_dropped(rows):
    holes = rows.withColumn("target", F.when(F.col("id") % 3 > 0, F.col("target")))
    with pytest.raises(Exception, match="(?i)null"):
        run(holes, SPEC, SMALL[:1])
    assert run(holes, SPEC, SMALL[:1], drop_null_label=True).best_rmse > 0
    mixed = holes.withColumn("target", F.when(F.col("id") % 3 == 1, float("nan")).otherwise(F.col("target")))
    result = run(mixed, SPEC, SMALL[:1], drop_null_label=True)
    assert result.split_sizes["train"] + result.split_sizes["test"] == 200


def test_rows_without_key_are_placed_by_their_contents(rows):
    bucket = key_bucket(F.when(F.col("id") % 2 == 0, F.col("id")))
    sizes = run(rows, SPEC, SMALL[:1], bucket=bucket).split_sizes
    assert sizes["train"] + sizes["test"] == 600 and 400 < sizes["train"] < 540


def test_result_tells_what_was_tried(rows):
    result = run(rows, SPEC, SMALL, bucket=key_bucket("id"))
    points = result.grid.collect()
    assert len(points) == 1 + 1 + 4
    chosen = {r["model"]: r["avg_cv_rmse"] for r in points if r["is_chosen"]}
    board = {r["model"]: r["avg_cv_rmse"] for r in result.leaderboard.collect()}
    assert chosen == board
    assert all(json.loads(r["params"]) for r in points)


def test_missing_labels_do_not_count_in_errors(spark):
    rows = [(1.0, 1.5), (2.0, 2.5), (4.0, 3.0), (None, 7.0), (float("nan"), 9.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    whole, known = (evaluate(d, "label", {"m": "prediction"}).first() for d in (df, df.limit(3)))
    assert (whole["rmse"], whole["r2"]) == (known["rmse"], known["r2"])


def test_best_fold_error_passes_over_nan():
    assert Tuned(LINEAR, {}, [float("nan"), 2.0, 1.0], None).avg_cv_rmse == 1.0


def test_broken_runs_are_refused(rows):
    with pytest.raises(ValueError, match="feature_not_found nothing"):
        run(rows, RunSpec(["nothing"], "target", {"x": "numerical"}), SMALL)
    with pytest.raises(ValueError, match="split must be"):
        run(rows, SPEC, SMALL, split="other")
    few = rows.filter("id < 40").withColumn("one_side", F.lit(0).cast("bigint"))
    with pytest.raises(ValueError, match="no rows"):
        run(few, SPEC, SMALL[:1], bucket=F.lit(0).cast("bigint") * F.col("one_side"), num_folds=2)


def test_metrics_match_the_evaluator(rows):
    df = rows.withColumn("prediction", F.col("y") * 5)
    row = evaluate(df, "target", {"m": "prediction"}).first()
    for metric in ("rmse", "r2"):
        evaluator = RegressionEvaluator(labelCol="target", metricName=metric)
        assert row[metric] == pytest.approx(evaluator.evaluate(df), rel=1e-12)


def test_r2_of_a_single_row(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "label double, prediction double")
    assert evaluate(df, "label", {"m": "prediction"}).first()["r2"] == float("-inf")
    assert evaluate(df.limit(0), "label", {"m": "prediction"}).count() == 0


def test_ranking_ties_nan_and_infinity(spark):
    scores = [
        ("a", "m2", 1.0), ("a", "m1", 1.0), ("a", "m3", float("nan")), ("a", "m4", 0.5),
        ("b", "m1", float("nan")), ("c", "m1", float("inf")), ("d", "m2", 2.0), ("d", "m1", 2.0),
    ]
    df = spark.createDataFrame(scores, "run_id string, model string, rmse double").selectExpr(
        "*", "0.5D AS r2", "1.0D AS avg_cv_rmse"
    )
    ranked = rank_models(df)
    order = {r["model"]: r["rank"] for r in ranked.filter("run_id = 'a'").collect()}
    assert order == {"m4": 1, "m1": 2, "m2": 3, "m3": 4}
    assert {(r["run_id"], r["model"]) for r in winners(ranked).collect()} == {("a", "m4"), ("d", "m1")}
    documents = {r["run_id"]: json.loads(r["document"]) for r in result_documents(ranked).collect()}
    assert documents["d"]["best_model_name"] == "m1"
    assert "best_model_name" not in documents["b"]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    """A request from the command line."""
    import foldboard.__main__ as command
    import foldboard.plans.run as run_module

    spark.range(40).selectExpr(
        "id * 97 % 50 + 20 AS load", "IF(id % 3 = 0, 'wet', 'dry') AS road", "id AS note",
        "(id * 97 % 50 + 20) * 10 + IF(id % 3 = 0, 50, 0) AS distance",
    ).write.csv(str(tmp_path / "in" / "1" / "brakes.csv"), header=True)
    request = {
        "key": "in/1/brakes.csv",
        "feature_cols": ["load", "road"],
        "label_col": "distance",
        "data_types": {"load": "numerical", "road": "categorical", "note": "numerical", "distance": "numerical"},
        "train_test_split": None,
    }
    (tmp_path / "request.json").write_text(json.dumps(request))
    monkeypatch.setattr(
        command, "run_file", lambda *a, **k: run_module.run_file(*a, families=SMALL[:2], **k)
    )
    document = command.main([str(tmp_path / "request.json"), str(tmp_path), "--output", str(tmp_path / "out")])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == document
    assert document["best_model_name"] == "Linear Regression"
    assert load_model(document["model_path"]).stages


def test_parallel_fits_keep_the_callers_pool(spark):
    from foldboard.plans.tuning import POOL, run_parallel

    context = spark.sparkContext
    tasks = [lambda: context.getLocalProperty(POOL)] * 3
    assert run_parallel(spark, tasks, 2) == ["foldboard-0", "foldboard-1", "foldboard-2"]
    context.setLocalProperty(POOL, "mine")
    try:
        assert run_parallel(spark, tasks, 2) == ["mine"] * 3
    finally:
        context.setLocalProperty(POOL, None)
    assert context.getLocalProperty(POOL) is None


@pytest.mark.parametrize("split", ["hash", "random"])
def test_copies_that_fill_a_third_of_the_table(rows, split):
    copies = rows.filter("id = 5").select("*", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("col")
    result = run(rows.union(copies), SPEC, SMALL[:1], split=split)
    assert result.best_rmse > 0


def test_a_table_of_copies_needs_the_random_split(rows):
    copies = rows.filter("id = 5").select("*", F.explode(F.sequence(F.lit(1), F.lit(90)))).drop("col")
    copies = copies.repartition(3)
    with pytest.raises(ValueError, match="no rows"):
        run(copies, SPEC, SMALL[2:])
    assert run(copies, SPEC, SMALL[2:], split="random").best_rmse == pytest.approx(0.0, abs=1e-9)


@pytest.mark.parametrize(
    "family, width, fits",
    [
        (LINEAR, 10, 2),
        (LINEAR, 5000, 4),
        (LINEAR.with_grid(regParam=[0.0], maxIter=[10, 100]), 10, 2),
        (LINEAR.with_grid(loss=["huber"], regParam=[0.1], maxIter=[1, 100]), 10, 2),
        (replace(LINEAR, estimator=lambda: LinearRegression(elasticNetParam=0.9)), 10, 4),
        (replace(LINEAR, estimator=lambda: LinearRegression(solver="l-bfgs")), 10, 4),
        (BOOSTED, 10, 2),
        (FOREST, 10, 4),
        (TREE, 10, 2),
        (WEIGHTED_AVERAGE, 10, 1),
    ],
)
def test_grid_points_share_fits(spark, family, width, fits):
    from foldboard.plans.tuning import _planned_fits

    planned = _planned_fits(family, "label", "features", width)
    assert len(planned) == fits
    points = sorted(p for fit in planned for group in fit.points for p in group)
    assert points == list(range(len(family.param_maps(family.estimator()))))
    if family is BOOSTED:
        assert {v for f in planned for p, v in f.param_maps[0].items() if p.name == "maxIter"} == {20}


def test_a_result_is_published(spark, rows, tmp_path):
    result = run(rows, SPEC, SMALL[:1], bucket=key_bucket("id"), save_to=str(tmp_path))
    for _ in range(2):
        publish_result(spark, result, "rows", str(tmp_path), datetime(2024, 5, 1))
    found = {r["kind"]: r for r in chosen_models(spark, str(tmp_path)).collect()}
    assert found["latest"]["run_id"] == found["best"]["run_id"] == result.run_id
    assert found["best"]["rmse"] == result.best_rmse and load_model(found["best"]["model_path"]).stages
