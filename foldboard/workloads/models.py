"""Queries on estimators, tuning, scoring, ranking and saved models."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.functions.metrics import evaluate
from foldboard.operators.cells import fit_tree
from foldboard.operators.features import FEATURES, plan_features, preprocessing
from foldboard.operators.split import fold_number, is_train
from foldboard.plans.families import BOOSTED, FOREST, LINEAR, TREE, WEIGHTED_AVERAGE
from foldboard.plans.leaderboard import rank_models, result_documents, winners
from foldboard.plans.run import RunResult, run
from foldboard.plans.spec import RunSpec
from foldboard.plans.tuning import Tuned, stored, tune
from foldboard.scratch import scratch_path, written
from foldboard.sources.catalogue import chosen_models, publish
from foldboard.sources.registry import manifest, save_model, score
from foldboard.sources.tables import spread
from foldboard.workloads.tables import BUCKET_SQL, CHARGE, TRAIN_SQL, charges, line_bucket

SEED = 42
TWO_FEATURES = RunSpec(
    ["l_quantity", "l_extendedprice"],
    "charge",
    {"l_quantity": "numerical", "l_extendedprice": "numerical"},
)
THREE_FEATURES = RunSpec(
    ["l_quantity", "l_extendedprice", "l_returnflag"],
    "charge",
    {"l_quantity": "numerical", "l_extendedprice": "numerical", "l_returnflag": "categorical"},
)
ONE_CATEGORY = RunSpec(["l_returnflag"], "l_extendedprice", {"l_returnflag": "categorical"})
RIDGE_GRID = (1000.0, 0.01)
# The default families; of the forest one tree without bagging, so that its numbers have a closed form.
EXACT_FAMILIES = (
    LINEAR,
    FOREST.with_grid(maxDepth=[5, 10], numTrees=[1], bootstrap=[False]),
    TREE,
    BOOSTED,
    WEIGHTED_AVERAGE,
)


def lines_in_folds(spark: SparkSession, sf_dir: str, spec: RunSpec) -> DataFrame:
    """Training side with a fold number, restricted to the columns of the spec."""
    lines = charges(spark, sf_dir)
    columns = plan_features(spec.feature_cols, spec.label_col, spec.data_types, lines.schema).source_columns
    return spread(
        lines.filter(is_train(line_bucket())).select(*columns, fold_number(line_bucket()).alias("fold"))
    )


def linear_on_quantity(spark: SparkSession, sf_dir: str, reg_param: float) -> PipelineModel:
    stages = [
        VectorAssembler(inputCols=["l_quantity"], outputCol=FEATURES),
        LinearRegression(labelCol="charge", regParam=reg_param),
    ]
    return Pipeline(stages=stages).fit(charges(spark, sf_dir))


def coefficients(spark: SparkSession, sf_dir: str, reg_param: float) -> DataFrame:
    """The fitted line next to the number of rows it was fitted on."""
    fitted = linear_on_quantity(spark, sf_dir, reg_param).stages[-1]
    return charges(spark, sf_dir).agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(round(float(fitted.coefficients[0]), 3)).alias("slope"),
        F.lit(round(float(fitted.intercept), 2)).alias("intercept"),
    )


def lr_unregularised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coefficients(spark, sf_dir, 0.0)


def lr_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coefficients(spark, sf_dir, 100_000.0)


def tuned_on_folds(spark: SparkSession, sf_dir: str, spec: RunSpec, families) -> list[Tuned]:
    with stored(lines_in_folds(spark, sf_dir, spec)) as train:
        plan = plan_features(spec.feature_cols, spec.label_col, spec.data_types, train.schema)
        return tune(train, "fold", preprocessing(plan), families, plan.label)


def cv_lr_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean fold error per grid point and the best of them."""
    (tuned,) = tuned_on_folds(spark, sf_dir, TWO_FEATURES, [LINEAR.with_grid(regParam=RIDGE_GRID)])
    rows = list(zip(RIDGE_GRID, tuned.avg_metrics))
    return spark.createDataFrame(rows, "reg_param double, avg_rmse double").select(
        "reg_param",
        F.round("avg_rmse", 2).alias("avg_rmse"),
        (F.col("avg_rmse") == F.lit(tuned.avg_cv_rmse)).alias("is_best"),
    )


def cv_tree_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold errors of trees on one three-valued category: those of the group means."""
    families = (
        FOREST.with_grid(maxDepth=[3, 5], numTrees=[1], bootstrap=[False]),
        TREE.with_grid(maxDepth=[3, 5]),
        BOOSTED.with_grid(maxDepth=[3], maxIter=[1, 2]),
    )
    tuned = tuned_on_folds(spark, sf_dir, ONE_CATEGORY, families)
    return grid_errors(spark, tuned).withColumn("avg_rmse", F.round("avg_rmse", 3))


def grid_errors(spark: SparkSession, tuned: list[Tuned]) -> DataFrame:
    rows = [(t.family.name, point, error) for t in tuned for point, error in enumerate(t.avg_metrics)]
    return spark.createDataFrame(rows, "model string, point bigint, avg_rmse double")


def saturated(spark: SparkSession, sf_dir: str, estimator) -> DataFrame:
    """A tree with one three-valued category predicts the mean of each value."""
    lines = charges(spark, sf_dir).select("l_returnflag", "l_extendedprice")
    plan = plan_features(
        ONE_CATEGORY.feature_cols, ONE_CATEGORY.label_col, ONE_CATEGORY.data_types, lines.schema
    )
    fitted = preprocessing(plan).fit(lines)
    rows = fitted.transform(lines)
    model = fit_tree(estimator, rows, FEATURES, "l_extendedprice", len(plan.assembler_inputs))
    predicted = model.transform(rows)
    return predicted.groupBy("l_returnflag", F.round("prediction", 4).alias("prediction")).agg(
        F.count("*").alias("row_count")
    )


def tree_saturated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saturated(spark, sf_dir, DecisionTreeRegressor(seed=SEED))


def gbt_saturated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saturated(spark, sf_dir, GBTRegressor(seed=SEED, maxIter=3))


def forest_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saturated(
        spark, sf_dir, RandomForestRegressor(seed=SEED, numTrees=1, bootstrap=False)
    )


def tree_families_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean fold error of every grid point of the tree families."""
    return grid_errors(spark, tuned_on_folds(spark, sf_dir, THREE_FEATURES, (FOREST, TREE, BOOSTED)))


def leaderboard_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on all line items: all families with their default grids."""
    result = run(
        spread(charges(spark, sf_dir)),
        THREE_FEATURES,
        bucket=line_bucket(),
        save_to=scratch_path(spark, "run"),
    )
    return result.leaderboard.drop("run_id").withColumn("model_path", F.lit(result.model_path))


def exact_run(spark: SparkSession, sf_dir: str) -> RunResult:
    """The whole job on one category of all line items, where every family has a closed form."""
    return run(spread(charges(spark, sf_dir)), ONE_CATEGORY, EXACT_FAMILIES, bucket=line_bucket())


def leaderboard_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, search and sizes of the whole job."""
    result = exact_run(spark, sf_dir)
    points = result.grid.groupBy("model").agg(
        F.count("*").alias("grid_points"), F.min("avg_cv_rmse").alias("best_cv_rmse")
    )
    return result.leaderboard.join(points, "model").select(
        "model",
        F.round("rmse", 2).alias("rmse"),
        F.round("r2", 6).alias("r2"),
        F.round("avg_cv_rmse", 2).alias("avg_cv_rmse"),
        (F.col("best_cv_rmse") == F.col("avg_cv_rmse")).alias("best_point_chosen"),
        "grid_points",
        F.lit(result.split_sizes["train"]).cast("bigint").alias("train_rows"),
        F.lit(result.split_sizes["test"]).cast("bigint").alias("test_rows"),
    )


# Three fixed guesses of the charge; scored like models, but any engine can repeat them.
GUESSES = {
    "per price": "l_extendedprice * 25",
    "per quantity": "l_quantity * 50000",
    "undiscounted": "l_quantity * l_extendedprice",
}


def guessed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, str]]:
    columns = {name: f"guess_{i}" for i, name in enumerate(GUESSES)}
    lines = charges(spark, sf_dir).select(
        F.col("l_linestatus").alias("run_id"),
        "charge",
        "l_linenumber",
        *[F.expr(GUESSES[name]).alias(column) for name, column in columns.items()],
        line_bucket().alias("bucket"),
    )
    return lines, columns


def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, columns = guessed(spark, sf_dir)
    return evaluate(lines, "charge", columns, by=["run_id"]).select(
        "run_id", "model", F.round("rmse", 2).alias("rmse"), F.round("r2", 6).alias("r2")
    )


def eval_missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the guesses where first lines have no label and second lines one that is no number."""
    lines, columns = guessed(spark, sf_dir)
    line = F.col("l_linenumber")
    label = F.when(line == 1, None).when(line == 2, float("nan")).otherwise(F.col("charge"))
    return evaluate(
        lines.withColumn("charge", label), "charge", columns, by=["run_id"], rows="row_count"
    ).select(
        "run_id",
        "model",
        F.round("rmse", 2).alias("rmse"),
        F.round("r2", 6).alias("r2"),
        "row_count",
    )


def guess_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per line status: test error and mean fold error of every guess, in one pass."""
    lines, columns = guessed(spark, sf_dir)
    bucket = F.col("bucket")
    part = F.when(is_train(bucket), fold_number(bucket)).otherwise(F.lit(-1))
    errors = evaluate(lines.withColumn("part", part), "charge", columns, by=["run_id", "part"])
    tested, held_out = F.col("part") == -1, F.col("part") >= 0
    scores = errors.groupBy("run_id", "model").agg(
        F.max(F.when(tested, F.col("rmse"))).alias("rmse"),
        F.max(F.when(tested, F.col("r2"))).alias("r2"),
        F.avg(F.when(held_out, F.col("rmse"))).alias("avg_cv_rmse"),
    )
    return rank_models(scores).select(
        "run_id",
        "model",
        F.round("rmse", 2).alias("rmse"),
        F.round("r2", 6).alias("r2"),
        F.round("avg_cv_rmse", 2).alias("avg_cv_rmse"),
        F.col("rank").cast("bigint").alias("rank"),
        "is_best",
    )


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guess_board(spark, sf_dir)


def winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winners(guess_board(spark, sf_dir)).select("run_id", "model", "rmse", "r2")


def result_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_documents(guess_board(spark, sf_dir))


def save_load_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items scored by a model that was saved and loaded again."""
    path = save_model(linear_on_quantity(spark, sf_dir, 0.0), scratch_path(spark, "model"))
    return score(path, charges(spark, sf_dir)).select(
        "l_orderkey", "l_linenumber", F.round("prediction", 2).alias("prediction")
    )


def model_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a saved pipeline: stages in their order, and which of them have data beside their params."""
    path = save_model(linear_on_quantity(spark, sf_dir, 0.0), scratch_path(spark, "model"))
    inside = F.regexp_extract("path", r"stages/([0-9]+)_([A-Za-z]+)_[^/]*/(?:metadata|data)/", 1)
    kind = F.regexp_extract("path", r"stages/[0-9]+_([A-Za-z]+)_", 1)
    folder = F.regexp_extract("path", r"/(metadata|data)/[^/]*$", 1)
    return (
        manifest(spark, path)
        .filter(F.col("length") > 0)
        .select(inside.alias("stage"), kind.alias("kind"), folder.alias("folder"))
        .distinct()
    )


def yearly_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per line status and year of shipping, finished with its last line: the guesses scored and ranked."""
    columns = {name: f"guess_{i}" for i, name in enumerate(GUESSES)}
    lines = charges(spark, sf_dir).select(
        F.col("l_linestatus").alias("dataset"),
        F.date_format("l_shipdate", "yyyy").alias("run_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipped"),
        "charge",
        *[F.expr(GUESSES[name]).alias(column) for name, column in columns.items()],
    )
    keys = ["dataset", "run_id"]
    ends = lines.groupBy(*keys).agg(F.max("shipped").alias("finished_at"))
    scores = evaluate(lines, "charge", columns, by=keys).select(
        *keys, "model", F.round("rmse", 2).alias("rmse"), F.round("r2", 6).alias("r2"), F.lit(0.0).alias("avg_cv_rmse")
    )
    run = F.struct(*keys).alias("run")
    ranked = rank_models(scores.select("*", run), "run").drop("run", "rank")
    path = F.when(F.col("is_best"), F.concat_ws("/", F.lit("models"), *keys, "model"))
    return ranked.join(ends, keys).withColumn("model_path", path)


def run_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest and best model of every data set, after all runs were published, half of them again, and one broke off."""
    root = scratch_path(spark, "catalogue")
    boards = written(yearly_boards(spark, sf_dir), "boards")
    publish(boards, root)
    publish(boards.filter(F.col("run_id") % 2 == 0), root)
    # A run of which the models were written, but not the marker.
    broken = boards.filter("run_id = '1995'").withColumns(
        {"run_id": F.lit("9999"), "finished_at": F.lit("9999-01-01").cast("timestamp"), "rmse": F.lit(0.0)}
    )
    publish(broken, root, finished=False)
    return chosen_models(spark, root).select(
        "dataset",
        "kind",
        "run_id",
        F.date_format("finished_at", "yyyy-MM-dd").alias("finished_on"),
        "model",
        "rmse",
        "model_path",
    )


QUERIES = {
    "run_catalogue": run_catalogue,
    "lr_unregularised": lr_unregularised,
    "lr_ridge": lr_ridge,
    "cv_lr_metrics": cv_lr_metrics,
    "cv_tree_metrics": cv_tree_metrics,
    "tree_saturated": tree_saturated,
    "gbt_saturated": gbt_saturated,
    "forest_single": forest_single,
    "tree_families_grid": tree_families_grid,
    "leaderboard_run": leaderboard_run,
    "leaderboard_exact": leaderboard_exact,
    "eval_metrics": eval_metrics,
    "eval_missing_labels": eval_missing_labels,
    "leaderboard": leaderboard,
    "winner": winner,
    "result_document": result_document,
    "save_load_score": save_load_score,
    "model_manifest": model_manifest,
}

LINES_SQL = f"lines AS (SELECT *, {CHARGE} AS charge, {BUCKET_SQL} AS bucket FROM lineitem)"

GROUP_MEANS_SQL = """
    SELECT l_returnflag, round(avg(l_extendedprice), 4) AS prediction, count(*) AS row_count
    FROM lineitem GROUP BY l_returnflag
"""

GUESSED_SQL = f"""
    WITH {LINES_SQL}, guessed AS ({
    " UNION ALL ".join(
        f"SELECT l_linestatus AS run_id, l_linenumber, bucket, charge, '{name}' AS model, {sql} AS guess FROM lines"
        for name, sql in GUESSES.items()
    )
})
"""
RMSE_SQL = "sqrt(avg((charge - guess) * (charge - guess)))"
R2_SQL = "1 - sum((charge - guess) * (charge - guess)) / (var_pop(charge) * count(*))"

BOARD_SQL = f"""{GUESSED_SQL}, folds AS (
        SELECT run_id, model, bucket % 3 AS fold, {RMSE_SQL} AS rmse
        FROM guessed WHERE bucket < 0.8 * 10007 GROUP BY run_id, model, bucket % 3
    ), cv AS (
        SELECT run_id, model, avg(rmse) AS avg_cv_rmse FROM folds GROUP BY run_id, model
    ), test AS (
        SELECT run_id, model, {RMSE_SQL} AS rmse, {R2_SQL} AS r2
        FROM guessed WHERE bucket >= 0.8 * 10007 GROUP BY run_id, model
    ), board AS (
        SELECT run_id, model, round(rmse, 2) AS rmse, round(r2, 6) AS r2, round(avg_cv_rmse, 2) AS avg_cv_rmse,
               row_number() OVER (PARTITION BY run_id ORDER BY rmse, model) AS rank
        FROM test JOIN cv USING (run_id, model)
    )
"""

# Part -1 is the refit on all training rows, scored on the test part.
EXACT_SQL = f"""
    WITH rows AS (
        SELECT l_returnflag AS v, l_extendedprice AS y,
               CASE WHEN {TRAIN_SQL} THEN {BUCKET_SQL} % 3 ELSE -1 END AS part FROM lineitem
    ), parts AS (SELECT unnest([-1, 0, 1, 2]) AS f
    ), rest AS (SELECT f, v, y FROM parts JOIN rows ON part >= 0 AND part <> f
    ), groups AS (SELECT f, v, count(*) AS n, avg(y) AS m FROM rest GROUP BY f, v
    ), indexed AS (
        SELECT *, row_number() OVER (PARTITION BY f ORDER BY n DESC, v) - 1 AS x FROM groups
    ), moments AS (
        SELECT f, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy, corr(x, y) AS r
        FROM rest JOIN indexed USING (f, v) GROUP BY f
    ), predicted AS (
        SELECT rows.y, i.f, i.m, unnest([
            {{'model': 'Linear Regression', 'point': 0, 'guess': my + r / (1 + 0.1 / sy) * sy / sx * (x - mx)}},
            {{'model': 'Linear Regression', 'point': 1, 'guess': my + r / (1 + 0.01 / sy) * sy / sx * (x - mx)}},
            {{'model': 'Random Forest', 'point': 0, 'guess': i.m}},
            {{'model': 'Decision Tree', 'point': 0, 'guess': i.m}},
            {{'model': 'Gradient Boosted Trees', 'point': 0, 'guess': i.m}},
            {{'model': 'Weighted Average Regressor', 'point': 0, 'guess': my + sign(r) * (x - mx) / sx}}]) AS p
        FROM rows JOIN indexed i ON rows.part = i.f AND rows.v = i.v JOIN moments ON moments.f = i.f
    ), errors AS (
        SELECT f, p.model AS model, p.point AS point, sqrt(avg(pow(y - p.guess, 2))) AS rmse,
               1 - sum(pow(y - p.guess, 2)) / (var_pop(y) * count(*)) AS r2
        FROM predicted GROUP BY ALL
    ), searched AS (
        SELECT model, point, avg(rmse) AS e FROM errors WHERE f >= 0 GROUP BY model, point
        QUALIFY row_number() OVER (PARTITION BY model ORDER BY e, point) = 1
    )
    SELECT model, round(rmse, 2) AS rmse, round(r2, 6) AS r2, round(e, 2) AS avg_cv_rmse,
           true AS best_point_chosen,
           CASE WHEN model IN ('Random Forest', 'Decision Tree') THEN 2 ELSE 4 END::BIGINT AS grid_points,
           (SELECT count(*) FROM rows WHERE part >= 0) AS train_rows,
           (SELECT count(*) FROM rows WHERE part < 0) AS test_rows
    FROM searched JOIN errors USING (model, point) WHERE f = -1
"""

ORACLES = {
    "lr_unregularised": f"""
        WITH {LINES_SQL}
        SELECT count(*) AS row_count, round(regr_slope(charge, l_quantity), 3) AS slope,
               round(regr_intercept(charge, l_quantity), 2) AS intercept
        FROM lines
    """,
    "lr_ridge": f"""
        WITH {LINES_SQL}, m AS (
            SELECT count(*) AS row_count, corr(charge, l_quantity) AS r, stddev_pop(charge) AS sy,
                   stddev_pop(l_quantity) AS sx, avg(charge) AS my, avg(l_quantity) AS mx
            FROM lines
        ), fit AS (SELECT *, r / (1 + 100000.0 / sy) * sy / sx AS b FROM m)
        SELECT row_count, round(b, 3) AS slope, round(my - b * mx, 2) AS intercept FROM fit
    """,
    "cv_lr_metrics": f"""
        WITH {LINES_SQL}, train AS (
            SELECT l_quantity AS a, l_extendedprice AS b, charge AS y, bucket % 3 AS fold
            FROM lines WHERE {TRAIN_SQL}
        ), folds AS (SELECT DISTINCT fold FROM train
        ), grid AS (SELECT unnest([1000.0, 0.01])::DOUBLE AS reg_param
        ), m AS (
            SELECT folds.fold, avg(a) AS ma, avg(b) AS mb, avg(y) AS my,
                   stddev_pop(a) AS sa, stddev_pop(b) AS sb, stddev_pop(y) AS sy,
                   corr(a, b) AS rab, corr(a, y) AS ra, corr(b, y) AS rb
            FROM folds JOIN train ON train.fold <> folds.fold GROUP BY folds.fold
        ), solved AS (
            SELECT m.*, reg_param, 1 + reg_param / sy AS d FROM m, grid
        ), coef AS (
            SELECT *, (d * ra - rab * rb) / (d * d - rab * rab) * sy / sa AS ca,
                   (d * rb - rab * ra) / (d * d - rab * rab) * sy / sb AS cb
            FROM solved
        ), errors AS (
            SELECT coef.fold, reg_param,
                   sqrt(avg(pow(y - my - ca * (a - ma) - cb * (b - mb), 2))) AS rmse
            FROM coef JOIN train ON train.fold = coef.fold GROUP BY coef.fold, reg_param
        ), averages AS (SELECT reg_param, avg(rmse) AS avg_rmse FROM errors GROUP BY reg_param)
        SELECT reg_param, round(avg_rmse, 2) AS avg_rmse,
               avg_rmse = (SELECT min(avg_rmse) FROM averages) AS is_best
        FROM averages
    """,
    "cv_tree_metrics": f"""
        WITH train AS (
            SELECT l_returnflag, l_extendedprice AS y, {BUCKET_SQL} % 3 AS fold FROM lineitem WHERE {TRAIN_SQL}
        ), means AS (
            SELECT f, l_returnflag, avg(y) AS m FROM train, (SELECT unnest([0, 1, 2]) AS f)
            WHERE fold <> f GROUP BY f, l_returnflag
        ), errors AS (
            SELECT fold, sqrt(avg(pow(y - m, 2))) AS rmse
            FROM train JOIN means ON means.f = fold AND means.l_returnflag = train.l_returnflag GROUP BY fold
        )
        SELECT model, point::BIGINT AS point, round((SELECT avg(rmse) FROM errors), 3) AS avg_rmse
        FROM (SELECT unnest(['Random Forest', 'Decision Tree', 'Gradient Boosted Trees']) AS model),
             (SELECT unnest([0, 1]) AS point)
    """,
    "tree_saturated": GROUP_MEANS_SQL,
    "gbt_saturated": GROUP_MEANS_SQL,
    "forest_single": GROUP_MEANS_SQL,
    "eval_metrics": f"""{GUESSED_SQL}
        SELECT run_id, model, round({RMSE_SQL}, 2) AS rmse, round({R2_SQL}, 6) AS r2
        FROM guessed GROUP BY run_id, model
    """,
    "eval_missing_labels": f"""{GUESSED_SQL}, labelled AS (SELECT * FROM guessed WHERE l_linenumber > 2)
        SELECT run_id, model, rmse, r2, row_count
        FROM (SELECT run_id, model, round({RMSE_SQL}, 2) AS rmse, round({R2_SQL}, 6) AS r2
              FROM labelled GROUP BY run_id, model)
        JOIN (SELECT run_id, model, count(*) AS row_count FROM guessed GROUP BY run_id, model)
        USING (run_id, model)
    """,
    "leaderboard_exact": EXACT_SQL,
    "run_catalogue": f"""{GUESSED_SQL.replace('l_linestatus AS run_id', "l_linestatus AS dataset, strftime(l_shipdate, '%Y') AS run_id, l_shipdate")},
        scored AS (
            SELECT dataset, run_id, model, max(l_shipdate) AS ended, round({RMSE_SQL}, 2) AS rmse
            FROM guessed GROUP BY dataset, run_id, model
        ), winners AS (
            SELECT dataset, run_id, model, rmse, 'models/' || dataset || '/' || run_id || '/' || model AS model_path,
                   (SELECT max(ended) FROM scored s WHERE s.dataset = scored.dataset AND s.run_id = scored.run_id) AS ended
            FROM scored QUALIFY row_number() OVER (PARTITION BY dataset, run_id ORDER BY rmse, model) = 1
        ), chosen AS (
            SELECT 'latest' AS kind, * FROM winners
            QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY ended DESC, run_id DESC) = 1
            UNION ALL
            SELECT 'best', * FROM winners
            QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY rmse, run_id) = 1
        )
        SELECT dataset, kind, run_id, strftime(ended, '%Y-%m-%d') AS finished_on, model, rmse, model_path FROM chosen
    """,
    "model_manifest": """
        SELECT * FROM (VALUES ('', '', 'metadata'), ('0', 'VectorAssembler', 'metadata'),
            ('1', 'LinearRegression', 'metadata'), ('1', 'LinearRegression', 'data'))
            AS parts(stage, kind, folder)
    """,
    "leaderboard": f"""{BOARD_SQL}
        SELECT run_id, model, rmse, r2, avg_cv_rmse, rank, rank = 1 AS is_best FROM board
    """,
    "winner": f"{BOARD_SQL} SELECT run_id, model, rmse, r2 FROM board WHERE rank = 1",
    "result_document": f"""{BOARD_SQL}
        SELECT run_id, CAST(json_object(
                   'best_model_name', max(model) FILTER (rank = 1), 'best_rmse', max(rmse) FILTER (rank = 1),
                   'results', to_json(list({{'model': model, 'rmse': rmse, 'r2': r2,
                                            'avg_cv_rmse': avg_cv_rmse}} ORDER BY model))
               ) AS VARCHAR) AS document
        FROM board GROUP BY run_id
    """,
    "save_load_score": f"""
        WITH {LINES_SQL}, fit AS (
            SELECT regr_slope(charge, l_quantity) AS slope, regr_intercept(charge, l_quantity) AS intercept
            FROM lines
        )
        SELECT l_orderkey, l_linenumber, round(slope * l_quantity + intercept, 2) AS prediction
        FROM lineitem, fit
    """,
}
