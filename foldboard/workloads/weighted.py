"""Queries on the weighted-average regressor."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.functions.metrics import evaluate
from foldboard.operators.features import FEATURES
from foldboard.operators.split import NUM_FOLDS
from foldboard.operators.weighted_average import (
    WeightedAverageRegressionModel,
    WeightedAverageRegressor,
)
from foldboard.plans.families import WEIGHTED_AVERAGE
from foldboard.workloads.models import TWO_FEATURES, tuned_on_folds
from foldboard.workloads.tables import BUCKET_SQL, CHARGE, TRAIN_SQL, charges, table

COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = charges(spark, sf_dir)
    return VectorAssembler(inputCols=list(COLUMNS), outputCol=FEATURES).transform(lines)


def fitted(spark: SparkSession, sf_dir: str, **params) -> WeightedAverageRegressionModel:
    return WeightedAverageRegressor(labelCol="charge", **params).fit(vectors(spark, sf_dir))


def by_feature(spark: SparkSession, model: WeightedAverageRegressionModel, **lists) -> DataFrame:
    """Fitted values, one row per feature."""
    rows = list(zip(range(model.numFeatures), *[[float(v) for v in values] for values in lists.values()]))
    schema = "pos bigint, " + ", ".join(f"{name} double" for name in lists)
    return spark.createDataFrame(rows, schema)


def war_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fitted(spark, sf_dir)
    means, stds = model.getOrDefault(model.means), model.getOrDefault(model.stds)
    return by_feature(spark, model, mean=means, std=stds).select(
        "pos",
        F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"),
        F.lit(round(model.getOrDefault(model.bias), 3)).alias("bias"),
    )


def war_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fitted(spark, sf_dir)
    return by_feature(spark, model, weight=model.getOrDefault(model.weights)).select(
        "pos", F.round("weight", 9).alias("weight")
    )


def war_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fitted(spark, sf_dir).interactions()
    return spark.createDataFrame(pairs, "i bigint, j bigint, weight double").select(
        "i", "j", F.round("weight", 9).alias("weight")
    )


WIDE_ELEMENTS = 64
WIDE_LABEL = "(1 + embedding[{0}]) * (1 + embedding[{0}])"


def war_wide_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a vector whose elements all lean on one of them, so that all 2,016 are tried."""
    element = F.col("embedding").cast("array<double>")
    leaning = [element[i] + 2 * element[0] for i in range(WIDE_ELEMENTS)]
    rows = table(spark, sf_dir, "embeddings").select(
        array_to_vector(F.array(*leaning)).alias(FEATURES),
        F.expr(WIDE_LABEL.format(0).replace("embedding[", "cast(embedding AS array<double>)[")).alias("label"),
    )
    pairs = WeightedAverageRegressor().fit(rows).interactions()
    return spark.createDataFrame(pairs, "i bigint, j bigint, weight double").select(
        "i", "j", F.round("weight", 9).alias("weight")
    )


def war_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every prediction from the mean label."""
    rows = vectors(spark, sf_dir)
    model = WeightedAverageRegressor(labelCol="charge").fit(rows)
    offset = F.col("prediction") - F.lit(model.getOrDefault(model.bias))
    return model.transform(rows).select(
        "l_orderkey", "l_linenumber", (F.round(offset, 3) + 0.0).alias("offset")
    )


def war_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fitted(spark, sf_dir)
    return by_feature(spark, model, importance=model.featureImportances().toArray()).select(
        "pos", F.round("importance", 9).alias("importance")
    )


def war_no_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fitted(spark, sf_dir, useInteractions=False)
    return by_feature(
        spark,
        model,
        weight=model.getOrDefault(model.weights),
        importance=model.featureImportances().toArray(),
    ).select("pos", F.round("weight", 9).alias("weight"), F.round("importance", 9).alias("importance"))


def war_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir)
    model = WeightedAverageRegressor(labelCol="charge").fit(rows)
    return evaluate(model.transform(rows), "charge", {"weighted average": "prediction"}).select(
        "model", F.round("rmse", 2).alias("rmse"), F.round("r2", 9).alias("r2")
    )


def war_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide vector: correlations with the label without interactions."""
    rows = table(spark, sf_dir, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias(FEATURES), "label"
    )
    model = WeightedAverageRegressor(useInteractions=False).fit(rows)
    return by_feature(spark, model, weight=model.getOrDefault(model.weights)).select(
        "pos", F.round("weight", 9).alias("weight")
    )


def war_fold_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold errors of one grid point on two raw features."""
    lines = charges(spark, sf_dir).selectExpr(
        "l_quantity", "l_extendedprice", "charge", f"{BUCKET_SQL} AS bucket"
    )
    rows = VectorAssembler(inputCols=["l_quantity", "l_extendedprice"], outputCol=FEATURES).transform(
        lines.filter("bucket < 0.8 * 10007")
    )
    errors = []
    for fold in range(NUM_FOLDS):
        own = F.col("bucket") % NUM_FOLDS == fold
        model = WeightedAverageRegressor(labelCol="charge").fit(rows.filter(~own))
        scored = model.transform(rows.filter(own))
        errors.append(evaluate(scored, "charge", {str(fold): "prediction"}))
    return errors[0].union(errors[1]).union(errors[2]).select(
        F.col("model").cast("bigint").alias("fold"), F.round("rmse", 2).alias("rmse")
    )


def war_cv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean fold error over the family's own grid, fitted jointly in every fold."""
    (tuned,) = tuned_on_folds(spark, sf_dir, TWO_FEATURES, [WEIGHTED_AVERAGE])
    points = WEIGHTED_AVERAGE.param_maps(WeightedAverageRegressor())
    rows = [
        (*[value for _, value in sorted((p.name, v) for p, v in point.items())], metric)
        for point, metric in zip(points, tuned.avg_metrics)
    ]
    schema = "regularization double, use_interactions boolean, avg_rmse double"
    return spark.createDataFrame(rows, schema).withColumn("avg_rmse", F.round("avg_rmse", 3))


QUERIES = {
    "war_moments": war_moments,
    "war_weights": war_weights,
    "war_pairs": war_pairs,
    "war_wide_pairs": war_wide_pairs,
    "war_predict": war_predict,
    "war_importance": war_importance,
    "war_no_interactions": war_no_interactions,
    "war_rmse": war_rmse,
    "war_embeddings": war_embeddings,
    "war_fold_models": war_fold_models,
    "war_cv_metrics": war_cv_metrics,
}


def model_sql(
    rows: str,
    columns: tuple[str, ...],
    label: str,
    group: str = "0",
    shrinkage: str = "1.01",
    interactions: str = "true",
) -> str:
    """Common table expressions of one fit per ``group``: ``fit``, ``kept`` and ``total``.

    ``shrinkage`` and ``interactions`` may depend on the group, ``g``.
    """
    long = " UNION ALL ".join(
        f"SELECT {group} AS g, {i} AS pos, {c} AS x, {label} AS y FROM {rows}" for i, c in enumerate(columns)
    )
    listed = f"SELECT {group} AS g, [{', '.join(columns)}] AS xs, {label} AS y FROM {rows}"
    return f"""
        long AS ({long}),
        fit AS (
            SELECT g, pos, mean, std, bias, sign(r) * r * r / ({shrinkage}) AS w FROM (
                SELECT g, pos, avg(x) AS mean, greatest(stddev_pop(x), 1e-8) AS std, avg(y) AS bias,
                       CASE WHEN stddev_pop(x) > 1e-8
                            THEN coalesce(covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0), 0)
                            ELSE 0 END AS r
                FROM long GROUP BY g, pos)
        ),
        candidates AS (
            SELECT a.g, a.pos AS i, b.pos AS j
            FROM (SELECT * FROM fit WHERE {interactions}) a JOIN fit b ON a.g = b.g AND a.pos < b.pos
            WHERE abs(a.w) > 0.1 AND abs(b.w) > 0.1
        ),
        products AS (
            SELECT c.g, i, j, xs[i + 1] * xs[j + 1] AS x, y FROM ({listed}) r JOIN candidates c ON r.g = c.g
        ),
        kept AS (
            SELECT * FROM (
                SELECT g, i, j, CASE WHEN stddev_pop(x) > 1e-8
                                     THEN coalesce(covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0), 0)
                                     ELSE 0 END / 2 AS v
                FROM products GROUP BY g, i, j)
            WHERE abs(v) > 0.025
        ),
        total AS (
            SELECT g, sum(abs(w)) AS s
            FROM (SELECT g, w FROM fit UNION ALL SELECT g, v FROM kept) GROUP BY g
        )
    """


LINES_SQL = f"lines AS (SELECT *, {CHARGE} AS charge FROM lineitem)"
FIT_SQL = f"WITH {LINES_SQL}, {model_sql('lines', COLUMNS, 'charge')}"
PLAIN_SQL = f"WITH {LINES_SQL}, {model_sql('lines', COLUMNS, 'charge', interactions='false')}"
OFFSET_SQL = f"""{FIT_SQL}, wide AS (
        SELECT {', '.join(
            f"max(CASE WHEN pos = {i} THEN w / s END) AS w{i}, max(CASE WHEN pos = {i} THEN mean END) AS m{i}, "
            f"max(CASE WHEN pos = {i} THEN std END) AS d{i}" for i in range(len(COLUMNS))
        )}, max(bias) AS bias
        FROM fit JOIN total USING (g)
    ), z AS (
        SELECT l_orderkey, l_linenumber, charge, bias,
               [{', '.join(f"({c} - m{i}) / d{i}" for i, c in enumerate(COLUMNS))}] AS zs,
               {' + '.join(f"w{i} * (({c} - m{i}) / d{i})" for i, c in enumerate(COLUMNS))} AS linear
        FROM lines, wide
    ), terms AS (
        SELECT list({{'i': i + 1, 'j': j + 1, 'v': v / s}} ORDER BY i, j) AS terms FROM kept JOIN total USING (g)
    ), predicted AS (
        SELECT l_orderkey, l_linenumber, charge, bias,
               linear + coalesce(list_sum([t.v * zs[t.i] * zs[t.j] FOR t IN terms]), 0) AS offset_value
        FROM z, terms
    )
"""
IMPORTANCE_SQL = """
    shares AS (
        SELECT pos, sum(share) AS share FROM (
            SELECT pos, abs(w) AS share FROM fit
            UNION ALL SELECT i, abs(v) / 2 FROM kept
            UNION ALL SELECT j, abs(v) / 2 FROM kept) GROUP BY pos
    )
"""

# Prediction of a model with two features x0 and x1 and its joins.
PAIR_PREDICTION_SQL = """
    a.bias + a.w / s * ((x0 - a.mean) / a.std) + b.w / s * ((x1 - b.mean) / b.std)
    + coalesce(v / s, 0) * ((x0 - a.mean) / a.std) * ((x1 - b.mean) / b.std)
"""


def pair_joins_sql(condition: str) -> str:
    return f"""
        JOIN fit a ON {condition} AND a.pos = 0 JOIN fit b ON b.g = a.g AND b.pos = 1
        JOIN total ON total.g = a.g LEFT JOIN kept ON kept.g = a.g
    """


ORACLES = {
    "war_moments": f"""{FIT_SQL}
        SELECT pos::BIGINT AS pos, round(mean, 6) AS mean, round(std, 6) AS std, round(bias, 3) AS bias FROM fit
    """,
    "war_weights": f"""{FIT_SQL}
        SELECT pos::BIGINT AS pos, round(w / s, 9) AS weight FROM fit JOIN total USING (g)
    """,
    "war_pairs": f"""{FIT_SQL}
        SELECT i::BIGINT AS i, j::BIGINT AS j, round(v / s, 9) AS weight FROM kept JOIN total USING (g)
    """,
    "war_wide_pairs": f"""
        WITH wide AS (SELECT embedding::DOUBLE[] AS embedding FROM embeddings), {model_sql(
            'wide',
            [f'embedding[{i + 1}] + 2 * embedding[1]' for i in range(WIDE_ELEMENTS)],
            WIDE_LABEL.format(1),
        )}
        SELECT i::BIGINT AS i, j::BIGINT AS j, round(v / s, 9) AS weight FROM kept JOIN total USING (g)
    """,
    "war_predict": f"""{OFFSET_SQL}
        SELECT l_orderkey, l_linenumber, round(offset_value, 3) + 0.0 AS "offset" FROM predicted
    """,
    "war_importance": f"""{FIT_SQL}, {IMPORTANCE_SQL}
        SELECT pos::BIGINT AS pos, round(share / (SELECT sum(share) FROM shares), 9) AS importance FROM shares
    """,
    "war_no_interactions": f"""{PLAIN_SQL}
        SELECT pos::BIGINT AS pos, round(w / s, 9) AS weight, round(abs(w) / s, 9) AS importance
        FROM fit JOIN total USING (g)
    """,
    "war_rmse": f"""{OFFSET_SQL}
        SELECT 'weighted average' AS model,
               round(sqrt(avg(pow(charge - offset_value - bias, 2))), 2) AS rmse,
               round(1 - sum(pow(charge - offset_value - bias, 2)) / (var_pop(charge) * count(*)), 9) AS r2
        FROM predicted
    """,
    "war_embeddings": """
        WITH long AS (
            SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos
            FROM embeddings
        ), fit AS (
            SELECT pos, sign(r) * r * r / 1.01 AS w
            FROM (SELECT pos, covar_pop(x, label) / (stddev_pop(x) * stddev_pop(label)) AS r FROM long GROUP BY pos)
        )
        SELECT pos, round(w / (SELECT sum(abs(w)) FROM fit), 9) AS weight FROM fit
    """,
    "war_fold_models": f"""
        WITH raw AS (
            SELECT l_quantity AS x0, l_extendedprice AS x1, {CHARGE} AS charge, {BUCKET_SQL} % 3 AS fold
            FROM lineitem WHERE {TRAIN_SQL}
        ), train AS (
            SELECT f AS held_out, raw.* FROM raw, (SELECT unnest([0, 1, 2]) AS f) WHERE fold <> f
        ), {model_sql('train', ('x0', 'x1'), 'charge', group='held_out')},
        scored AS (
            SELECT a.g, fold, charge, {PAIR_PREDICTION_SQL} AS prediction FROM raw {pair_joins_sql('a.g = fold')}
        )
        SELECT fold, round(sqrt(avg(pow(charge - prediction, 2))), 2) AS rmse FROM scored GROUP BY fold
    """,
    # Groups are 10 * held-out fold + grid point; features are standardised per fold first.
    "war_cv_metrics": f"""
        WITH raw AS (
            SELECT l_quantity, l_extendedprice, {CHARGE} AS charge, {BUCKET_SQL} % 3 AS fold
            FROM lineitem WHERE {TRAIN_SQL}
        ), held AS (
            SELECT f, raw.* FROM raw, (SELECT unnest([0, 1, 2]) AS f)
        ), scale AS (
            SELECT f, avg(l_quantity) AS m0, stddev_samp(l_quantity) AS d0,
                   avg(l_extendedprice) AS m1, stddev_samp(l_extendedprice) AS d1
            FROM held WHERE fold <> f GROUP BY f
        ), standardised AS (
            SELECT 10 * f + point AS fit_group, fold, f, charge,
                   (l_quantity - m0) / d0 AS x0, (l_extendedprice - m1) / d1 AS x1
            FROM held JOIN scale USING (f), (SELECT unnest([0, 1, 2, 3]) AS point)
        ), train AS (SELECT * FROM standardised WHERE fold <> f
        ), test AS (SELECT * FROM standardised WHERE fold = f
        ), {model_sql('train', ('x0', 'x1'), 'charge', group='fit_group',
                      shrinkage='CASE WHEN g % 10 < 2 THEN 1.01 ELSE 1.1 END', interactions='g % 2 = 0')},
        scored AS (
            SELECT a.g, charge, {PAIR_PREDICTION_SQL} AS prediction FROM test {pair_joins_sql('a.g = fit_group')}
        ),
        errors AS (SELECT g, sqrt(avg(pow(charge - prediction, 2))) AS rmse FROM scored GROUP BY g)
        SELECT CASE WHEN g % 10 < 2 THEN 0.01::DOUBLE ELSE 0.1::DOUBLE END AS regularization,
               g % 2 = 0 AS use_interactions, round(avg(rmse), 3) AS avg_rmse
        FROM errors GROUP BY 1, 2
    """,
}
