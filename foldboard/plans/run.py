"""The whole job: read, check, split, search, score, rank, save."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from foldboard.functions.metrics import evaluate, has_label
from foldboard.operators.features import plan_features, preprocessing
from foldboard.operators.split import (
    NUM_FOLDS,
    drawn_fold,
    drawn_for_training,
    fold_number,
    hash_split,
    row_bucket,
    with_draws,
)
from foldboard.plans.families import DEFAULT_FAMILIES, Family
from foldboard.plans.leaderboard import rank_models, result_documents
from foldboard.plans.spec import RunSpec
from foldboard.plans.tuning import PARALLELISM, stored, tune, with_predictions
from foldboard.scratch import scratch_root
from foldboard.sources.registry import model_path, save_model
from foldboard.sources.tables import read_table, spread

BUCKET = "_bucket"
FOLD = "_fold"
GRID_SCHEMA = "model string, point int, params string, avg_cv_rmse double, is_chosen boolean"
SCORE_SCHEMA = "run_id string, model string, rmse double, r2 double, avg_cv_rmse double"


@dataclass(frozen=True)
class RunResult:
    """Ranked models of one run. ``model_path`` is None unless the run saved its winner.

    ``split_sizes`` counts the rows of either side, ``grid`` has a row per family and
    grid point: model, point, params as JSON, avg_cv_rmse, and whether the point was chosen.
    """

    run_id: str
    leaderboard: DataFrame
    best_model_name: str
    best_rmse: float
    best_model: PipelineModel
    model_path: str | None
    split_sizes: dict[str, int] = field(default_factory=dict)
    grid: DataFrame | None = None

    def document(self) -> dict:
        """The result as plain values; a handful of rows."""
        board = self.leaderboard.withColumn("model_path", F.lit(self.model_path))
        return json.loads(result_documents(board, path="model_path").first()["document"])


def run(
    df: DataFrame,
    spec: RunSpec,
    families: Sequence[Family] = DEFAULT_FAMILIES,
    *,
    bucket: Column | None = None,
    split: str = "hash",
    drop_null_label: bool = False,
    strict: bool = True,
    save_to: str | None = None,
    num_folds: int = NUM_FOLDS,
    parallelism: int = PARALLELISM,
) -> RunResult:
    """Train every family on ``df`` and rank them by the error on the held-out rows.

    ``bucket`` decides side and fold of a row, see
    :func:`foldboard.operators.split.key_bucket`; without it the contents of the
    used columns do. ``split="random"`` draws sides and folds instead, which keeps
    their sizes even where copies of few rows fill the table; see
    :func:`foldboard.operators.split.with_draws`. With ``save_to``
    the winner is saved below that folder.
    """
    spec.require(df.schema, strict)
    spark = df.sparkSession
    scratch_root(spark)  # boosting checkpoints into it
    plan = plan_features(spec.feature_cols, spec.label_col, spec.data_types, df.schema)

    # Only what the run needs is kept, so the cache never holds ignored columns.
    columns = plan.source_columns
    contents = row_bucket(*columns)
    # A row whose key is missing is placed by its contents.
    place = contents if bucket is None else F.coalesce(bucket, contents)
    rows = df.select(*columns, place.alias(BUCKET))
    if drop_null_label:
        label, numeric = F.col(spec.label_col), df.schema[spec.label_col].dataType
        missing = ~has_label(label) if isinstance(numeric, NumericType) else label.isNull()
        rows = rows.filter(~missing)
    if split == "random":
        drawn = with_draws(rows, columns)
        side = drawn_for_training(spec.train_test_split)
        train, test = drawn.filter(side), drawn.filter(~side)
        fold = drawn_fold(num_folds)
    elif split == "hash":
        train, test = hash_split(rows, F.col(BUCKET), spec.train_test_split)
        fold = fold_number(F.col(BUCKET), num_folds)
    else:
        raise ValueError(f"split must be 'hash' or 'random', not {split!r}")
    train = train.select(*columns, fold.alias(FOLD))
    with stored(train) as rows:
        sizes = {"train": rows.count()}
        tuned = tune(
            rows,
            FOLD,
            preprocessing(plan),
            families,
            plan.label,
            num_folds=num_folds,
            parallelism=parallelism,
        )

    # The families share the preprocessing stages; only their last stage differs.
    shared = PipelineModel(tuned[0].model.stages[:-1])
    scored, predictions = with_predictions(
        shared.transform(test), {t.family.name: t.model.stages[-1] for t in tuned}
    )
    counted = evaluate(scored, plan.label, predictions, rows="test_rows")
    scores = {row["model"]: row for row in counted.collect()}
    if not scores:
        raise ValueError("the test part has no rows")
    sizes["test"] = next(iter(scores.values()))["test_rows"]

    run_id = str(uuid.uuid4())
    board = rank_models(
        spark.createDataFrame(
            [
                (run_id, name, scores[name]["rmse"], scores[name]["r2"], t.avg_cv_rmse)
                for t in tuned
                for name in [t.family.name]
            ],
            SCORE_SCHEMA,
        )
    )
    best = board.filter("is_best").first()
    if best is None:
        raise ValueError("no model has a finite error on the test part")
    model = next(t.model for t in tuned if t.family.name == best["model"])
    path = save_model(model, model_path(save_to, best["model"])) if save_to else None
    points = [
        (t.family.name, point, json.dumps(params, sort_keys=True), error, params == t.params)
        for t in tuned
        for point, (params, error) in enumerate(zip(t.points, t.avg_metrics, strict=True))
    ]
    grid = spark.createDataFrame(points, GRID_SCHEMA)
    return RunResult(run_id, board, best["model"], best["rmse"], model, path, sizes, grid)


def run_file(
    spark: SparkSession,
    path: str,
    spec: RunSpec,
    *,
    schema=None,
    spread_small: bool = False,
    **options,
) -> RunResult:
    """:func:`run` on a CSV or parquet location.

    ``spread_small`` deals a source of fewer partitions than cores out to all of them.
    """
    df = read_table(spark, path, schema)
    return run(spread(df) if spread_small else df, spec, **options)
