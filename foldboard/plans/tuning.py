"""Cross-validated grid search over several families at once.

Gives the numbers of a cross-validator per family around the whole pipeline,
but preprocessing is fitted once for all folds instead of once per fit (it does not
depend on model parameters, and its statistics add up over folds), grid points share fits where one contains the
other, and all models of a fold are scored in a single pass over its rows. Trees of large tables
are grown and scored on rows summed up by cell, see :mod:`foldboard.operators.cells`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Collection, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.functions.metrics import evaluate
from foldboard.operators.cells import Grid, bags_of, cells_of, fit_cells, grid_of, learns_from_cells, rmse_by_cell
from foldboard.operators.features import FEATURES
from foldboard.operators.fold_statistics import FoldPreps, fit_per_fold
from foldboard.operators.gram import ridge_errors
from foldboard.operators.split import NUM_FOLDS
from foldboard.operators.weighted_average import vector_size
from foldboard.plans.families import SEED, WIDEST_NORMAL_EQUATIONS, Family

PARALLELISM = 3
# Trees of a forest that are grown on cells at the same time: jobs of a single short task each.
TREES_AT_ONCE = 8
POOL = "spark.scheduler.pool"


@dataclass(frozen=True)
class Tuned:
    """Outcome of the search for one family."""

    family: Family
    params: dict[str, object]
    avg_metrics: list[float]
    model: PipelineModel
    # The params of every grid point, in the order of avg_metrics.
    points: list[dict[str, object]] = field(default_factory=list)

    @property
    def avg_cv_rmse(self) -> float:
        """The smallest mean error; NaN only if all are."""
        return min(self.avg_metrics, key=lambda error: (math.isnan(error), error))


@dataclass(frozen=True)
class _Fit:
    """One fit and the grid points it answers: ``{point: stage}``, stage None for the whole model."""

    family: Family
    estimator: Estimator
    param_maps: list[dict]
    points: list[dict[int, int | None]]

    @property
    def estimators(self) -> list[Estimator]:
        """One per model."""
        return [self.estimator.copy(params) for params in self.param_maps]

    @cached_property
    def by_cell(self) -> bool:
        """Whether rows summed up by cell suffice."""
        return all(map(learns_from_cells, self.estimators))


def tune(
    train: DataFrame,
    fold: str,
    prep: Pipeline,
    families: Sequence[Family],
    label: str,
    features: str = FEATURES,
    num_folds: int = NUM_FOLDS,
    parallelism: int = PARALLELISM,
) -> list[Tuned]:
    """Search every family's grid, then refit its best point on all of ``train``.

    ``fold`` names an integer column in ``[0, num_folds)``. ``train`` is read
    many times and should be persisted.
    """
    spark = train.sparkSession
    # Preprocessing for every fold, and for all rows at the end. The first pass, a single job, also fills
    # the cache of a persisted table before the fits compete for it.
    preps = fit_per_fold(
        prep, train, fold, num_folds, lambda tasks: run_parallel(spark, tasks, parallelism), label
    )
    *fold_preps, whole_prep = preps.models
    solved = _solved(train, fold, preps, families, label, features)
    rests = [train.filter(F.col(fold) != number) for number in range(num_folds)]

    # Folds take turns: only one of them has its prepared rows in storage at a time,
    # and the fits of one fold keep all threads busy.
    errors = []
    for number, (rest, fitted_prep) in enumerate(zip(rests, fold_preps)):
        held_out = train.filter(F.col(fold) == number)
        errors.append(solved[number])
        prepared = _prepared(fitted_prep, rest, features, label)
        fits = [
            fit
            for family in families
            for fit in _planned_fits(
                family,
                label,
                features,
                lambda: vector_size(prepared, features),
                {point for name, point in solved[number] if name == family.name},
            )
        ]
        if not fits:
            continue
        held_out = _prepared(fitted_prep, held_out, features, label)
        with stored(prepared) as rows:
            errors[-1] |= _errors_of_fits(fits, rows, held_out, label, features, parallelism)

    best = []
    for family in families:
        estimator = family.estimator()
        maps = family.param_maps(estimator)
        averages = [
            sum(fold_errors[family.name, point] for fold_errors in errors) / num_folds
            for point in range(len(maps))
        ]
        point = min(range(len(maps)), key=lambda p: (math.isnan(averages[p]), averages[p]))
        best.append((family, maps[point], averages))

    def final(family: Family, params: dict) -> _Fit:
        estimator = _columns(family.estimator(), label, features)
        # Params belong to an instance, so they are carried over by name.
        own = {estimator.getParam(param.name): value for param, value in params.items()}
        return _Fit(family, estimator, [own], [{0: None}])

    refits = sorted(best, key=lambda item: -_cost(item[1]))
    finals = [final(family, params) for family, params, _ in refits]
    with stored(_prepared(whole_prep, train, features, label)) as rows, _in_cells(finals, rows, label, features) as (
        _,
        cells,
    ):
        models = [m for (m,) in run_parallel(spark, [lambda f=f: _fit(f, rows, cells) for f in finals], parallelism)]
    finals = {family.name: model for (family, _, _), model in zip(refits, models)}
    return [
        Tuned(
            family,
            {param.name: value for param, value in params.items()},
            averages,
            PipelineModel([*whole_prep.stages, finals[family.name]]),
            [
                {param.name: value for param, value in point.items()}
                for point in family.param_maps(family.estimator())
            ],
        )
        for family, params, averages in best
    ]


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept in memory, or on disk where memory ends, while the block runs."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def run_parallel(spark: SparkSession, tasks: Iterable[Callable], parallelism: int) -> list:
    """Results of driver-side calls that each submit Spark jobs, in order.

    Unless the caller chose a scheduler pool, every call gets its own. With
    ``spark.scheduler.mode=FAIR`` short fits then pass long ones.
    """
    tasks = list(tasks)
    if parallelism <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    context = spark.sparkContext
    own_pools = context.getLocalProperty(POOL) is None

    def start(number: int, task: Callable):
        if own_pools:
            context.setLocalProperty(POOL, f"foldboard-{number}")
        return task()

    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks))) as pool:
        # Every call gets its own copy of the caller's job group and local properties.
        futures = [
            pool.submit(inheritable_thread_target(spark)(start), number, task)
            for number, task in enumerate(tasks)
        ]
        return [future.result() for future in futures]


def _prepared(fitted: PipelineModel, df: DataFrame, features: str, label: str) -> DataFrame:
    return fitted.transform(df).select(features, label)


def _columns(estimator: Estimator, label: str, features: str) -> Estimator:
    return estimator.setLabelCol(label).setFeaturesCol(features)


def _solved(
    train: DataFrame, fold: str, preps: FoldPreps, families: Sequence[Family], label: str, features: str
) -> list[dict[tuple[str, int], float]]:
    """Per fold, the errors of the grid points that are ridge regressions, all from one pass; none if others need the fits."""
    penalties: dict[tuple[str, int], float] = {}
    for family in families:
        if family.ridge:
            estimator = _columns(family.estimator(), label, features)
            width = len(preps.stages.assembler.getInputCols()) if preps.stages else WIDEST_NORMAL_EQUATIONS + 1
            for point, params in enumerate(family.param_maps(estimator)):
                penalty = family.ridge(estimator.copy(params), width)
                if penalty is not None:
                    penalties[family.name, point] = penalty
    distinct = sorted(set(penalties.values()))
    errors = ridge_errors(train, fold, preps, label, distinct)
    if errors is None:
        return [{} for _ in preps.models[:-1]]
    return [{key: own[distinct.index(p)] for key, p in penalties.items()} for own in errors]


def _planned_fits(
    family: Family,
    label: str,
    features: str,
    width: int | Callable[[], int],
    solved: Collection[int] = (),
) -> list[_Fit]:
    """Fewest fits that answer all grid points of a family but the ``solved`` ones."""
    estimator = _columns(family.estimator(), label, features)
    maps = family.param_maps(estimator)
    if len(solved) == len(maps):
        return []
    if family.joint_fit:
        return [_Fit(family, estimator, maps, [{point: None} for point in range(len(maps))])]
    staged = family.staged_by if family.staged_by in family.grid else None
    # Points that differ only in ignored values or in the stage share a fit.
    groups: dict[tuple, dict[int, int | None]] = {}
    for point, params in enumerate(maps):
        if point in solved:
            continue
        values = {param.name: value for param, value in params.items()}
        size = width() if family.ignores and callable(width) else width
        shared = family.ignores(estimator.copy(params), size) if family.ignores else set()
        rest = tuple((n, v) for n, v in values.items() if n != staged and n not in shared)
        groups.setdefault(rest, {})[point] = values[staged] if staged else None
    return [
        _Fit(family, estimator, [maps[max(points, key=lambda p: points[p] or 0)]], [points])
        for points in groups.values()
    ]


def _fit(fit: _Fit, rows: DataFrame, cells: DataFrame | None = None) -> list[Model]:
    if cells is not None and fit.by_cell:
        return fit_cells(
            fit.estimators, cells, lambda tasks: run_parallel(cells.sparkSession, tasks, TREES_AT_ONCE)
        )
    models = dict(fit.estimator.fitMultiple(rows, fit.param_maps))
    return [models[i] for i in range(len(fit.param_maps))]


@contextmanager
def _in_cells(
    fits: Sequence[_Fit], rows: DataFrame, label: str, features: str
) -> Iterator[tuple[Grid | None, DataFrame | None]]:
    """The cells of ``rows`` that suffice for the trees among ``fits``, kept while the block runs; None if rows are needed."""
    trees = [e for fit in fits if fit.by_cell for e in fit.estimators]
    grid = grid_of(rows, features, label, vector_size(rows, features)) if trees else None
    if grid is None:
        yield None, None
        return
    with stored(cells_of(rows, features, label, grid, bags_of(trees), SEED)) as cells:
        cells.count()
        yield grid, cells


def _sharing_trees(fits: Sequence[_Fit]) -> list[_Fit]:
    """Forests that differ in the number of trees only become one fit: the smaller is the beginning of the larger."""
    groups: dict[tuple, list[_Fit]] = {}
    for number, fit in enumerate(fits):
        key = (number,)
        if fit.by_cell and bags_of(fit.estimators):
            maps = [{p.name: v for p, v in params.items() if p.name != "numTrees"} for params in fit.param_maps]
            key = fit.family.name, repr([sorted(values.items()) for values in maps])
        groups.setdefault(key, []).append(fit)
    return [
        replace(
            own[0],
            param_maps=[params for fit in own for params in fit.param_maps],
            points=[points for fit in own for points in fit.points],
        )
        if len(own) > 1
        else own[0]
        for own in groups.values()
    ]


def _errors_of_fits(
    fits: Sequence[_Fit], rows: DataFrame, held_out: DataFrame, label: str, features: str, parallelism: int
) -> dict[tuple[str, int], float]:
    """RMSE per (family, grid point) on the rows left out of a fold, of models fitted on the others."""
    with _in_cells(fits, rows, label, features) as (grid, cells):
        if cells is not None:
            fits = _sharing_trees(fits)
        # Longest first, so that no long fit is left over for the end.
        fits = sorted(fits, key=lambda fit: -max(map(_cost, fit.param_maps)))
        fitted = list(
            zip(fits, run_parallel(rows.sparkSession, [lambda fit=fit: _fit(fit, rows, cells) for fit in fits], parallelism))
        )
        if cells is None:
            return _fold_errors(fitted, held_out, label, features)
    errors = _fold_errors([(fit, models) for fit, models in fitted if not fit.by_cell], held_out, label, features)
    with stored(cells_of(held_out, features, label, grid)) as cells:
        trees = [(fit, models) for fit, models in fitted if fit.by_cell]
        return errors | _fold_errors(trees, cells, label, features, by_cell=True)


def _fold_errors(
    fitted: list[tuple[_Fit, list[Model]]],
    held_out: DataFrame,
    label: str,
    features: str,
    by_cell: bool = False,
) -> dict[tuple[str, int], float]:
    """RMSE per (family, grid point) on the rows left out of a fold: one pass and one aggregation for all models.

    Of a boosted ensemble the first trees are the answer to a smaller limit, so its trees are scored one by one into an array,
    and every limit adds up the beginning of it. With ``by_cell`` the rows are given as cells.
    """
    errors, whole = {}, []
    scored, columns, keys = held_out, {}, {}
    for fit, models in fitted:
        for model, points in zip(models, fit.points):
            if None in points.values():
                whole.append((model, [(fit.family.name, point) for point in points]))
                continue
            scored, sums = with_stages(scored, model, sorted(set(points.values())), features, f"trees_{len(keys)}")
            for point, stage in points.items():
                columns.setdefault(sums[stage], sums[stage])
                keys.setdefault(sums[stage], []).append((fit.family.name, point))
    scored, predictions = with_predictions(scored, {str(i): m for i, (m, _) in enumerate(whole)})
    keys |= {str(i): own for i, (_, own) in enumerate(whole)}
    columns |= predictions
    if columns and by_cell:
        for model, error in zip(columns, rmse_by_cell(scored, label, list(columns.values()))):
            errors |= dict.fromkeys(keys[model], error)
    elif columns:
        for row in evaluate(scored, label, columns).collect():
            errors |= dict.fromkeys(keys[row["model"]], row["rmse"])
    return errors


def with_stages(
    df: DataFrame, ensemble: Model, stages: Sequence[int], features: str, name: str
) -> tuple[DataFrame, dict[int, str]]:
    """``df`` with the predictions of the first ``stages`` trees of an ensemble, and the columns' names by stage."""
    own, outputs = df.columns, []
    for number, tree in enumerate(ensemble.trees[: max(stages)]):
        outputs.append(f"{name}_{number}")
        df = tree.copy({tree.featuresCol: features, tree.predictionCol: outputs[-1]}).transform(df)
    weighted = [F.lit(float(w)) * F.col(c) for w, c in zip(ensemble.treeWeights, outputs)]
    df = df.select(*own, F.array(*weighted).alias(name))
    sums = {stage: f"{name}_first_{stage}" for stage in stages}
    added = [
        F.aggregate(F.slice(name, 1, stage), F.lit(0.0), lambda total, x: total + x).alias(column)
        for stage, column in sums.items()
    ]
    return df.select(*own, *added), sums


def with_predictions(
    df: DataFrame, models: dict[str, Model]
) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with one prediction column per model, and the columns' names."""
    columns = {}
    for position, (name, model) in enumerate(models.items()):
        columns[name] = f"prediction_{position}"
        df = model.copy({model.predictionCol: columns[name]}).transform(df)
    return df, columns


def _cost(params: dict) -> float:
    """Rough size of a fit: trees grown times their depth."""
    values = {param.name: value for param, value in params.items()}
    if "maxDepth" not in values:
        return 0
    return values["maxDepth"] * values.get("numTrees", 1) * values.get("maxIter", 1)
