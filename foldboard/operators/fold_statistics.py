"""Preprocessing of every fold from statistics that are counted once.

The stages of :func:`foldboard.operators.features.preprocessing` need counts of labels, means and deviations. All of these add up:
they are gathered per fold, in one pass over the numbers and one over the strings, and what a model needs that is fitted
without a fold are the statistics of the others, merged. Deviations of imputed columns and of indices follow from the same numbers,
so no stage reads the rows again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import Imputer, ImputerModel, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, NumericType, StructType

from foldboard.functions.moments import WIDEST_UNROLLED
from foldboard.operators.indexing import CategoryIndexer, count_labels


@dataclass(frozen=True)
class Spread:
    """Number, mean and sum of squared deviations of some values."""

    n: int = 0
    mean: float = 0.0
    squares: float = 0.0

    def merged(self, other: Spread) -> Spread:
        if not self.n or not other.n:
            return self if self.n else other
        n = self.n + other.n
        step = other.mean - self.mean
        return Spread(
            n,
            self.mean + step * other.n / n,
            self.squares + other.squares + step * step * self.n * other.n / n,
        )

    @property
    def deviation(self) -> float:
        """Of a sample; 0 for a single value."""
        return math.sqrt(self.squares / (self.n - 1)) if self.n > 1 else 0.0


@dataclass(frozen=True)
class NumberStatistics:
    """Per fold, its rows and the spread of the values that are there in each column."""

    rows: dict[int, int]
    spreads: dict[int, list[Spread]]

    def without(self, fold: int | None) -> tuple[int, list[Spread]]:
        """Rows and spreads of all folds but one."""
        others = [f for f in self.rows if f != fold]
        width = len(next(iter(self.spreads.values()), []))
        merged = [
            reduce(Spread.merged, [self.spreads[f][place] for f in others], Spread())
            for place in range(width)
        ]
        return sum(self.rows[f] for f in others), merged


def number_statistics(df: DataFrame, fold: str, columns: Sequence[str]) -> NumberStatistics:
    """One aggregation by fold; NULL and NaN count as not there."""
    numbers = [F.col(c).cast("double") for c in columns]
    there = [F.when(~F.isnan(x), x) for x in numbers]

    def spread(x):
        return F.struct(F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("variance"))

    if len(columns) <= WIDEST_UNROLLED:
        found = df.groupBy(F.col(fold).alias("fold")).agg(
            F.count("*").alias("rows"),
            *([F.array(*map(spread, there)).alias("spreads")] if columns else []),
        )
        found = [(r["fold"], r["rows"], r["spreads"] if columns else []) for r in found.collect()]
    else:
        # Wide rows become (position, value) rows, so that the plan does not grow with them.
        cells = df.select(F.col(fold).alias("fold"), F.posexplode(F.array(*there)).alias("position", "x"))
        by_cell = cells.groupBy("fold", "position").agg(F.count("*").alias("rows"), spread(F.col("x")).alias("s"))
        by_fold: dict[int, list] = {}
        for r in by_cell.orderBy("fold", "position").collect():
            by_fold.setdefault(r["fold"], []).append(r)
        found = [(f, own[0]["rows"], [r["s"] for r in own]) for f, own in by_fold.items()]
    return NumberStatistics(
        {f: rows for f, rows, _ in found},
        {
            f: [Spread(s["n"], s["mean"], s["variance"] * s["n"]) if s["n"] else Spread() for s in own]
            for f, _, own in found
        },
    )


@dataclass(frozen=True)
class Stages:
    """Stages whose statistics add up."""

    indexer: CategoryIndexer | None
    imputer: Imputer | None
    assembler: VectorAssembler
    scaler: StandardScaler

    @property
    def indexed(self) -> dict[str, int]:
        """Position of each indexed column by the name of its index."""
        outputs = self.indexer.getOutputCols() if self.indexer else []
        return {name: place for place, name in enumerate(outputs)}

    @property
    def imputed(self) -> dict[str, str]:
        return dict(zip(self.imputer.getOutputCols(), self.imputer.getInputCols())) if self.imputer else {}

    @property
    def numbers(self) -> list[str]:
        """Columns that are read as numbers."""
        direct = [c for c in self.assembler.getInputCols() if c not in self.indexed and c not in self.imputed]
        return list(dict.fromkeys([*self.imputed.values(), *direct]))


def _recognised(prep: Pipeline, schema: StructType) -> Stages | None:
    """The stages, if the statistics here are all that they learn."""
    *first, assembler, scaler = [None, None, *prep.getStages()]
    first = [stage for stage in first if stage is not None]
    indexer = next((s for s in first if isinstance(s, CategoryIndexer)), None)
    imputer = next((s for s in first if isinstance(s, Imputer)), None)
    if len(first) != (indexer is not None) + (imputer is not None):
        return None
    if not isinstance(assembler, VectorAssembler) or not isinstance(scaler, StandardScaler):
        return None
    if imputer and (imputer.getStrategy() != "mean" or not math.isnan(imputer.getMissingValue())):
        return None
    stages = Stages(indexer, imputer, assembler, scaler)
    vectors = any(schema[c].dataType.typeName() in ("vector", "vectorudt") for c in stages.numbers if c in schema.names)
    known = all(c in schema.names for c in stages.numbers)
    return stages if known and not vectors and scaler.getInputCol() == assembler.getOutputCol() else None


@dataclass(frozen=True)
class FoldPreps:
    """Models without each fold in turn, and last of all rows; if their stages are known, these and the means of numeric columns."""

    models: list[PipelineModel]
    stages: Stages | None
    centres: dict[str, float]


def fit_per_fold(
    prep: Pipeline,
    train: DataFrame,
    fold: str,
    num_folds: int,
    together: Callable[[list[Callable]], list] = lambda tasks: [task() for task in tasks],
    label: str | None = None,
) -> FoldPreps:
    """``prep`` fitted without each fold in turn, and last on all rows.

    Two passes over ``train`` for all of them, if the stages are those of :func:`preprocessing`; other pipelines are fitted
    one by one. ``together`` runs the fits, which then read statistics only. The mean of a numeric ``label`` is
    counted along. Raises if a fold has no rows.
    """
    stages = _recognised(prep, train.schema)
    counted = stages.numbers if stages else []
    if label in train.schema.names and isinstance(train.schema[label].dataType, NumericType):
        counted = [*counted, label] if label not in counted else counted
    numbers = number_statistics(train, fold, counted)
    if set(numbers.rows) != set(range(num_folds)):
        raise ValueError(
            f"a cross-validation fold has no rows: only {sorted(numbers.rows)} of {num_folds} do"
        )
    left_out = [*range(num_folds), None]
    if stages is None:
        rests = [train if f is None else train.filter(F.col(fold) != f) for f in left_out]
        return FoldPreps(together([lambda rows=rows: prep.copy().fit(rows) for rows in rests]), None, {})
    centres = {c: s.mean for c, s in zip(counted, numbers.without(None)[1])}
    if stages.indexer is None:
        models = together([lambda f=f: _fitted(train, stages, numbers.without(f), None) for f in left_out])
        return FoldPreps(models, stages, centres)
    counts = count_labels(train, stages.indexer.getInputCols(), fold).persist()
    try:
        # Indices of all sets first: most label sets are small enough to be told apart on the driver at once.
        indexed = stages.indexer.fit_leaving_out(counts, fold, left_out, together)
        models = together(
            [
                lambda f=f, model=model: _fitted(train, stages, numbers.without(f), model)
                for f, model in zip(left_out, indexed)
            ]
        )
        return FoldPreps(models, stages, centres)
    finally:
        counts.unpersist()


def _fitted(
    train: DataFrame,
    stages: Stages,
    numbers: tuple[int, list[Spread]],
    indexed: tuple[Transformer, dict[int, tuple[int, int, float, float]]] | None,
) -> PipelineModel:
    rows, spreads = numbers
    by_column = dict(zip(stages.numbers, spreads))
    models = [indexed[0]] if indexed else []
    filled: dict[str, float] = {}
    if stages.imputer:
        imputer = _imputer(train, stages, by_column)
        filled = surrogates(imputer, train)
        models.append(imputer)
    ends = []
    for name in stages.assembler.getInputCols():
        if name in stages.indexed:
            labels, known, total, squares = indexed[1][stages.indexed[name]]
            own = Spread(known, total / known, squares - total * total / known) if known else Spread()
            ends.append(own.merged(Spread(rows - known, float(labels))))
        elif name in stages.imputed:
            column = stages.imputed[name]
            own = by_column[column]
            ends.append(own.merged(Spread(rows - own.n, filled[column])))
        else:
            ends.append(by_column[name])
    models += [stages.assembler, _scaler(train, stages, ends)]
    return PipelineModel(models)


def _imputer(train: DataFrame, stages: Stages, spreads: dict[str, Spread]) -> ImputerModel:
    """Fitted on one row that holds the means."""
    columns = stages.imputer.getInputCols()
    empty = [c for c in columns if not spreads[c].n]
    if empty:
        raise ValueError(f"there is no mean to impute, all values are missing: {', '.join(empty)}")
    row = tuple(spreads[c].mean for c in columns)
    schema = StructType()
    for c in columns:
        schema = schema.add(c, DoubleType())
    return stages.imputer.fit(train.sparkSession.createDataFrame([row], schema))


def surrogates(model: ImputerModel, train: DataFrame) -> dict[str, float]:
    """What takes the place of a missing value, as the type of its column can hold it."""
    columns, names = model.getInputCols(), model.getOutputCols()
    types = [train.schema[c].dataType for c in columns]
    means = model.surrogateDF.select(*[F.col(f"`{c}`") for c in columns]).first()
    if all(isinstance(t, (DoubleType, IntegralType)) for t in types):
        return {
            c: float(int(mean)) if isinstance(t, IntegralType) else mean
            for c, t, mean in zip(columns, types, means)
        }
    schema = StructType()
    for c, t in zip(columns, types):
        schema = schema.add(c, t)
    nothing = train.sparkSession.createDataFrame([(None,) * len(columns)], schema)
    held = model.transform(nothing).select(*[F.col(f"`{n}`").cast("double") for n in names]).first()
    return dict(zip(columns, held))


def _scaler(train: DataFrame, stages: Stages, spreads: list[Spread]) -> Transformer:
    """Fitted on two vectors that have these means and deviations."""
    reach = [s.deviation / math.sqrt(2) for s in spreads]
    ends = [
        (Vectors.dense([s.mean + sign * r for s, r in zip(spreads, reach)]),) for sign in (-1, 1)
    ]
    return stages.scaler.fit(train.sparkSession.createDataFrame(ends, [stages.scaler.getInputCol()]))
