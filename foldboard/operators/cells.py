"""Tree learners on rows that are summed up by cell.

A tree asks on which side of at most ``maxBins - 1`` thresholds per feature a row lies, and learns from number and labels of the
rows between them. So the rows are summed up once by the cell they fall into, and any number of trees of any depth is grown on
these sums, by Spark's own learners with weights: splits, leaves and gains are those of the rows, because what labels
spread within a cell is in every impurity alike. Features with at most BINS values keep them all; others get BINS values at
quantiles of all rows, every row belongs to the nearest one, and a model's thresholds, which lie half-way between them, tell
real rows apart in the same way.

Bagging stays that of rows: each row draws its own number for each tree, and a tree learns from the sums weighted by these.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressor,
    RandomForestRegressor,
)
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldboard.functions.metrics import has_label
from foldboard.operators.tiles import few_tasks

# Values per feature: the default of maxBins, learners set otherwise read the rows.
BINS = 32
# The most cells; with more values of all features together the learners read the rows.
MAX_CELLS = 65_536
# Smaller tables are learnt from row by row, with the thresholds that Spark finds.
FEWEST_ROWS = 100_000
# Ranks of quantiles are right to one in so many rows.
ACCURACY = 10_000

ROWS, WITHIN = "_rows", "_within"


@dataclass(frozen=True)
class Grid:
    """The values each feature is rounded to, in rising order, and a number amid the labels."""

    values: list[np.ndarray]
    centre: float

    @property
    def size(self) -> int:
        return math.prod(map(len, self.values))

    @property
    def bounds(self) -> list[np.ndarray]:
        """Half-way between neighbours; a row on a bound belongs to the lower side, as in a tree."""
        return [(v[:-1] + v[1:]) / 2.0 for v in self.values]


def grid_of(rows: DataFrame, features: str, label: str, width: int) -> Grid | None:
    """None for small tables, too many cells, and rows that learners refuse: without label or plain number."""
    if not 0 < width <= BINS or rows.count() < FEWEST_ROWS:
        return None
    x = [F.get(F.col("x"), F.lit(i)) for i in range(width)]
    probes = [(2 * i + 1) / (2 * BINS) for i in range(BINS)]
    numbers = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    usable = F.coalesce(has_label(F.col("y")) & (F.abs("y") < F.lit(math.inf)), F.lit(False))
    found = numbers.agg(
        F.count_if(~usable | F.col("x").isNull()).alias("unusable"),
        F.avg("y").alias("centre"),
        F.array(*[F.approx_count_distinct(c) for c in x]).alias("kinds"),
        F.array(*[F.percentile_approx(c, probes, ACCURACY) for c in x]).alias("quantiles"),
    ).first()
    if found["unusable"]:
        return None
    # The number of values is an estimate; few are looked at one by one.
    few = [i for i, kinds in enumerate(found["kinds"]) if kinds <= 2 * BINS]
    seen = numbers.agg(*[F.collect_set(x[i]).alias(str(i)) for i in few]).first() if few else {}
    values = []
    for i, quantiles in enumerate(found["quantiles"]):
        own = seen[str(i)] if i in few and len(seen[str(i)]) <= BINS else quantiles
        values.append(np.unique(np.array(own, "float64")))
    grid = Grid(values, found["centre"])
    return grid if grid.size <= MAX_CELLS and all(np.isfinite(v).all() for v in values) else None


def cells_of(
    rows: DataFrame, features: str, label: str, grid: Grid, bags: int = 0, seed: int = 0
) -> DataFrame:
    """(features, label, _rows, _within) per cell that has rows: its values, its rows' mean label, their number and the sum
    of the squared deviations of their labels; ``_rows_t`` and ``_label_t`` are those of bag t, the label 0 where it is empty.
    One pass; the result is in one partition."""
    bounds, size, centre = grid.bounds, grid.size, grid.centre
    names = ["n", "s", "q", *[f"{kind}_{t}" for t in range(bags) for kind in "ns"]]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed % (1 << 63), TaskContext.get().partitionId()])
        sums = np.zeros((len(names), size))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch.column("y").to_numpy(zero_copy_only=False) - centre
            cell = np.zeros(len(y), "int64")
            for column, bound in zip(x.T, bounds):
                cell = cell * (len(bound) + 1) + np.searchsorted(bound, column)
            for place, weights in enumerate((None, y, y * y)):
                sums[place] += np.bincount(cell, weights, size)
            for t in range(bags):
                drawn = rng.poisson(1.0, len(y))
                sums[3 + 2 * t] += np.bincount(cell, drawn, size)
                sums[4 + 2 * t] += np.bincount(cell, drawn * y, size)
        found = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()), *[pa.array(s[found], pa.float64()) for s in sums]], names=["cell", *names]
        )

    numbers = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    few, _ = few_tasks(numbers.filter(has_label(F.col("y"))))
    parts = few.mapInArrow(add, ", ".join(["cell long", *[f"{name} double" for name in names]]))
    summed = parts.groupBy("cell").agg(*[F.sum(name).alias(name) for name in names])
    vector, stride = [], size
    for values in grid.values:
        stride //= len(values)
        place = F.pmod(F.floor(F.col("cell") / F.lit(stride)), F.lit(len(values))).cast("int")
        vector.append(F.get(F.lit(values.tolist()).cast("array<double>"), place))
    n, s = F.col("n"), F.col("s")
    bagged = [
        column
        for t in range(bags)
        for column in (
            F.col(f"n_{t}").alias(f"{ROWS}_{t}"),
            F.coalesce(F.try_divide(f"s_{t}", f"n_{t}") + F.lit(centre), F.lit(0.0)).alias(f"_label_{t}"),
        )
    ]
    # Cells in a fixed order, whatever task they come from.
    return summed.coalesce(1).sortWithinPartitions("cell").select(
        array_to_vector(F.array(*vector)).alias(features),
        (F.lit(centre) + s / n).alias(label),
        n.alias(ROWS),
        F.greatest(F.col("q") - s * s / n, F.lit(0.0)).alias(WITHIN),
        *bagged,
    )


def rmse_by_cell(cells: DataFrame, label: str, predictions: Sequence[str]) -> list[float]:
    """Root of the mean squared error over the rows in the cells, per column of predictions."""
    squares = [F.col(ROWS) * F.pow(F.col(label) - F.col(p), F.lit(2.0)) + F.col(WITHIN) for p in predictions]
    return list(cells.agg(*[F.sqrt(F.sum(s) / F.sum(ROWS)) for s in squares]).first())


def learns_from_cells(estimator: Estimator) -> bool:
    """Whether sums by cell are all that an estimator, as it is set, learns from."""
    kinds = (DecisionTreeRegressor, RandomForestRegressor, GBTRegressor)
    if type(estimator) not in kinds or estimator.isSet(estimator.weightCol) or estimator.getLeafCol():
        return False
    if estimator.getMaxBins() != BINS or estimator.getMinInstancesPerNode() != 1:
        return False
    if estimator.getMinWeightFractionPerNode() != 0:
        return False
    if isinstance(estimator, GBTRegressor):
        validated = estimator.isSet(estimator.validationIndicatorCol)
        return estimator.getLossType() == "squared" and estimator.getSubsamplingRate() == 1 and not validated
    return isinstance(estimator, DecisionTreeRegressor) or estimator.getSubsamplingRate() == 1


def is_bagged(estimator: Estimator) -> bool:
    return isinstance(estimator, RandomForestRegressor) and estimator.getBootstrap()


def bags_of(estimators: Sequence[Estimator]) -> int:
    """Bags that the forests among ``estimators`` need."""
    return max([e.getNumTrees() for e in estimators if is_bagged(e)], default=0)


def fit_cells(
    estimators: Sequence[Estimator],
    cells: DataFrame,
    together: Callable[[list[Callable]], list] = lambda tasks: [task() for task in tasks],
) -> list[Model]:
    """A model per estimator. Bagged forests that differ in the number of trees only share the trees they have in common.

    ``together`` grows the trees of a forest.
    """
    models, grown = [], {}
    most = sorted(range(len(estimators)), key=lambda i: -bags_of([estimators[i]]))
    for place in most:
        estimator = estimators[place]
        if is_bagged(estimator):
            values = {p.name: v for p, v in estimator.extractParamMap().items() if p.name != "numTrees"}
            key = repr(sorted(values.items())), _subset(estimator)
            if key not in grown:
                grown[key] = together(
                    [lambda t=t: _bagged_tree(estimator, cells, t) for t in range(estimator.getNumTrees())]
                )
            trees = grown[key][: estimator.getNumTrees()]
            own = {"featuresCol": estimator.getFeaturesCol(), "predictionCol": estimator.getPredictionCol()}
            model = MeanOfTreesModel(trees=trees, **own)
        else:
            model = estimator.copy({estimator.weightCol: ROWS}).fit(cells)
        models.append((place, model))
    return [model for _, model in sorted(models, key=lambda item: item[0])]


def fit_tree(estimator: Estimator, rows: DataFrame, features: str, label: str, width: int) -> Model:
    """One learner on all ``rows``: by cell if that is possible, else row by row."""
    estimator = estimator.copy({estimator.featuresCol: features, estimator.labelCol: label})
    grid = grid_of(rows, features, label, width) if learns_from_cells(estimator) else None
    if grid is None:
        return estimator.fit(rows)
    cells = cells_of(rows, features, label, grid, bags_of([estimator]), estimator.getSeed()).persist()
    try:
        return fit_cells([estimator], cells)[0]
    finally:
        cells.unpersist()


def _subset(forest: RandomForestRegressor) -> str:
    """Which features a node may choose from: ``auto`` is settled by the number of trees."""
    chosen = forest.getFeatureSubsetStrategy()
    return ("all" if forest.getNumTrees() == 1 else "onethird") if chosen == "auto" else chosen


def _bagged_tree(forest: RandomForestRegressor, cells: DataFrame, bag: int) -> DecisionTreeRegressionModel:
    single = forest.copy(
        {
            forest.numTrees: 1,
            forest.bootstrap: False,
            forest.featureSubsetStrategy: _subset(forest),
            forest.weightCol: f"{ROWS}_{bag}",
            forest.labelCol: f"_label_{bag}",
            forest.seed: forest.getSeed() + bag,
        }
    )
    return single.fit(cells.filter(F.col(f"{ROWS}_{bag}") > 0)).trees[0]


class MeanOfTreesModel(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """A forest: the mean of its trees' predictions."""

    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)

    def __init__(self, *, trees=None, **state):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction")
        # Fitted trees; saved next to the params.
        self.trees: list[DecisionTreeRegressionModel] = trees or []
        self._set(numTrees=len(self.trees), **state)

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def numFeatures(self) -> int:
        return self.trees[0].numFeatures

    @property
    def featureImportances(self) -> DenseVector:
        """Mean of the trees' importances, scaled to sum 1."""
        total = sum(tree.featureImportances.toArray() for tree in self.trees)
        return Vectors.dense(total / total.sum() if total.sum() > 0 else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        own, name = dataset.columns, self.getPredictionCol()
        outputs = [f"{self.uid}_{k}" for k in range(len(self.trees))]
        for tree, output in zip(self.trees, outputs):
            dataset = tree.copy({tree.featuresCol: self.getFeaturesCol(), tree.predictionCol: output}).transform(dataset)
        total = F.lit(0.0)
        for output in outputs:
            total = total + F.col(output)
        return dataset.select(*[F.col(f"`{c}`") for c in own], (total / F.lit(float(len(outputs)))).alias(name))

    def write(self) -> MLWriter:
        return _MeanOfTreesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _MeanOfTreesReader(cls)


class _MeanOfTreesWriter(MLWriter):
    def __init__(self, instance: MeanOfTreesModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for k, tree in enumerate(self.instance.trees):
            tree.save(f"{path}/trees/{k}")


class _MeanOfTreesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> MeanOfTreesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        trees = [
            DecisionTreeRegressionModel.load(f"{path}/trees/{k}") for k in range(metadata["paramMap"]["numTrees"])
        ]
        model = self.cls(trees=trees)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
