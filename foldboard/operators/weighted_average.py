"""Regressor that adds up standardised features, weighted by their correlation with the label.

With population mean, deviation and correlation of every feature::

    w_i  = sign(r_i) * r_i^2 / (1 + regularization)        0 for a constant feature
    v_ij = corr(x_i * x_j, y) / 2                          interactions, see below

An interaction is tried for features that both have ``|w| > 0.1`` and kept if
its correlation exceeds 0.05 in size. All weights together are divided by the
sum of their absolute values. The prediction is::

    mean(y) + sum w_i * z_i + sum v_ij * z_i * z_j         z = (x - mean) / deviation

Interactions are measured on raw features and applied to standardised ones. The
shrinkage acts on all ``w`` alike, so after the division it matters only next to
interactions. A correlation that is undefined counts as 0; with a constant label
every prediction is therefore the mean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import RegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldboard.functions.moments import LabelMoments, TermMoments, correlation, moments
from foldboard.operators.tiles import CELLS, cell_batch, combined, few_tasks
from foldboard.scratch import written

# Fixed values of the method.
SMALLEST_STD = 1e-8
STRONG_FEATURE = 0.1
KEPT_INTERACTION = 0.05

# Predictions with at most this many terms are written out and compiled; longer
# ones fold over arrays.
WIDEST_UNROLLED = 64
# Pairs are summed up in tiles of so many features by as many.
TILE = 64
# Cells of the matrices that a task sums up at a time: five matrices of 8-byte numbers.
MATRIX_CELLS = 2_000_000
# The most pairs that a model keeps: 16 bytes each on their way to the driver.
MOST_PAIRS = 4_000_000


class _WeightedAverageParams(HasLabelCol, HasFeaturesCol, HasPredictionCol):
    regularization = Param(
        Params._dummy(), "regularization", "shrinkage of the feature weights", TypeConverters.toFloat
    )
    useInteractions = Param(
        Params._dummy(), "useInteractions", "whether pairs are considered", TypeConverters.toBoolean
    )

    def __init__(self):
        super().__init__()
        self._setDefault(
            featuresCol="features",
            labelCol="label",
            predictionCol="prediction",
            regularization=0.01,
            useInteractions=True,
        )

    def getRegularization(self) -> float:
        return self.getOrDefault(self.regularization)

    def getUseInteractions(self) -> bool:
        return self.getOrDefault(self.useInteractions)


class WeightedAverageRegressor(
    Estimator, _WeightedAverageParams, DefaultParamsWritable, DefaultParamsReadable
):
    """Fits in one aggregation over the rows, and one more if interactions are tried."""

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
        regularization=0.01,
        useInteractions=True,
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def setRegularization(self, value: float) -> WeightedAverageRegressor:
        return self._set(regularization=value)

    def setUseInteractions(self, value: bool) -> WeightedAverageRegressor:
        return self._set(useInteractions=value)

    def setFeaturesCol(self, value: str) -> WeightedAverageRegressor:
        return self._set(featuresCol=value)

    def setLabelCol(self, value: str) -> WeightedAverageRegressor:
        return self._set(labelCol=value)

    def setPredictionCol(self, value: str) -> WeightedAverageRegressor:
        return self._set(predictionCol=value)

    def _fit(self, dataset: DataFrame) -> WeightedAverageRegressionModel:
        return _fit_all(dataset, [self])[0]

    def fitMultiple(self, dataset, paramMaps):
        """Fit a whole grid on the same two aggregations."""
        estimators = [self.copy(m) for m in paramMaps]
        columns = {(e.getFeaturesCol(), e.getLabelCol()) for e in estimators}
        if len(columns) > 1:
            return super().fitMultiple(dataset, paramMaps)
        return iter(list(enumerate(_fit_all(dataset, estimators))))


class WeightedAverageRegressionModel(
    RegressionModel, _WeightedAverageParams, DefaultParamsWritable, DefaultParamsReadable
):
    """Fitted weights. All state lies in params, so that the model can be saved."""

    weights = Param(Params._dummy(), "weights", "feature weights", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "feature means", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "feature deviations", TypeConverters.toListFloat)
    pairs = Param(
        Params._dummy(), "pairs", "positions of both ends of every pair", TypeConverters.toListInt
    )
    pairWeights = Param(Params._dummy(), "pairWeights", "pair weights", TypeConverters.toListFloat)
    bias = Param(Params._dummy(), "bias", "mean label", TypeConverters.toFloat)

    def __init__(self, **state):
        super().__init__()
        self._set(**state)

    @property
    def numFeatures(self) -> int:
        return len(self.getOrDefault(self.weights))

    def interactions(self) -> list[tuple[int, int, float]]:
        """Kept pairs with their weights."""
        ends = self.getOrDefault(self.pairs)
        return list(zip(ends[::2], ends[1::2], self.getOrDefault(self.pairWeights)))

    def featureImportances(self) -> DenseVector:
        """Absolute weights, half a pair's weight to either end, scaled to sum 1."""
        importances = np.abs(self.getOrDefault(self.weights))
        for i, j, weight in self.interactions():
            importances[[i, j]] += abs(weight) / 2
        total = importances.sum()
        return Vectors.dense(importances / total if total > 0 else importances)

    def predict(self, value: Vector) -> float:
        """Prediction for a single vector, without Spark."""
        z = (value.toArray() - self.getOrDefault(self.means)) / self.getOrDefault(self.stds)
        total = self.getOrDefault(self.bias) + z @ np.asarray(self.getOrDefault(self.weights))
        return float(total + sum(v * z[i] * z[j] for i, j, v in self.interactions()))

    def setFeaturesCol(self, value: str) -> WeightedAverageRegressionModel:
        return self._set(featuresCol=value)

    def setPredictionCol(self, value: str) -> WeightedAverageRegressionModel:
        return self._set(predictionCol=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # The array gets a column of its own: used in many places, computed once.
        array = f"{self.uid}_array"
        return (
            dataset.withColumn(array, vector_to_array(F.col(self.getFeaturesCol())))
            .withColumn(self.getPredictionCol(), self._prediction(F.col(array)))
            .drop(array)
        )

    def _prediction(self, x: Column) -> Column:
        weights, pairs = self.getOrDefault(self.weights), self.interactions()
        means, stds = self.getOrDefault(self.means), self.getOrDefault(self.stds)
        bias = F.lit(self.getOrDefault(self.bias))
        if len(weights) + len(pairs) <= WIDEST_UNROLLED:
            z = [(x[i] - F.lit(m)) / F.lit(s) for i, (m, s) in enumerate(zip(means, stds))]
            total = F.lit(0.0)
            for zi, weight in zip(z, weights):
                total = total + F.lit(weight) * zi
            for i, j, weight in pairs:
                total = total + F.lit(weight) * z[i] * z[j]
            return total + bias

        def constant(values, kind="double"):
            return F.lit(values).cast(f"array<{kind}>")

        def summed(terms: Column) -> Column:
            return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)

        standardised = F.zip_with(
            F.zip_with(x, constant(means), lambda a, m: a - m), constant(stds), lambda a, s: a / s
        )

        def with_z(z: Column) -> Column:
            total = summed(F.zip_with(z, constant(weights), lambda a, w: a * w))
            if pairs:
                firsts, seconds, values = zip(*pairs)
                ends = F.zip_with(
                    constant(list(firsts), "int"), constant(list(seconds), "int"), lambda i, j: z[i] * z[j]
                )
                total = total + summed(F.zip_with(ends, constant(list(values)), lambda p, w: p * w))
            return total + bias

        # A one-element transform names the standardised vector, so that the pairs
        # do not compute it again for each end.
        return F.element_at(F.transform(F.array(standardised), with_z), 1)


def _fit_all(
    dataset: DataFrame, estimators: list[WeightedAverageRegressor]
) -> list[WeightedAverageRegressionModel]:
    """Stores an input that is not stored yet: interactions are measured in a second pass."""
    level = dataset.storageLevel
    twice = any(e.getUseInteractions() for e in estimators)
    if not twice or level.useMemory or level.useDisk:
        return _fit_stored(dataset, estimators)
    columns = estimators[0].getFeaturesCol(), estimators[0].getLabelCol()
    rows = dataset.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_stored(rows, estimators)
    finally:
        rows.unpersist()


def _fit_stored(
    dataset: DataFrame, estimators: list[WeightedAverageRegressor]
) -> list[WeightedAverageRegressionModel]:
    features, label = estimators[0].getFeaturesCol(), estimators[0].getLabelCol()
    width = vector_size(dataset, features)
    rows = dataset.select(
        vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y")
    )
    about_label, terms = moments(rows, F.col("x"), width, F.col("y"))
    if about_label.count == 0:
        raise ValueError("there are no rows to fit on")
    if about_label.missing:
        raise ValueError(f"Labels MUST NOT be Null or NaN: {about_label.missing} of {about_label.count}")

    weights = [_shrunk(terms, about_label, e.getRegularization()) for e in estimators]
    tried = [_strong(w) if e.getUseInteractions() else [] for e, w in zip(estimators, weights)]
    # Smaller shrinkage tries more features, all of those that larger ones try, so one pass covers all grid points.
    pairs = _pair_correlations(rows, max(tried, key=len), terms, about_label)

    models = []
    for estimator, own, strong in zip(estimators, weights, tried):
        kept = {pair: r / 2 for pair, r in pairs.among(strong)}
        total = sum(map(abs, own)) + sum(map(abs, kept.values()))
        scale = total if total > SMALLEST_STD else 1.0
        models.append(
            WeightedAverageRegressionModel(
                featuresCol=features,
                labelCol=label,
                predictionCol=estimator.getPredictionCol(),
                regularization=estimator.getRegularization(),
                useInteractions=estimator.getUseInteractions(),
                weights=[w / scale for w in own],
                means=[t.mean for t in terms],
                stds=[max(t.std, SMALLEST_STD) for t in terms],
                pairs=[end for pair in kept for end in pair],
                pairWeights=[v / scale for v in kept.values()],
                bias=about_label.mean,
            )
        )
    return models


def vector_size(df: DataFrame, column: str) -> int:
    """Size of a vector column: from its metadata, else from the first row; 0 if there is none."""
    attributes = df.schema[column].metadata.get("ml_attr", {})
    if "num_attrs" in attributes:
        return attributes["num_attrs"]
    row = df.select(column).first()
    return 0 if row is None else row[0].size


def _shrunk(terms: list[TermMoments], label: LabelMoments, regularization: float) -> list[float]:
    weights = []
    for term in terms:
        r = correlation(term, label) if term.std > SMALLEST_STD else 0.0
        weights.append(r * abs(r) / (1.0 + regularization))
    return weights


def _strong(weights: list[float]) -> list[int]:
    """Features whose pairs are tried."""
    return [i for i, w in enumerate(weights) if abs(w) > STRONG_FEATURE]


@dataclass(frozen=True)
class _Pairs:
    """Pairs by both ends, in rising order, and the correlation of each product with the label."""

    first: np.ndarray
    second: np.ndarray
    r: np.ndarray

    def among(self, features: list[int]) -> Iterator[tuple[tuple[int, int], float]]:
        """Pairs of these ``features`` that are worth keeping."""
        chosen = np.isin(self.first, features) & np.isin(self.second, features)
        chosen &= np.abs(self.r) > KEPT_INTERACTION
        for i, j, r in zip(self.first[chosen], self.second[chosen], self.r[chosen]):
            yield (int(i), int(j)), float(r)


def _pair_correlations(
    rows: DataFrame, strong: list[int], terms: list[TermMoments], label: LabelMoments
) -> _Pairs:
    """Correlation with the label of the product of any two ``strong`` features; of many pairs only those worth keeping."""
    n = len(strong) * (len(strong) - 1) // 2
    if n > WIDEST_UNROLLED:
        return _correlations_by_tiles(rows, terms, label, strong)
    if not n:
        return _Pairs(*np.zeros((3, 0)))
    pairs = list(combinations(strong, 2))
    x = F.col("x")
    products = F.array(*[x[i] * x[j] for i, j in pairs])
    about_label, products_terms = moments(rows, products, len(pairs), F.col("y"))
    r = [correlation(t, about_label) if t.std > SMALLEST_STD else 0.0 for t in products_terms]
    first, second = np.array(pairs).T
    return _Pairs(first, second, np.array(r))


def _correlations_by_tiles(
    rows: DataFrame, terms: list[TermMoments], label: LabelMoments, strong: list[int]
) -> _Pairs:
    """Correlations above KEPT_INTERACTION among all pairs of ``strong`` features.

    With centred features c and label d, every batch of rows adds its C'C, (C*C)'(C*C), C'diag(d)C, (C*C)'C and
    C'(C*C) to the sums of its task, in tiles of TILE by TILE pairs. Executors add the tiles up in a tree, turn them into
    moments of the raw products and pass on what is kept, as one packed row per tile.
    """
    places = np.array(strong)
    blocks = [slice(b, min(b + TILE, len(strong))) for b in range(0, len(strong), TILE)]
    tiles = [(i, j) for i in range(len(blocks)) for j in range(i, len(blocks))]
    means = np.array([terms[i].mean for i in strong])
    stds = np.array([terms[i].std for i in strong])
    covariances = np.array([terms[i].covariance for i in strong])
    label_mean, label_std, count = label.mean, label.std, float(label.count)

    def sums_of(numbers: range) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            width = lambda block: blocks[block].stop - blocks[block].start
            sums = {t: np.zeros((5, width(tiles[t][0]), width(tiles[t][1]))) for t in numbers}
            for batch in batches:
                if not batch.num_rows:
                    continue
                c = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                c = c.reshape(batch.num_rows, -1)[:, places] - means
                d = batch.column(1).to_numpy(zero_copy_only=False) - label_mean
                square, scaled = c * c, c * d[:, None]
                for number, total in sums.items():
                    i, j = (blocks[block] for block in tiles[number])
                    total[0] += c[:, i].T @ c[:, j]
                    total[1] += square[:, i].T @ square[:, j]
                    total[2] += scaled[:, i].T @ c[:, j]
                    total[3] += square[:, i].T @ c[:, j]
                    total[4] += c[:, i].T @ square[:, j]
            part = TaskContext.get().partitionId()
            for number, total in sums.items():
                yield cell_batch(number, part, total)

        return add

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, cell in zip(batch.column("tile").to_pylist(), batch.column("sums")):
                i, j = (blocks[block] for block in tiles[number])
                shape = 5, i.stop - i.start, j.stop - j.start
                q, qq, qd, qi, qj = np.frombuffer(cell.as_py(), "float64").reshape(shape) / count
                mi, mj, si, sj = means[i, None], means[None, j], stds[i, None], stds[None, j]
                # x_i x_j = c_i c_j + m_i c_j + m_j c_i + m_i m_j.
                covariance = qd + mi * covariances[None, j] + mj * covariances[i, None]
                variance = qq - q * q + (mi * sj) ** 2 + (mj * si) ** 2 + 2 * (mi * qj + mj * qi + mi * mj * q)
                deviation = np.sqrt(np.maximum(variance, 0))
                usable = (deviation > SMALLEST_STD) & (label_std > 0)
                r = np.divide(covariance, deviation * label_std, out=np.zeros_like(q), where=usable)
                rising = np.arange(i.start, i.stop)[:, None] < np.arange(j.start, j.stop)[None, :]
                a, b = np.nonzero(rising & (np.abs(r) > KEPT_INTERACTION))
                found = places[a + i.start], places[b + j.start], r[a, b]
                packed = [v.astype(kind).tobytes() for v, kind in zip(found, ("int32", "int32", "float64"))]
                columns = [pa.array([len(a)], pa.int64()), *[pa.array([p], pa.binary()) for p in packed]]
                yield pa.RecordBatch.from_arrays(columns, names=["n", "i", "j", "r"])

    few, tasks = few_tasks(rows.select("x", "y"))
    # What a task adds up at a time is bounded; further tiles take another pass over the stored rows.
    per_pass = max(1, MATRIX_CELLS // TILE**2)
    cells = [
        few.mapInArrow(sums_of(range(begin, min(begin + per_pass, len(tiles)))), CELLS)
        for begin in range(0, len(tiles), per_pass)
    ]
    # Union numbers the tasks of all passes on, of each tile there are still as many cells as tasks of one pass.
    cells = reduce(DataFrame.unionByName, cells).withColumn("part", F.pmod("part", F.lit(tasks)))
    found = written(combined(cells, tasks).mapInArrow(kept, "n long, i binary, j binary, r binary"), "pairs")
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total > MOST_PAIRS:
        raise ValueError(
            f"{total} interactions are to be kept, a model holds {MOST_PAIRS}: fit without interactions or on fewer features"
        )
    parts = [[np.frombuffer(r[n], k) for n, k in zip("ijr", ("int32", "int32", "float64"))] for r in found.collect()]
    first, second, r = (np.concatenate([p[k] for p in parts]) for k in range(3))
    order = np.lexsort((second, first))
    return _Pairs(first[order], second[order], r[order])
