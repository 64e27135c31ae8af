"""Errors of ridge regressions on held-out folds, for all folds and penalties from one pass.

Features of a fold's preprocessing are linear in numbers that do not depend on the fold: the value where it is there, whether
it is missing, and which label it is. The products of these, summed up per fold, give the moments of the prepared features on
any choice of folds. Normal equations are solved from the moments of the other folds, one penalty after the other, and
the squared error on a fold is a quadratic form of its own moments.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.ml.feature import ImputerModel, StandardScalerModel, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldboard.operators.fold_statistics import FoldPreps, surrogates
from foldboard.operators.tiles import CELLS, cell_batch, combined, few_tasks

# A fold's products are a square matrix of this many numbers a side at most.
WIDEST_BASIS = 512


def flat_stages(model: PipelineModel) -> list:
    """All fitted stages, those of nested pipelines too."""
    parts = (flat_stages(s) if isinstance(s, PipelineModel) else [s] for s in model.stages)
    return [stage for part in parts for stage in part]


@dataclass(frozen=True)
class _Term:
    """One input of the assembler, or the label. ``begin`` is its first place in the basis."""

    name: str
    column: str
    kind: str
    centre: float
    labels: tuple[str, ...]
    begin: int

    @property
    def width(self) -> int:
        """Numbers it takes: the value, whether it is missing; or each label, and none of them."""
        return {"imputed": 2, "plain": 1}.get(self.kind, len(self.labels) + 1)


@dataclass(frozen=True)
class Basis:
    """The numbers of a row that do not depend on a fold; place 0 is the constant 1. The label is the last term."""

    terms: list[_Term]
    indexers: dict[str, StringIndexerModel]

    @property
    def width(self) -> int:
        return 1 + sum(t.width for t in self.terms)

    @classmethod
    def of(cls, preps: FoldPreps, label: str) -> Basis | None:
        """None if the stages are others, labels are kept as a table, or there are too many of them."""
        stages = preps.stages
        if stages is None:
            return None
        indexers = {
            s.getOutputCol(): s for s in flat_stages(preps.models[-1]) if isinstance(s, StringIndexerModel)
        }
        terms, begin = [], 1
        for name in [*stages.assembler.getInputCols(), label]:
            column = stages.imputed.get(name, name)
            if name in stages.indexed:
                if name not in indexers:
                    return None
                term = _Term(name, column, "indexed", 0.0, tuple(indexers[name].labels), begin)
            elif column in preps.centres:
                kind = "imputed" if name in stages.imputed else "plain"
                term = _Term(name, column, kind, preps.centres[column], (), begin)
            else:
                return None
            terms.append(term)
            begin += term.width
        return cls(terms, indexers) if begin <= WIDEST_BASIS else None

    def rows(self, train: DataFrame, fold: str) -> DataFrame:
        """(fold, numbers, places): values, NULL where missing, and label numbers of the indexed columns."""
        for name in dict.fromkeys(t.name for t in self.terms if t.kind == "indexed"):
            train = self.indexers[name].transform(train)
        numbers = [F.col(t.column).cast("double") for t in self.terms if t.kind != "indexed"]
        places = [F.col(t.name).cast("double") for t in self.terms if t.kind == "indexed"]
        empty = F.array().cast("array<double>")
        return train.select(
            F.col(fold).cast("long").alias("fold"),
            (F.array(*numbers) if numbers else empty).alias("numbers"),
            (F.array(*places) if places else empty).alias("places"),
        )

    def features(self, prep: PipelineModel, train: DataFrame) -> np.ndarray:
        """The scaled features and the label of a fold's preprocessing, one row of factors per feature."""
        stages = flat_stages(prep)
        indexers = {s.getOutputCol(): s for s in stages if isinstance(s, StringIndexerModel)}
        imputer = next((s for s in stages if isinstance(s, ImputerModel)), None)
        filled = surrogates(imputer, train) if imputer else {}
        scaler = next(s for s in stages if isinstance(s, StandardScalerModel))
        result = np.zeros((len(self.terms), self.width))
        for row, term in zip(result, self.terms):
            if term.kind == "indexed":
                number = {label: k for k, label in enumerate(indexers[term.name].labels)}
                own = [number.get(label, len(number)) for label in term.labels]
                row[term.begin : term.begin + term.width] = [*own, len(number)]
                continue
            row[0], row[term.begin] = term.centre, 1
            if term.kind == "imputed":
                row[term.begin + 1] = filled[term.column] - term.centre
        if scaler.getWithMean():
            result[:-1, 0] -= scaler.mean.toArray()
        if scaler.getWithStd():
            std = scaler.std.toArray()
            result[:-1] *= np.divide(1, std, out=np.zeros_like(std), where=std > 0)[:, None]
        # The intercept takes the label's centre in; errors are the same without it.
        if self.terms[-1].kind != "indexed":
            result[-1, 0] = 0
        return result


def design(terms: list[_Term], numbers: np.ndarray, places: np.ndarray) -> np.ndarray:
    """One row of the basis per row."""
    result = np.zeros((len(numbers), 1 + sum(t.width for t in terms)))
    result[:, 0] = 1
    number = place = 0
    for term in terms:
        if term.kind == "indexed":
            result[np.arange(len(result)), term.begin + places[:, place].astype("int64")] = 1
            place += 1
            continue
        value = numbers[:, number] - term.centre
        number += 1
        if term.kind == "imputed":
            missing = np.isnan(value)
            result[:, term.begin + 1] = missing
            value = np.where(missing, 0, value)
        result[:, term.begin] = value
    return result


def products_by_fold(train: DataFrame, fold: str, basis: Basis) -> dict[int, np.ndarray]:
    """Per fold the sum of b b' over its rows' basis b, in one pass."""

    terms, width = basis.terms, basis.width

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, places = (
                batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                for name in ("numbers", "places")
            )
            rows, folds = design(terms, numbers, places), batch.column("fold").to_numpy()
            for f in np.unique(folds).tolist():
                own = rows[folds == f]
                sums[f] = sums.get(f, 0) + own.T @ own
        for f, total in sums.items():
            yield cell_batch(f, TaskContext.get().partitionId(), total)

    few, tasks = few_tasks(basis.rows(train, fold))
    cells = combined(few.mapInArrow(add, CELLS), tasks).collect()
    return {r["tile"]: np.frombuffer(r["sums"], "float64").reshape(width, -1) for r in cells}


@dataclass(frozen=True)
class _Moments:
    """Sums of features and label (last) over some rows, and of their products."""

    n: float
    sums: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, features: np.ndarray, products: np.ndarray) -> _Moments:
        return cls(products[0, 0], features @ products[:, 0], features @ products @ features.T)

    def ridge(self, penalty: float) -> tuple[np.ndarray, float]:
        """Factors and intercept of the regression on standardised features with a penalty, as Spark defines it."""
        means = self.sums / self.n
        covariance = self.products / self.n - np.outer(means, means)
        std = np.sqrt(np.maximum(np.diag(covariance), 0))
        *own, label = std
        if label == 0:
            return np.zeros(len(own)), float(means[-1])
        scale = np.divide(1, own, out=np.zeros(len(own)), where=np.array(own) > 0)
        correlation = covariance[:-1, :-1] * np.outer(scale, scale)
        correlation[np.diag_indices_from(correlation)] = np.where(scale > 0, 1.0, 0.0) + penalty / label
        solved = np.linalg.solve(correlation, covariance[:-1, -1] * scale / label)
        factors = solved * label * scale
        return factors, float(means[-1] - factors @ means[:-1])

    def rmse(self, factors: np.ndarray, intercept: float) -> float:
        rest = np.append(-factors, 1.0)
        squares = rest @ self.products @ rest - 2 * intercept * (rest @ self.sums) + self.n * intercept**2
        return float(np.sqrt(max(squares, 0.0) / self.n))


def ridge_errors(
    train: DataFrame, fold: str, preps: FoldPreps, label: str, penalties: Sequence[float]
) -> list[list[float]] | None:
    """RMSE per fold and penalty on the rows of the fold, fitted on the others; None if they need fits of their own.

    That is so for other stages, for many labels, and for rows that are refused elsewhere: without label or plain number.
    """
    basis = Basis.of(preps, label)
    if basis is None or not penalties:
        return None
    products = products_by_fold(train, fold, basis)
    if not all(np.isfinite(p).all() for p in products.values()):
        return None
    errors = []
    for number, prep in enumerate(preps.models[:-1]):
        features = basis.features(prep, train)
        rest = sum(p for f, p in products.items() if f != number)
        fitted, held_out = _Moments.of(features, rest), _Moments.of(features, products[number])
        errors.append([held_out.rmse(*fitted.ridge(penalty)) for penalty in penalties])
    return errors
