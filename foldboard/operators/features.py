"""From a run specification to the preprocessing stages of a pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.sql.types import StringType, StructType

from foldboard.operators.indexing import CategoryIndexer

# Column names that other stages and saved models rely on.
RAW_FEATURES = "raw_features"
FEATURES = "features"
INDEXED_SUFFIX = "_indexed"
IMPUTED_SUFFIX = "_imputed"
LABEL_SUFFIX = "_indexed_label_for_regression"


@dataclass(frozen=True)
class FeaturePlan:
    """Which columns take which way into the feature vector."""

    numericals: tuple[str, ...]
    categoricals: tuple[str, ...]
    strings: frozenset[str]
    source_label: str
    label: str

    @property
    def source_columns(self) -> list[str]:
        """Columns to read; everything else is ignored."""
        return list(dict.fromkeys([*self.numericals, *self.categoricals, self.source_label]))

    @property
    def assembler_inputs(self) -> list[str]:
        """Imputed numericals, then categoricals by index or, if not strings, as they are."""
        return [c + IMPUTED_SUFFIX for c in self.numericals] + [
            c + INDEXED_SUFFIX if c in self.strings else c for c in self.categoricals
        ]


def plan_features(
    feature_cols: list[str], label_col: str, data_types: dict[str, str], schema: StructType
) -> FeaturePlan:
    """Route features by logical type.

    Numericals come before categoricals, each in the order of ``data_types``.
    """
    chosen = set(feature_cols)
    typed = [(c, t) for c, t in data_types.items() if c in chosen]
    numericals = tuple(c for c, t in typed if t == "numerical")
    categoricals = tuple(c for c, t in typed if t == "categorical")
    strings = frozenset(c for c in categoricals if _is_string(schema, c))
    label = label_col + LABEL_SUFFIX if _is_string(schema, label_col) else label_col
    return FeaturePlan(numericals, categoricals, strings, label_col, label)


def _is_string(schema: StructType, column: str) -> bool:
    return isinstance(schema[column].dataType, StringType)


def preprocessing(plan: FeaturePlan) -> Pipeline:
    """Index strings, impute means, assemble, standardise (centred, sample deviation)."""
    stages = []
    indexed = [(c, c + INDEXED_SUFFIX) for c in plan.categoricals if c in plan.strings]
    if plan.label != plan.source_label:
        indexed.append((plan.source_label, plan.label))
    if indexed:
        inputs, outputs = zip(*indexed)
        stages.append(CategoryIndexer(inputCols=list(inputs), outputCols=list(outputs)))
    if plan.numericals:
        stages.append(
            Imputer(
                inputCols=list(plan.numericals),
                outputCols=[c + IMPUTED_SUFFIX for c in plan.numericals],
                strategy="mean",
            )
        )
    stages.append(VectorAssembler(inputCols=plan.assembler_inputs, outputCol=RAW_FEATURES))
    stages.append(StandardScaler(inputCol=RAW_FEATURES, outputCol=FEATURES, withMean=True))
    return Pipeline(stages=stages)
