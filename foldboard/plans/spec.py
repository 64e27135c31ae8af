"""The specification of one run and its checks against a schema."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql.types import BooleanType, NumericType, StringType, StructType

from foldboard.functions.requests import LENIENT_RULES
from foldboard.operators.split import DEFAULT_RATIO

NUMERICAL = "numerical"
CATEGORICAL = "categorical"


@dataclass(frozen=True)
class RunSpec:
    """Feature columns, label, logical types and the share of training rows."""

    feature_cols: Sequence[str]
    label_col: str
    data_types: Mapping[str, str]
    train_test_split: float = field(default=DEFAULT_RATIO)

    @classmethod
    def from_roles(
        cls, roles: Mapping[str, str], data_types: Mapping[str, str] | None = None, ratio=DEFAULT_RATIO
    ) -> RunSpec:
        """From a role per column (Feature, Label, anything else is ignored).

        Columns without a logical type are numerical.
        """
        types = {c: NUMERICAL for c in roles} | dict(data_types or {})
        label = next((c for c, role in roles.items() if role == "Label"), "")
        return cls([c for c, role in roles.items() if role == "Feature"], label, types, ratio)

    @classmethod
    def from_request(cls, request: Mapping) -> RunSpec:
        """From a JSON request as sent to start a run; absent and null entries get their defaults."""
        ratio = request.get("train_test_split")
        return cls(
            list(request.get("feature_cols") or []),
            request.get("label_col") or "",
            dict(request.get("data_types") or {}),
            DEFAULT_RATIO if ratio is None else ratio,
        )

    @classmethod
    def from_form(cls, feature_cols: str, label_col: str, data_types: str, ratio=DEFAULT_RATIO) -> RunSpec:
        """From form fields: a comma list of features and a JSON object of types."""
        names = [name.strip() for name in feature_cols.split(",")]
        try:
            types = json.loads(data_types)
        except json.JSONDecodeError as error:
            raise ValueError("data_types is not a JSON text") from error
        if not isinstance(types, dict):
            raise ValueError("data_types must be a JSON object of names and types")
        return cls([name for name in names if name], label_col.strip(), types, ratio)

    def violations(self, schema: StructType) -> list[tuple[str, str]]:
        """All ``(rule, column)`` the run breaks; reads names and types only."""
        names = set(schema.names)
        found = []
        if not self.feature_cols:
            found.append(("features_empty", ""))
        if not self.label_col:
            found.append(("label_empty", ""))
        if not self.data_types:
            found.append(("types_empty", ""))
        ratio = DEFAULT_RATIO if self.train_test_split is None else self.train_test_split
        if not 0 < ratio < 1:
            found.append(("split_out_of_range", ""))
        if self.label_col and self.label_col not in names:
            found.append(("label_not_found", self.label_col))
        found += [("feature_not_found", c) for c in self.feature_cols if c not in names]
        found += [("typed_column_not_found", c) for c in self.data_types if c not in names]
        if self.label_col in self.feature_cols:
            found.append(("label_in_features", self.label_col))
        found += [
            ("untyped_feature", c)
            for c in self.feature_cols
            if self.data_types.get(c) not in (NUMERICAL, CATEGORICAL)
        ]
        return found + self._physical_violations(schema)

    def _physical_violations(self, schema: StructType) -> list[tuple[str, str]]:
        types = {f.name: f.dataType for f in schema.fields}
        found = []
        for column in self.feature_cols:
            physical = types.get(column)
            if physical is None:
                continue
            logical = self.data_types.get(column)
            if logical == NUMERICAL and not isinstance(physical, NumericType):
                found.append(("numerical_not_numeric", column))
            if logical == CATEGORICAL and not isinstance(
                physical, (NumericType, StringType, BooleanType)
            ):
                found.append(("categorical_unsupported", column))
        label = types.get(self.label_col)
        if label is not None and not isinstance(label, (NumericType, StringType)):
            found.append(("label_unsupported", self.label_col))
        return found

    def require(self, schema: StructType, strict: bool = True) -> None:
        """Raise a ``ValueError`` that names everything wrong.

        Not strict, a label among the features and untyped features (which are
        then left out) are let through.
        """
        found = [
            v for v in self.violations(schema) if strict or v[0] not in LENIENT_RULES
        ]
        if found:
            raise ValueError(
                "invalid run: " + ", ".join(f"{rule} {column}".strip() for rule, column in found)
            )
