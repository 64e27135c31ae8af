"""Fitted pipelines on disk: saving, loading, scoring, listing."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def model_path(root: str, name: str) -> str:
    """Fresh location for a model; the name is reduced to path-safe characters."""
    slug = re.sub(r"[^a-z0-9]+", "-", name.lower()).strip("-")
    return f"{root.rstrip('/')}/models/{uuid.uuid4()}/{slug}"


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel | str, df: DataFrame) -> DataFrame:
    """Predictions of a fitted pipeline, given as object or by its location."""
    return (load_model(model) if isinstance(model, str) else model).transform(df)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files of a saved model; contents are not read."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(path)
            .select("path", "length", "modificationTime")
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no files at {path}") from error
        raise
    if files.isEmpty():
        raise FileNotFoundError(f"no files at {path}")
    return files
