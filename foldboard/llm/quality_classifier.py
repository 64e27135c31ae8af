"""Quality by votes of the nearest labelled documents in a latent-semantic space.

Terms of a text are its byte pairs (hashed to PAIR_TERMS) and words repeated inside it, so both wording and form
count. Weights are logarithmic term counts times inverse document frequencies of *all* documents. The singular vectors of
a sample of labelled documents span the latent space. Its labelled vectors are broadcast, every document is compared
with each of them in exact blocked cosine products, and its nearest neighbours vote with the weight of their similarity.

Labels are learnt from a sample of at most ``max_labelled`` labelled documents, in the order of a hash of the id. The
broadcast model is max_labelled * dimensions plus TERMS * dimensions numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from foldboard.llm.common import col, id_remainder, table

PAIR_TERMS = 2_048
#: Terms for the share of words inside repeated windows of three, one per fifth.
REPEAT_TERMS = 5
TERMS = PAIR_TERMS + REPEAT_TERMS
#: Rows of a text batch that are compared at once.
BLOCK = 512


def _pair_terms() -> np.ndarray:
    """Hashed term of every byte pair."""
    pair = np.arange(1 << 16, dtype="uint64")
    mixed = pair * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(32)).astype("int64") % PAIR_TERMS


TERM_OF_PAIR = _pair_terms()


def term_counts(text: str | None) -> np.ndarray:
    """Counts of all terms; zeros for a missing or empty text."""
    counts = np.zeros(TERMS)
    raw = (text or "").encode("utf-8", "replace")
    if len(raw) > 1:
        data = np.frombuffer(raw, "uint8").astype("int64")
        pairs = np.bincount(data[:-1] * 256 + data[1:], minlength=1 << 16)
        counts[:PAIR_TERMS] = np.bincount(TERM_OF_PAIR, weights=pairs, minlength=PAIR_TERMS)
    share = repeated_share(raw.split())
    if share:
        # One kind of repetition speaks as loudly as all byte pairs of the text.
        counts[PAIR_TERMS + min(int(share * REPEAT_TERMS), REPEAT_TERMS - 1)] = len(raw)
    return counts


def repeated_share(words: list[bytes]) -> float:
    """Share of the windows of three words that occur more than once."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if not windows or len(set(windows)) == len(windows):
        return 0.0
    return sum(n for n in Counter(windows).values() if n > 1) / len(windows)


@dataclass
class QualityModel:
    rarity: np.ndarray = field(default_factory=lambda: np.ones(TERMS))
    #: From terms to the latent space.
    space: np.ndarray = field(default_factory=lambda: np.zeros((TERMS, 1), "float32"))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), "float32"))
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    neighbours: int = 15
    prior: float = 0.5

    def weighted(self, texts: list[str | None]) -> np.ndarray:
        counts = np.stack([term_counts(t) for t in texts])
        return unit(np.log1p(counts) * self.rarity)

    def project(self, texts: list[str | None]) -> np.ndarray:
        return unit(self.weighted(texts).astype("float32") @ self.space)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest; the prior where nothing is similar."""
        if not len(self.vectors):
            return np.full(len(texts), self.prior)
        near = self.project(texts) @ self.vectors.T
        k = min(self.neighbours, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype("float64")
        weight **= 8
        total = weight.sum(axis=1)
        votes = (weight * self.labels[best]).sum(axis=1)
        score = np.where(total > 1e-12, votes / np.maximum(total, 1e-12), self.prior)
        return np.clip(score, 0.0, 1.0)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and of documents with each term, over all rows.

    The executors add up a vector per batch; TERMS rows reach the driver.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, rows = np.zeros(TERMS + 1, "int64"), 0
        for batch in batches:
            for text in batch["text"]:
                found[:TERMS] += term_counts(text) > 0
            rows += len(batch)
        found[TERMS] = rows
        yield pd.DataFrame({"term": np.arange(TERMS + 1), "n": found})

    counted = docs.select("text").mapInPandas(count, "term long, n long")
    pdf = counted.groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(TERMS + 1, "int64")
    n[pdf["term"]] = pdf["n"]
    return int(n[TERMS]), n[:TERMS]


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int) -> pd.DataFrame:
    """At most ``max_labelled`` texts with labels.

    Of several labels of one id the smallest counts, of several texts the smallest; rows without id, label or text
    are left out.
    """
    drawn = (
        labels.filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    return (
        docs.filter("text IS NOT NULL")
        .join(F.broadcast(drawn), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 4_000,
    dimensions: int = 64,
    neighbours: int = 15,
) -> QualityModel:
    """``docs`` has doc_id and text, ``labels`` doc_id and label (1 good). Without labels every score is 0.5."""
    rows, found = document_frequencies(docs)
    model = QualityModel(neighbours=neighbours)
    model.rarity = np.log((rows + 1) / (found + 1)) + 0.1

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            terms = [np.log1p(term_counts(t)).astype("float32").tobytes() for t in batch["text"]]
            ids = list(batch["doc_id"])
            yield pd.DataFrame({"doc_id": ids, "label": batch["label"], "terms": terms})

    # Vectors of a fixed length, not texts, reach the driver.
    sample = labelled_sample(docs, labels, max_labelled)
    kind = docs.schema["doc_id"].dataType.simpleString()
    pdf = sample.mapInPandas(count, f"doc_id {kind}, label int, terms binary").toPandas()
    if not len(pdf):
        return model
    pdf = pdf.sort_values("doc_id", kind="stable")
    counts = np.stack([np.frombuffer(t, "float32") for t in pdf["terms"]]).astype("float64")
    weights = unit(counts * model.rarity)
    model.space = singular_vectors(weights, dimensions).astype("float32")
    model.vectors = unit(weights.astype("float32") @ model.space)
    model.labels = pdf["label"].to_numpy("float64")
    model.prior = float(model.labels.mean())
    return model


def singular_vectors(weights: np.ndarray, dimensions: int, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration from a fixed start."""
    width = min(dimensions, *weights.shape)
    basis = np.random.default_rng(seed).standard_normal((weights.shape[1], width))
    for _ in range(8):
        basis, _ = np.linalg.qr(weights.T @ (weights @ basis))
    return basis


def scorer(spark: SparkSession, model: QualityModel) -> Callable[[Column], Column]:
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        rows = list(texts)
        parts = [
            shared.value.scores(rows[at : at + BLOCK]) for at in range(0, len(rows), BLOCK)
        ]
        return pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return score


def score_quality(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, score in 0..1, predicted (1 from 0.5 on).

    Missing and empty texts have no terms and get the share of label 1 in the sample. Ties of similarity at the last
    neighbour are settled by the order of the sample. Repeated rows and missing ids stay rows; an empty table gives no
    rows; other columns are ignored.
    """
    score = scorer(docs.sparkSession, model)
    return docs.select(
        col(id_col).alias("doc_id"), score(col(text_col)).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(id_remainder("doc_id", 3) != 1)
    model = fit(
        docs.select("doc_id", "text"), labels.select("doc_id", F.col("quality").alias("label"))
    )
    return score_quality(docs, model).select(
        "doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted"
    )


QUERIES = {"op5_quality_classifier": op5_quality_classifier}
ORACLES: dict[str, str] = {}
