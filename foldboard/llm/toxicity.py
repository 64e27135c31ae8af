"""Toxicity by two Kneser-Ney bigram models that share their backoff.

One interpolated Kneser-Ney model is estimated per class. Both back off from class bigrams to class continuation counts
and from there to continuation counts of both classes together. An expression that is too rare to tell the classes
apart, or as common in both, is left to the shared counts, where the factors it has in both models cancel. "Tells apart"
means: its documents per class differ from the expected number by ``certainty`` standard deviations and by a factor
``contrast``. Without that, sampling noise of thousands of ordinary words drowns a few rude ones. The evidence of a text
is the difference of the two log-likelihoods per token; a logistic curve, fitted on labelled texts that the models have
not counted, turns it into a score.

Labels are learnt from a sample of at most ``docs_per_class`` labelled documents per class, in the order of a hash
of the id. The broadcast model holds at most ``max_words`` words of at most MAX_WORD_CHARS characters and ``max_bigrams``
bigrams per class. Bigrams are counted, discounted and ranked on the executors.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from foldboard.llm.common import UPPER, col, id_remainder, table
from foldboard.scratch import written

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(UPPER, UPPER.lower())
MAX_WORD_CHARS = 64
RARE, START, FIRST_WORD = 0, 1, 2
#: Rows counted at a time.
PART_ROWS = 1_000
#: One in so many sampled documents is kept for the logistic curve.
CALIBRATION = 4


def terms(text: str | None) -> list[str]:
    """Runs of letters and digits, A-Z in lower case; none for a missing text."""
    return TERM.findall((text or "").translate(LOWER))


@dataclass
class ToxicityModel:
    """Arrays have a row per class: 0 ordinary, 1 toxic."""

    words: dict[str, int] = field(default_factory=dict)
    #: Probability of a word after the class bigram fails, and weight of that failure by previous word.
    lower: np.ndarray = field(default_factory=lambda: np.ones((2, FIRST_WORD)))
    backoff: np.ndarray = field(default_factory=lambda: np.ones((2, FIRST_WORD)))
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, "int64"))
    upper: np.ndarray = field(default_factory=lambda: np.zeros((2, 0)))
    slope: float = 0.0
    intercept: float = 0.0

    def ids(self, text: str | None) -> np.ndarray:
        found = terms(text)
        ids = np.full(len(found) + 1, START, "int64")
        get = self.words.get
        ids[1:] = [get(w, RARE) for w in found]
        return ids

    def evidence(self, text: str | None) -> float:
        """Log-likelihood ratio per token; 0 for a text without words."""
        ids = self.ids(text)
        if len(ids) < 2:
            return 0.0
        before, word = ids[:-1], ids[1:]
        p = self.lower[:, word]
        if len(self.keys):
            wanted = before * self.lower.shape[1] + word
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            p = np.where(
                self.keys[at] == wanted, self.upper[:, at] + self.backoff[:, before] * p, p
            )
        ratio = np.log(p)
        return float(np.mean(ratio[1] - ratio[0]))

    def score(self, text: str | None) -> float:
        z = self.slope * self.evidence(text) + self.intercept
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def on_executors(
    spark: SparkSession, model: ToxicityModel, method: Callable[[ToxicityModel, str | None], float]
) -> Callable[[Column], Column]:
    """``method`` of the broadcast model as a function of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf(DoubleType())
    def apply(texts: pd.Series) -> pd.Series:
        return pd.Series([method(shared.value, t) for t in texts], dtype="float64")

    return apply


def sampled(docs: DataFrame, labels: DataFrame, docs_per_class: int) -> tuple[DataFrame, list[int]]:
    """Sampled (class, part, text) and the number of labelled ids per class.

    Of several labels of one id the largest counts, of several texts the smallest; rows without id, label or text
    are left out.
    """
    known = (
        labels.filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("class"))
    )
    sizes = {r["class"]: r["count"] for r in known.groupBy("class").count().collect()}
    drawn = [
        known.filter(F.col("class") == c)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(docs_per_class)
        for c in (0, 1)
    ]
    # At most 2 * docs_per_class ids.
    chosen = F.broadcast(drawn[0].union(drawn[1]))
    rows = (
        docs.filter("text IS NOT NULL")
        .join(chosen, "doc_id")
        .groupBy("doc_id", "class")
        .agg(F.min("text").alias("text"))
        .groupBy("class", "text")
        .agg((F.pmod(F.xxhash64("text"), F.lit(CALIBRATION)) == 0).alias("held_back"))
    )
    return written(rows, "labelled"), [sizes.get(c, 0) for c in (0, 1)]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    docs_per_class: int = 4_000,
    max_words: int = 50_000,
    max_bigrams: int = 100_000,
    min_docs: int = 3,
    certainty: float = 4.0,
    contrast: float = 3.0,
) -> ToxicityModel:
    """``docs`` has doc_id and text, ``labels`` doc_id and label (1 toxic).

    Without examples of both classes there is nothing to compare: every text then scores the share of label 1 (0 without
    labels).
    """
    spark = docs.sparkSession
    rows, sizes = sampled(docs, labels, docs_per_class)
    model = ToxicityModel()
    if not all(sizes):
        model.intercept = 500.0 if sizes[1] else -500.0
        return model
    counted = rows.filter(~F.col("held_back"))
    seen = {r["class"]: r["count"] for r in counted.groupBy("class").count().collect()}
    telling = _telling([seen.get(c, 0) for c in (0, 1)], min_docs, certainty, contrast)
    words = _vocabulary(counted, max_words, min_docs, telling)
    model.words = {word: place + FIRST_WORD for place, word in enumerate(words["word"])}
    split = np.concatenate([np.zeros(FIRST_WORD, bool), words["telling"].to_numpy(bool)])
    _estimate(model, split, _bigrams(spark, counted, model), telling, max_bigrams)
    evidence = on_executors(spark, model, ToxicityModel.evidence)
    # At most 2 * docs_per_class rows of two numbers.
    curve = rows.filter("held_back").select("class", evidence("text").alias("x")).toPandas()
    _calibrate(model, curve, sizes)
    return model


def _telling(docs: list[int], min_docs: int, certainty: float, contrast: float) -> Column:
    """Whether d0 of ``docs[0]`` and d1 of ``docs[1]`` documents tell the classes apart."""
    share = docs[1] / max(1, sum(docs))
    both, d0, d1 = F.expr("d0 + d1"), F.col("d0"), F.col("d1")
    spread = both * share * (1 - share)
    # Per document of each class, in common units.
    of0, of1 = d0 * docs[1], d1 * docs[0]
    return (
        (both >= min_docs)
        & (F.pow(d1 - both * share, 2) > certainty**2 * spread)
        & (F.greatest(of0, of1) >= contrast * F.least(of0, of1))
    )


def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fewer rows at a time, which bounds what is counted before it is passed on."""
    for batch in batches:
        for at in range(0, len(batch), PART_ROWS):
            yield batch.iloc[at : at + PART_ROWS]


def _vocabulary(
    rows: DataFrame, max_words: int, min_docs: int, telling: Column
) -> pd.DataFrame:
    """The words found in the most documents, and whether they tell the classes apart."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts(batches):
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for label, text in zip(batch["class"], batch["text"], strict=True):
                seen[label].update({w for w in terms(text) if len(w) <= MAX_WORD_CHARS})
            words = list(seen[0] | seen[1])
            # Arrow has no plain array for an empty column of text.
            if words:
                times = {f"d{c}": [seen[c][w] for w in words] for c in (0, 1)}
                yield pd.DataFrame({"word": words} | times)

    return (
        rows.mapInPandas(count, "word string, d0 long, d1 long")
        .groupBy("word")
        .agg(F.sum("d0").alias("d0"), F.sum("d1").alias("d1"))
        .filter(F.col("d0") + F.col("d1") >= min_docs)
        .orderBy(F.desc(F.col("d0") + F.col("d1")), "word")
        .limit(max_words)
        .select("word", telling.alias("telling"))
        .toPandas()
    )


def _bigrams(spark: SparkSession, rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per bigram: tokens n0, n1 and documents d0, d1 of either class."""
    shared = spark.sparkContext.broadcast(model)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        width = len(model.words) + FIRST_WORD
        for batch in parts(batches):
            for label, texts in batch.groupby("class")["text"]:
                ids = [model.ids(t) for t in texts]
                own = [np.unique(i[:-1] * width + i[1:], return_counts=True) for i in ids]
                keys, place = np.unique(np.concatenate([k for k, _ in own]), return_inverse=True)
                n = np.bincount(place, weights=np.concatenate([c for _, c in own]))
                found = {"v": keys // width, "w": keys % width}
                for c in (0, 1):
                    found[f"n{c}"] = n if c == label else 0
                    found[f"d{c}"] = np.bincount(place) if c == label else 0
                yield pd.DataFrame(found)

    numbers = ["n0", "n1", "d0", "d1"]
    return written(
        rows.select("class", "text")
        .mapInPandas(count, "v long, w long, n0 long, d0 long, n1 long, d1 long")
        .groupBy("v", "w")
        .agg(*[F.sum(name).alias(name) for name in numbers]),
        "bigrams",
    )


def _estimate(
    model: ToxicityModel, split: np.ndarray, bigrams: DataFrame, telling: Column, max_bigrams: int
) -> None:
    """Interpolated Kneser-Ney; every frame collected here has a row per word or per kept bigram."""
    width = len(split)
    ones = bigrams.agg(
        *[F.count_if(F.col(f"n{c}") == k).alias(f"n{c}_{k}") for c in (0, 1) for k in (1, 2)]
    ).first()
    discount = np.full(2, 0.75)
    for c in (0, 1):
        if ones[f"n{c}_1"] and ones[f"n{c}_2"]:
            discount[c] = ones[f"n{c}_1"] / (ones[f"n{c}_1"] + 2 * ones[f"n{c}_2"])

    def per_word(key: str, **values: Column) -> list[np.ndarray]:
        pdf = bigrams.groupBy(key).agg(*[v.alias(name) for name, v in values.items()]).toPandas()
        found = np.zeros((len(values), width))
        found[:, pdf[key].to_numpy("int64")] = pdf[list(values)].to_numpy("float64").T
        return list(found)

    types = [F.count_if(F.col(f"n{c}") > 0) for c in (0, 1)]
    *continued, pooled = per_word("w", t0=types[0], t1=types[1], both=F.count("*"))
    total0, total1, types0, types1 = per_word(
        "v", n0=F.sum("n0"), n1=F.sum("n1"), t0=types[0], t1=types[1]
    )
    total, after = np.stack([total0, total1]), np.stack([types0, types1])

    def discounted(counts: np.ndarray, d: float, below: np.ndarray) -> np.ndarray:
        if not counts.sum():
            return below
        return (np.maximum(counts - d, 0) + np.minimum(counts, d).sum() * below) / counts.sum()

    everything = discounted(pooled, 0.75, np.full(width, 1 / width))
    model.lower = np.stack(
        [
            np.where(split, discounted(continued[c], discount[c], everything), everything)
            for c in (0, 1)
        ]
    )
    model.backoff = np.where(total > 0, discount[:, None] * after / np.maximum(total, 1), 1.0)
    kept = (
        bigrams.filter(telling)
        .orderBy(F.desc(F.col("d0") + F.col("d1")), "v", "w")
        .limit(max_bigrams)
        .select("v", "w", "n0", "n1")
        .toPandas()
    )
    keys = kept["v"].to_numpy("int64") * width + kept["w"].to_numpy("int64")
    order = np.argsort(keys)
    model.keys = keys[order]
    model.upper = np.stack(
        [
            np.maximum(kept[f"n{c}"].to_numpy("float64") - discount[c], 0)[order]
            / np.maximum(total[c, kept["v"].to_numpy("int64")[order]], 1)
            for c in (0, 1)
        ]
    )


def _calibrate(model: ToxicityModel, seen: pd.DataFrame, sizes: list[int]) -> None:
    """Weighted logistic regression of the class on the evidence, by Newton steps.

    Classes weigh what they have among all labelled ids, whatever their shares in the sample.
    """
    x, y = seen["x"].to_numpy(), seen["class"].to_numpy()
    counts = np.bincount(y, minlength=2)
    if not counts.all():
        model.slope, model.intercept = 20.0, -2.0
        return
    share = np.array(sizes) / sum(sizes)
    weight = (share / counts)[y] * len(y)
    design = np.column_stack([x, np.ones_like(x)])
    scale = max(x.std(), 1e-9)
    design[:, 0] /= scale
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design
        # A small penalty keeps separable classes finite.
        step = np.linalg.solve(
            curve + np.eye(2) * 1e-2, design.T @ (weight * (y - p)) - 1e-2 * beta
        )
        beta += step
        if abs(step).max() < 1e-8:
            break
    model.slope, model.intercept = float(beta[0] / scale), float(beta[1])


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, score in 0..1, predicted (1 from 0.5 on).

    Missing and empty texts have no evidence and get the score of evidence 0. Repeated rows and missing ids stay rows;
    an empty table gives no rows; other columns are ignored.
    """
    score = on_executors(docs.sparkSession, model, ToxicityModel.score)
    return docs.select(
        col(id_col).alias("doc_id"), score(col(text_col)).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def learnt(spark: SparkSession, docs: DataFrame, sf_dir: str) -> ToxicityModel:
    """The model of the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").filter(id_remainder("doc_id", 5) != 0)
    return fit(docs.select("doc_id", "text"), labels.select("doc_id", F.col("toxic").alias("label")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, learnt(spark, docs, sf_dir))
    return scored.select(
        "doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted"
    )


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLES: dict[str, str] = {}
