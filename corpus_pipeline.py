"""From raw documents to shards: toxicity, near duplicates, benchmark passages, mixture, shards.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns them with all columns of
``docs``; only the last one returns shards instead. What a stage returns is written as parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.llm.common import table
from foldboard.llm.decontamination import clean_documents
from foldboard.llm.mixing import drawn_documents
from foldboard.llm.near_dedup import one_per_class
from foldboard.llm.sharding import in_contract, shard_by_bytes
from foldboard.llm.toxicity import ToxicityModel, learnt, on_executors
from foldboard.scratch import written

#: Share of the tokens that the mixture keeps.
MIXTURE_SHARE = 0.8
SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half."""
    score = on_executors(spark, learnt(spark, docs, sf_dir), ToxicityModel.score)
    return docs.filter(score(F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates."""
    return one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages are less than a twentieth."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def draw_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the raked probabilities of their source, language and topic."""
    return drawn_documents(docs, kept_share=MIXTURE_SHARE)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document that is left."""
    return in_contract(shard_by_bytes(docs, SHARDS))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", draw_mixture),
    ("sharding", place_in_shards),
]

#: Models and signatures have no SQL form; tests/llm compares the stages with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
