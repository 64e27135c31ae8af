"""The first few rows of many searches: in a task by arrays, over all tasks by windows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stands for a missing id, which is the largest of all.
NO_ID = np.iinfo(np.int64).max
ANY_SCORE = 2**62
#: Buckets in which the best rows of all tasks are thinned out before they meet.
BUCKETS = 32


class Best:
    """The first ``k`` rows by falling score, then id, then row number."""

    def __init__(self, k: int, bar: int = -ANY_SCORE):
        self.k = k
        self.found = np.zeros((0, 3), "int64")
        #: What a further row must score at least.
        self.bar = bar

    def add(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if len(scores) > self.k:
            last = np.partition(scores, len(scores) - self.k)[-self.k]
            keep = scores >= last
            scores, ids, rows = scores[keep], ids[keep], rows[keep]
        every = np.concatenate([self.found, np.stack([scores, ids, rows], axis=1)])
        order = np.lexsort((every[:, 2], every[:, 1], -every[:, 0]))[: self.k]
        self.found = every[order]
        if len(order) == self.k:
            self.bar = max(self.bar, int(self.found[-1, 0]))


def first_rows(found: DataFrame, keys: list[str], spread: str, k: int) -> DataFrame:
    """The best ``k`` rows (score, id, row) per ``keys`` with their rank, thinned out in buckets of ``spread`` first."""
    order = [F.desc("score"), "id", "row"]
    bucket = F.pmod(F.xxhash64(spread), F.lit(BUCKETS))
    in_bucket = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    thin = found.withColumn("_bucket", bucket).withColumn("rank", in_bucket).filter(F.col("rank") <= k)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return thin.drop("_bucket").withColumn("rank", rank).filter(F.col("rank") <= k)


def known(name: str) -> Column:
    """The id in column ``name``, NULL where it stood for a missing one."""
    return F.when(F.col(name) != int(NO_ID), F.col(name))
