"""Shards of near equal bytes by longest-processing-time scheduling.

Rows with equal texts form a group that is never divided. Groups, largest first, go to the least loaded shard, which a
heap finds. Sorting all groups of a large table in one place would not scale, so groups smaller than one unit
(total bytes / (shards * units_per_shard)) are first bundled by hash. At most shards * units_per_shard groups reach
a unit, since together they cannot exceed the total, and there are as many bundles. So the heap sees at most
2 * shards * units_per_shard entries at any size of the input, and loads end within about one unit of each other unless a
single group is larger than a shard.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldboard.llm.common import col, table
from foldboard.scratch import written

ROW_BYTES = 16
#: Rows that share one sorted run of a shard.
RUN_ROWS = 50_000


def longest_first(items: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Shard of every key of ``items`` (bytes, key); ties go by key, then by shard number."""
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, key in sorted(items, key=lambda item: (-item[0], item[1])):
        load, shard = heapq.heappop(loads)
        placed[key] = shard
        heapq.heappush(loads, (load + size, shard))
    return placed


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    units_per_shard: int = 256,
) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard and slot (gapless from 0 in each shard).

    A missing text has no bytes and shares the group of empty texts. Missing and repeated ids are rows like others:
    every row gets a slot of its own. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(col(text_col), F.lit(""))
    sized = written(
        docs.select(
            col(id_col).alias("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            # Two texts under one hash would merely share a shard.
            F.xxhash64(text).alias("_group"),
        ),
        "sizes",
    )
    bundles = shards * units_per_shard
    groups = written(
        sized.groupBy("_group").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups"
    )
    total = groups.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("rows")).first()
    unit = max(1, -(-(total["bytes"] or 0) // bundles))
    rows = total["rows"] or 0
    bundle = F.pmod(F.col("_group"), F.lit(bundles))
    # Negative keys are bundles, so that one heap serves both kinds.
    heavy = groups.filter(F.col("bytes") >= unit).select("bytes", "_group").collect()
    light = (
        groups.filter(F.col("bytes") < unit)
        .groupBy(bundle.alias("bundle"))
        .agg(F.sum("bytes").alias("bytes"))
        .collect()
    )
    items = [(r["bytes"], ("group", r["_group"])) for r in heavy]
    items += [(r["bytes"], ("bundle", r["bundle"])) for r in light]
    placed = longest_first(items, shards)
    by_group = _lookup(spark, placed, "group", "_group", "_own")
    by_bundle = _lookup(spark, placed, "bundle", "_bundle", "_shared")
    runs = 64 + rows // (shards * RUN_ROWS)
    located = (
        sized.withColumn("_bundle", bundle)
        .join(F.broadcast(by_group), "_group", "left")
        .join(F.broadcast(by_bundle), "_bundle", "left")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.coalesce("_own", "_shared").alias("shard"),
            F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(runs)).alias("_run"),
        )
    )
    # A slot is the rank in a run plus the rows of the runs before it: no shard is sorted as a whole.
    before = Window.partitionBy("shard").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        located.groupBy("shard", "_run")
        .agg(F.count("*").alias("_n"))
        .select("shard", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    rank = F.row_number().over(Window.partitionBy("shard", "_run").orderBy("doc_id", "text_crc32"))
    return (
        located.withColumn("_rank", rank)
        .join(starts, ["shard", "_run"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("_start") + F.col("_rank") - 1).cast("bigint").alias("slot"),
        )
    )


def _lookup(spark: SparkSession, placed: dict, kind: str, key: str, value: str) -> DataFrame:
    rows = [(k, shard) for (of, k), shard in placed.items() if of == kind]
    return spark.createDataFrame(rows, f"{key} bigint, {value} int")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    return in_contract(shard_by_bytes(table(spark, sf_dir, "documents")))


def in_contract(shards: DataFrame) -> DataFrame:
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op7_sharding": op7_sharding}
ORACLES: dict[str, str] = {}
