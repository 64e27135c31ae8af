"""Train/test splits and cross-validation folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType, UserDefinedType, VariantType

from foldboard.scratch import written

# Number of buckets and the multipliers of the key columns.
BUCKETS = 10007
FIRST_MULTIPLIER = 2654435761
NEXT_MULTIPLIER = 40503

DEFAULT_RATIO = 0.8
DEFAULT_SEED = 42
FOLD_SEED = DEFAULT_SEED + 7919
NUM_FOLDS = 3
# Random numbers of rows are eight hexadecimal digits.
DRAWS = 1 << 32


def key_bucket(*keys: Column | str) -> Column:
    """Bucket in [0, BUCKETS) from integral key columns, by plain arithmetic.

    Keys and multipliers are reduced first, so that no key is large enough to
    overflow, and any SQL engine can recompute the bucket. A missing key gives
    a missing bucket: :func:`hash_split` puts such rows into the test part.
    """
    total = F.lit(0).cast("bigint")
    for position, key in enumerate(keys):
        column = F.col(key) if isinstance(key, str) else key
        multiplier = FIRST_MULTIPLIER if position == 0 else pow(NEXT_MULTIPLIER, position, BUCKETS)
        total = total + F.pmod(column.cast("bigint"), F.lit(BUCKETS)) * F.lit(multiplier % BUCKETS)
    return F.pmod(total, F.lit(BUCKETS))


def row_bucket(*columns: Column | str) -> Column:
    """Bucket from the contents of a row, for tables without an integral key.

    Equal rows share a bucket, so a copy of a training row never sits in the test part.
    """
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS))


def is_train(bucket: Column, ratio: float = DEFAULT_RATIO) -> Column:
    """Side of a row; never NULL, a missing bucket belongs to the test part."""
    return F.coalesce(bucket < F.lit(ratio * BUCKETS), F.lit(False))


def split_name(bucket: Column, ratio: float = DEFAULT_RATIO) -> Column:
    return F.when(is_train(bucket, ratio), "train").otherwise("test")


def fold_number(bucket: Column, num_folds: int = NUM_FOLDS) -> Column:
    """Fold of a row; a missing bucket counts as 0."""
    return F.coalesce(F.pmod(bucket, F.lit(num_folds)), F.lit(0)).cast("int")


def random_fold(num_folds: int = NUM_FOLDS, seed: int = FOLD_SEED) -> Column:
    """Seeded random fold of a row, for a table that stays as it is: it changes with the partition layout.

    :func:`drawn_fold` does not.
    """
    return F.floor(F.rand(seed) * num_folds).cast("int")


def hash_split(
    df: DataFrame, bucket: Column, ratio: float = DEFAULT_RATIO
) -> tuple[DataFrame, DataFrame]:
    """Split by bucket: a row filter without shuffle or sort.

    A row's side depends on the row alone, so it survives another partition
    layout and the recomputation of lost partitions. Every row has exactly one
    side, also where ``bucket`` is NULL.
    """
    train = is_train(bucket, ratio)
    return df.filter(train), df.filter(~train)


def content_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """The contents of a row as one text; two rows have the same text only if they are equal."""
    parts = []
    for name in columns:
        kind = df.schema[name].dataType
        cell = F.col(f"`{name}`")
        if isinstance(kind, BinaryType):
            text = F.hex(cell)
        elif isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
            text = F.to_json(F.struct(cell))
        elif isinstance(kind, UserDefinedType):
            text = F.to_json(F.struct(unwrap_udt(cell)))
        else:
            text = cell.cast("string")
        # The length keeps cells apart, whatever they contain.
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def with_draws(df: DataFrame, columns: Sequence[str] | None = None, seed: int = DEFAULT_SEED) -> DataFrame:
    """``df`` with two random numbers in [0, DRAWS) per row, ``_draw`` and ``_fold_draw``, and ``_ordinal``.

    The numbers depend on seed, contents (of ``columns``, by default all) and the row's ordinal among its equals, from
    0 on. So copies have numbers of their own, and another partition layout gives the same rows the same numbers: which
    of two equal rows comes first makes no difference. Ordinals are counted per partition and continued over
    partitions, so copies that fill a third of the table never meet in one task. The rows are written to the shared
    folder on the way.
    """
    text = content_text(df, df.columns if columns is None else columns)
    by_part = Window.partitionBy("_content", "_part").orderBy("_content")
    local = written(
        df.withColumn("_content", F.md5(text.cast("binary")))
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.row_number().over(by_part)),
        "draws",
    )
    sizes = local.groupBy("_content", "_part").agg(F.count("*").alias("_size"))
    before = Window.partitionBy("_content").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.sum("_size").over(before)).filter("_start > 0").drop("_size")
    ordinal = F.coalesce("_start", F.lit(0)) + F.col("_place") - 1
    digits = F.md5(F.concat_ws("/", F.lit(str(seed)), "_content", F.col("_ordinal").cast("string")).cast("binary"))
    number = lambda begin: F.conv(F.substring(digits, begin, 8), 16, 10).cast("bigint")
    return (
        local.join(starts, ["_content", "_part"], "left")
        .withColumn("_ordinal", ordinal.cast("bigint"))
        .select(*[F.col(f"`{c}`") for c in df.columns], "_ordinal", number(1).alias("_draw"), number(9).alias("_fold_draw"))
    )


def drawn_for_training(ratio: float = DEFAULT_RATIO) -> Column:
    """Whether a row of :func:`with_draws` is on the training side."""
    return F.col("_draw") < F.lit(int(ratio * DRAWS)).cast("bigint")


def drawn_fold(num_folds: int = NUM_FOLDS) -> Column:
    """Random fold of a row of :func:`with_draws`, independent of its side."""
    return F.pmod("_fold_draw", F.lit(num_folds)).cast("int")


def random_split(
    df: DataFrame, ratio: float = DEFAULT_RATIO, seed: int = DEFAULT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Seeded random split that spreads copies over both sides and does not follow the partition layout of ``df``."""
    drawn = with_draws(df, seed=seed)
    train = drawn_for_training(ratio)
    return drawn.filter(train).select(*df.columns), drawn.filter(~train).select(*df.columns)


def split_counts(df: DataFrame, bucket: Column, ratio: float = DEFAULT_RATIO) -> DataFrame:
    """Rows per side, in one job."""
    return df.groupBy(split_name(bucket, ratio).alias("split")).agg(F.count("*").alias("row_count"))


def empty_training_sets(
    df: DataFrame, by: str, bucket: Column, ratio: float = DEFAULT_RATIO
) -> DataFrame:
    """``(by, rule, row_count)``: data sets inside ``df`` whose split leaves nothing to train on."""
    counts = df.groupBy(by).agg(
        F.count("*").alias("row_count"), F.count_if(is_train(bucket, ratio)).alias("_train")
    )
    return counts.filter("_train = 0").select(
        by, F.lit("training_set_empty").alias("rule"), "row_count"
    )


def fold_counts(
    df: DataFrame, bucket: Column, ratio: float = DEFAULT_RATIO, num_folds: int = NUM_FOLDS
) -> DataFrame:
    """Training rows per fold."""
    return (
        df.filter(is_train(bucket, ratio))
        .groupBy(fold_number(bucket, num_folds).alias("fold"))
        .agg(F.count("*").alias("row_count"))
    )
