import pytest
from pyspark.sql import functions as F

from foldboard.operators.split import (
    BUCKETS,
    drawn_fold,
    drawn_for_training,
    fold_number,
    hash_split,
    is_train,
    key_bucket,
    random_fold,
    random_split,
    row_bucket,
    split_counts,
    with_draws,
)


def test_sides_do_not_depend_on_the_partition_layout(spark):
    df = spark.range(5000)
    sides = [
        {r["id"] for r in hash_split(df.repartition(n), key_bucket("id"))[0].collect()} for n in (1, 7)
    ]
    assert sides[0] == sides[1]
    assert len(sides[0]) == pytest.approx(4000, abs=50)


def test_huge_and_negative_keys(spark):
    df = spark.createDataFrame([(2**62, -5), (-(2**62), 3)], "a bigint, b int")
    found = [r[0] for r in df.select(key_bucket("a", "b")).collect()]
    assert found == [(a * 2654435761 + b * 40503) % BUCKETS for a, b in [(2**62, -5), (-(2**62), 3)]]


def test_copies_stay_on_one_side(spark):
    df = spark.range(300).selectExpr("cast(id % 30 as string) AS text", "1.5 AS x")
    sides = df.groupBy("text").agg(F.countDistinct(is_train(row_bucket("text", "x"))).alias("n"))
    assert sides.filter("n > 1").isEmpty()


@pytest.mark.parametrize("ratio", [0.5, 0.8, 0.9])
def test_ratio_and_folds(spark, ratio):
    bucket = key_bucket("id")
    train, test = hash_split(spark.range(20000), bucket, ratio)
    assert train.count() == pytest.approx(20000 * ratio, abs=100)
    assert train.union(test).distinct().count() == 20000
    folds = {r["fold"]: r["count"] for r in train.groupBy(fold_number(bucket).alias("fold")).count().collect()}
    assert set(folds) == {0, 1, 2}
    assert max(folds.values()) - min(folds.values()) < 200


def test_random_split_is_complete(spark):
    train, test = random_split(spark.range(1000).repartition(4))
    assert train.union(test).distinct().count() == train.count() + test.count() == 1000


def test_missing_buckets_have_one_side(spark):
    df = spark.range(1000).withColumn("key", F.when(F.col("id") % 10 > 0, F.col("id")))
    for bucket in (key_bucket("key"), F.col("key")):
        train, test = hash_split(df, bucket)
        assert train.count() + test.count() == train.union(test).distinct().count() == 1000
        sizes = {r["split"]: r["row_count"] for r in split_counts(df, bucket).collect()}
        assert sizes == {"train": train.count(), "test": test.count()}
        assert df.filter(fold_number(bucket).isNull()).isEmpty()


def test_random_folds_do_not_follow_the_random_split(spark):
    rows = spark.range(3000, numPartitions=600)
    train, _ = random_split(rows)
    folds = [r["count"] for r in train.groupBy(random_fold()).count().collect()]
    assert len(folds) == 3 and max(folds) - min(folds) < 150


def drawn_rows(df):
    columns = ["text", "x", F.col("_ordinal"), drawn_for_training(), drawn_fold()]
    return sorted(map(str, with_draws(df, ["text", "x"]).select(*columns).collect()))


def test_draws_do_not_follow_the_layout(spark):
    """Equal rows are a third of the table; missing values, empty texts and separators inside values."""
    df = spark.range(1500).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL WHEN id % 50 = 2 THEN '' ELSE concat('1:', id % 400) END AS text",
        "CASE WHEN id % 3 > 0 THEN (id % 7) / 2.0D END AS x",
        "id AS other",
    )
    layouts = [drawn_rows(df.repartition(n)) for n in (1, 4, 16)]
    assert layouts[0] == layouts[1] == layouts[2]
    assert drawn_rows(df.repartition(4, "other")) == layouts[0]
    drawn = with_draws(df, ["text", "x"]).filter("text = 'hot'")
    found = drawn.agg(F.count("*"), F.countDistinct("_ordinal"), F.max("_ordinal"), F.count_if(drawn_for_training())).first()
    assert found[:3] == (500, 500, 499) and 360 < found[3] < 440
    folds = {r[0]: r[1] for r in drawn.groupBy(drawn_fold()).count().collect()}
    assert set(folds) == {0, 1, 2} and min(folds.values()) > 120


def test_draws_of_any_type(spark):
    df = spark.range(6).selectExpr(
        "id % 2 AS id",
        "array(id % 2) AS list",
        "named_struct('a', id % 2) AS record",
        "cast(cast(id % 2 AS string) AS binary) AS raw",
        "DATE'2020-01-01' + cast(id % 2 AS int) AS day",
        "map('k', id % 2) AS pairs",
    )
    rows = with_draws(df).collect()
    assert sorted((r["id"], r["_ordinal"]) for r in rows) == [(i, k) for i in (0, 1) for k in range(3)]
    assert len({r["_draw"] for r in rows}) == 6
    assert with_draws(df.limit(0)).count() == 0
    other = {r["_draw"] for r in with_draws(df, seed=1).collect()}
    assert not other & {r["_draw"] for r in rows}


def test_copies_do_not_meet_in_one_task(spark):
    """Ordinals of one content are counted per input partition."""
    df = spark.range(4000, numPartitions=40).selectExpr("'same' AS text")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        sizes = [r["count"] for r in with_draws(df).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # A few small files share a task when they are read again.
    assert sum(sizes) == 4000 and max(sizes) < 2000
