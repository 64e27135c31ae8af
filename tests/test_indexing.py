import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from foldboard.operators.indexing import CategoryIndexer, LabelTableModel


@pytest.fixture(scope="module")
def hot(spark):
    """One value fills over a third of the rows, many values tie, some are missing."""
    value = (
        F.when(F.col("id") % 5 < 2, "hot")
        .when(F.col("id") % 5 == 2, F.concat(F.lit("rare"), (F.col("id") % 97).cast("string")))
        .when(F.col("id") % 5 == 3, F.concat(F.lit("tie"), (F.col("id") % 40).cast("string")))
    )
    other = F.when(F.col("id") % 3 > 0, F.concat(F.lit("o"), (F.col("id") % 6).cast("string")))
    return spark.range(2000).select("id", value.alias("value"), other.alias("other"))


def indexed(model, df, *columns):
    return {r["id"]: tuple(r[c] for c in columns) for r in model.transform(df).collect()}


def builtin(df):
    return StringIndexer(
        inputCols=["value", "other"], outputCols=["value_i", "other_i"], handleInvalid="keep"
    ).fit(df)


@pytest.mark.parametrize(
    "limits, kind",
    [
        ({}, PipelineModel),
        ({"maxLabels": 0, "headLabels": 5}, LabelTableModel),
        ({"maxLabels": 0, "headLabels": 1000}, LabelTableModel),
        ({"maxLabels": 0, "headLabels": 0}, LabelTableModel),
        ({"maxLabelBytes": 10, "headLabels": 2}, PipelineModel),
    ],
)
def test_same_indices_as_the_builtin_indexer(hot, limits, kind):
    train = hot.filter("id < 1500")
    indexer = CategoryIndexer(inputCols=["value", "other"], outputCols=["value_i", "other_i"], **limits)
    model = indexer.fit(train)
    assert isinstance(model, kind)
    # The rest of the rows brings values that fitting has not seen.
    rows = hot.union(hot.limit(1).selectExpr("-1L AS id", "'new' AS value", "'new' AS other"))
    assert indexed(model, rows, "value_i", "other_i") == indexed(builtin(train), rows, "value_i", "other_i")


def test_label_table_is_saved_with_a_pipeline(hot, tmp_path):
    pipeline = Pipeline(
        stages=[CategoryIndexer(inputCols=["value"], outputCols=["value_i"], maxLabels=3, headLabels=2)]
    )
    model = pipeline.fit(hot)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert indexed(again, hot, "value_i") == indexed(model, hot, "value_i")


def test_hot_rows_do_not_meet_in_one_partition(hot):
    """Rows found by broadcast are scattered before the join with the rare labels."""
    model = CategoryIndexer(inputCols=["value"], outputCols=["value_i"], maxLabels=0, headLabels=3).fit(hot)
    spark = hot.sparkSession
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        sizes = model.transform(hot).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert max(r["count"] for r in sizes) < 2000 / 3


def test_only_missing_values(spark):
    df = spark.sql("SELECT id, CAST(NULL AS STRING) AS value FROM range(3)")
    model = CategoryIndexer(inputCols=["value"], outputCols=["value_i"]).fit(df)
    assert indexed(model, df, "value_i") == {0: (0.0,), 1: (0.0,), 2: (0.0,)}


def settled_sizes(spark, model, df):
    """Rows per partition after the lookup, without any help at run time."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        return [r["count"] for r in model.transform(df).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("kind", ["copies", "unseen"])
def test_frequent_values_do_not_meet(spark, kind):
    """Equal rows, and a value unseen in fitting, in 40 percent of the rows."""
    other = F.concat(F.lit("v"), (F.col("id") % 1999).cast("string"))
    rows = spark.range(8000, numPartitions=8).select(
        F.when(F.col("id") % 5 < 2, "often").otherwise(other).alias("value")
    )
    train = rows if kind == "copies" else rows.filter("value <> 'often'")
    head = 5 if kind == "copies" else 0
    model = CategoryIndexer(
        inputCols=["value"], outputCols=["value_i"], maxLabels=0, headLabels=head
    ).fit(train)
    sizes = settled_sizes(spark, model, rows)
    assert sum(sizes) == 8000 and max(sizes) < 1500


def test_unrelated_columns_of_any_type(hot):
    """Scoring looks at the indexed column alone."""
    nested = hot.withColumn("extra", F.array(F.create_map(F.lit("k"), F.col("id"))))
    model = CategoryIndexer(inputCols=["value"], outputCols=["value_i"], maxLabels=0, headLabels=2).fit(nested)
    assert model.transform(nested).count() == 2000


def test_columns_share_one_budget(hot):
    indexer = CategoryIndexer(
        inputCols=["value", "other"], outputCols=["value_i", "other_i"], maxLabels=50, headLabels=5
    )
    lists = indexer.fit(hot).stages[0]
    assert lists.getInputCol() == "other"


def exchanges(df):
    """Exchanges by key in the plan that ran, as text."""
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan ==") :]


def test_three_columns_share_one_shuffle_of_cells(spark):
    """Rows and their cells are shuffled once each, not once per column, and are read as often for three columns as for one."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        seen = {}
        for names in (["a"], ["a", "b", "c"]):
            rows = spark.range(3_000, numPartitions=4).select(
                "id",
                *[F.concat(F.lit(n), (F.col("id") * (k + 7) % 1_499).cast("string")).alias(n) for k, n in enumerate(names)],
            )
            indexer = CategoryIndexer(
                inputCols=names, outputCols=[f"{n}_i" for n in names], maxLabels=0, headLabels=3
            )
            model = indexer.fit(rows.filter("id % 10 > 0"))
            counter = spark.sparkContext.accumulator(0)

            def count(batches, counter=counter):
                for batch in batches:
                    counter.add(batch.num_rows)
                    yield batch

            found = model.transform(rows.mapInArrow(count, rows.schema))
            assert found.count() == 3_000
            plan = exchanges(found)
            seen[len(names)] = plan.count("hashpartitioning(_row") , plan.count("hashpartitioning(_k"), counter.value
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert seen[1][0] == 0 and seen[3][0] == 1
    # The cells, their labels, and the count of frequent values.
    assert seen[3][1] == seen[1][1]
    assert seen[3][2] == seen[1][2]


def test_copies_of_rows_with_several_open_cells(spark):
    """Equal rows stay apart, values that stand in several columns too; missing, unseen and known cells in one row."""
    rows = spark.range(900).selectExpr(
        "id % 300 AS id",
        "IF(id % 7 > 0, concat('v', id % 101), NULL) AS a",
        "concat('v', id % 57) AS b",
        "IF(id % 300 < 20, 'new', concat('v', id % 91)) AS c",
        "named_struct('x', id % 3, 'y', array(id % 2)) AS nested",
    )
    names = ["a", "b", "c"]
    train = rows.filter("c <> 'new'")
    made = dict(inputCols=names, outputCols=[f"{n}_i" for n in names])
    table = CategoryIndexer(**made, maxLabels=0, headLabels=4).fit(train)
    plain = StringIndexer(**made, handleInvalid="keep").fit(train)
    columns = ["id", *names, *[f"{n}_i" for n in names], "nested"]
    found, expected = (
        sorted(map(str, m.transform(rows).select(*columns).collect())) for m in (table, plain)
    )
    assert found == expected and len(found) == 900


def test_frequent_values_are_found_without_a_shuffle_of_cells(spark):
    """Cells are dealt out by value once, to meet their labels, and their values do not travel with the row too."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(3_000, numPartitions=4).selectExpr("id", "concat('a', id % 1499) AS a", "concat('b', id % 701) AS b")
        names = ["a", "b"]
        model = CategoryIndexer(inputCols=names, outputCols=["a_i", "b_i"], maxLabels=0, headLabels=3).fit(rows)
        found = model.transform(rows)
        plan = exchanges(found)
        kept = found.filter("a = concat('a', id % 1499) AND b = concat('b', id % 701)").count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert kept == 3_000
    assert plan.count("hashpartitioning(_k") == 2
