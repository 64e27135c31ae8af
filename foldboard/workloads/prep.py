"""Queries on preprocessing: indexing, imputation, assembly and scaling."""

from __future__ import annotations

from pyspark.ml.feature import Imputer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.operators.features import FEATURES, LABEL_SUFFIX, plan_features, preprocessing
from foldboard.operators.indexing import CategoryIndexer
from foldboard.operators.split import is_train, key_bucket
from foldboard.plans.spec import RunSpec
from foldboard.workloads.tables import charges, table

LINE_SPEC = RunSpec(
    ["l_quantity", "l_extendedprice", "l_linenumber", "l_returnflag"],
    "charge",
    {
        "l_returnflag": "categorical",
        "l_quantity": "numerical",
        "l_linenumber": "categorical",
        "l_extendedprice": "numerical",
    },
)


def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names: fitted on the training side, applied to all parts."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    train = parts.filter(is_train(key_bucket("p_partkey", "p_size")))
    model = CategoryIndexer(inputCols=["p_name"], outputCols=["p_name_indexed"]).fit(train)
    return model.transform(parts).select("p_partkey", "p_name_indexed")


def string_index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders as categories, kept as a table: too many labels for a list.

    Some customers are missing and some occur on the test side only.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("c"), "o_custkey")).alias("customer"),
    )
    train = orders.filter(is_train(key_bucket("o_orderkey")))
    indexer = CategoryIndexer(
        inputCols=["customer"], outputCols=["customer_indexed"], maxLabels=0, headLabels=100
    )
    return indexer.fit(train).transform(orders).select("o_orderkey", "customer_indexed")


LINE_KEYS = ("l_orderkey", "l_partkey", "l_suppkey")


def string_index_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys of line items as categories, all of them kept as tables and looked up together.

    Some are missing, and some occur on the test side only.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        *[
            F.when(F.col("l_linenumber") % (k + 3) != 0, F.concat(F.lit(c[2]), c)).alias(f"{c[2:]}_name")
            for k, c in enumerate(LINE_KEYS)
        ],
    )
    train = lines.filter(is_train(key_bucket("l_orderkey")))
    names = [f"{c[2:]}_name" for c in LINE_KEYS]
    indexer = CategoryIndexer(
        inputCols=names, outputCols=[f"{n}_indexed" for n in names], maxLabels=0, headLabels=50
    )
    return indexer.fit(train).transform(lines).select(
        "l_orderkey", "l_linenumber", *[f"{n}_indexed" for n in names]
    )


def string_index_unseen_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders, four in ten of them under one name that fitting has not seen."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 10 < 4, "new").otherwise(F.concat(F.lit("c"), "o_custkey")).alias("customer"),
    )
    indexer = CategoryIndexer(
        inputCols=["customer"], outputCols=["customer_indexed"], maxLabels=0, headLabels=100
    )
    model = indexer.fit(orders.filter("customer <> 'new'"))
    return model.transform(orders).select("o_orderkey", "customer_indexed")


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A string label with missing values becomes an index; missing is a class of its own."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("priority"),
    )
    plan = plan_features(["o_totalprice"], "priority", {"o_totalprice": "numerical"}, orders.schema)
    fitted = preprocessing(plan).fit(orders)
    return fitted.stages[0].transform(orders).select(
        "o_orderkey", F.col("priority" + LABEL_SUFFIX).alias("label_index")
    )


def impute_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("discount")
    )
    fitted = Imputer(inputCols=["discount"], outputCols=["discount_imputed"], strategy="mean").fit(lines)
    return fitted.transform(lines).select(
        "l_orderkey", "l_linenumber", F.round("discount_imputed", 6).alias("discount_imputed")
    )


def impute_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An integer column takes the mean without its fraction."""
    documents = (
        table(spark, sf_dir, "documents")
        .select("doc_id")
        .join(table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * 5).alias("grade")), "doc_id", "left")
    )
    fitted = Imputer(inputCols=["grade"], outputCols=["grade_imputed"], strategy="mean").fit(documents)
    return fitted.transform(documents).select("doc_id", "grade", "grade_imputed")


def assemble_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every element of the standardised feature vector."""
    lines = charges(spark, sf_dir)
    plan = plan_features(LINE_SPEC.feature_cols, "charge", LINE_SPEC.data_types, lines.schema)
    lines = lines.select("l_orderkey", *plan.source_columns)
    scaled = preprocessing(plan).fit(lines).transform(lines)
    return scaled.select(
        "l_orderkey", F.posexplode(vector_to_array(FEATURES)).alias("pos", "scaled")
    ).select("l_orderkey", F.col("pos").cast("bigint").alias("pos"), (F.round("scaled", 4) + 0.0).alias("scaled"))


QUERIES = {
    "string_index": string_index,
    "string_index_table": string_index_table,
    "string_index_columns": string_index_columns,
    "string_index_unseen_hot": string_index_unseen_hot,
    "label_index": label_index,
    "impute_double": impute_double,
    "impute_int": impute_int,
    "assemble_scale": assemble_scale,
}


def _index_sql(rows: str, key: str, value: str, fit: str, output: str) -> str:
    return f"""
        WITH source AS ({rows}),
        labels AS (
            SELECT {value} AS value, row_number() OVER (ORDER BY count(*) DESC, {value}) - 1 AS idx
            FROM source WHERE {value} IS NOT NULL AND {fit} GROUP BY {value}
        )
        SELECT {key}, CAST(coalesce(idx, (SELECT count(*) FROM labels)) AS DOUBLE) AS {output}
        FROM source LEFT JOIN labels ON source.{value} = labels.value
    """


def _line_keys_sql() -> str:
    """All three lookups, one per key."""
    names = ", ".join(
        f"CASE WHEN l_linenumber % {k + 3} <> 0 THEN '{c[2]}' || {c} END AS {c[2:]}_name"
        for k, c in enumerate(LINE_KEYS)
    )
    parts = [
        f"""{c[2:]}_labels AS (
            SELECT {c[2:]}_name AS value, row_number() OVER (ORDER BY count(*) DESC, {c[2:]}_name) - 1 AS idx
            FROM source WHERE {c[2:]}_name IS NOT NULL AND (l_orderkey * 2654435761) % 10007 < 0.8 * 10007
            GROUP BY {c[2:]}_name)"""
        for c in LINE_KEYS
    ]
    found = ", ".join(
        f"CAST(coalesce({c[2:]}_labels.idx, (SELECT count(*) FROM {c[2:]}_labels)) AS DOUBLE) AS {c[2:]}_name_indexed"
        for c in LINE_KEYS
    )
    joins = " ".join(
        f"LEFT JOIN {c[2:]}_labels ON {c[2:]}_name = {c[2:]}_labels.value" for c in LINE_KEYS
    )
    return f"""
        WITH source AS (SELECT l_orderkey, l_linenumber, {names} FROM lineitem), {", ".join(parts)}
        SELECT l_orderkey, l_linenumber, {found} FROM source {joins}
    """


ORACLES = {
    "string_index_columns": _line_keys_sql(),
    "string_index": _index_sql(
        "SELECT p_partkey, p_size, p_name FROM part",
        "p_partkey",
        "p_name",
        "(p_partkey * 2654435761 + p_size * 40503) % 10007 < 0.8 * 10007",
        "p_name_indexed",
    ),
    "string_index_table": _index_sql(
        "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN 'c' || o_custkey END AS customer FROM orders",
        "o_orderkey",
        "customer",
        "(o_orderkey * 2654435761) % 10007 < 0.8 * 10007",
        "customer_indexed",
    ),
    "string_index_unseen_hot": _index_sql(
        "SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 4 THEN 'new' ELSE 'c' || o_custkey END AS customer FROM orders",
        "o_orderkey",
        "customer",
        "customer <> 'new'",
        "customer_indexed",
    ),
    "label_index": _index_sql(
        "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority FROM orders",
        "o_orderkey",
        "priority",
        "true",
        "label_index",
    ),
    "impute_double": """
        SELECT l_orderkey, l_linenumber,
               round(coalesce(nullif(l_discount, 0), avg(nullif(l_discount, 0)) OVER ()), 6) AS discount_imputed
        FROM lineitem
    """,
    "impute_int": """
        SELECT d.doc_id, quality * 5 AS grade,
               coalesce(quality * 5, CAST(trunc(avg(quality * 5) OVER ()) AS INTEGER)) AS grade_imputed
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
    "assemble_scale": """
        WITH flags AS (
            SELECT l_returnflag, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS idx
            FROM lineitem GROUP BY l_returnflag
        ), assembled AS (
            SELECT l_orderkey, 0 AS pos, l_quantity AS x FROM lineitem
            UNION ALL SELECT l_orderkey, 1, l_extendedprice FROM lineitem
            UNION ALL SELECT l_orderkey, 2, idx FROM lineitem JOIN flags USING (l_returnflag)
            UNION ALL SELECT l_orderkey, 3, l_linenumber FROM lineitem
        )
        SELECT l_orderkey, CAST(pos AS BIGINT) AS pos,
               round((x - avg(x) OVER (PARTITION BY pos)) / stddev_samp(x) OVER (PARTITION BY pos), 4) + 0.0 AS scaled
        FROM assembled
    """,
}
