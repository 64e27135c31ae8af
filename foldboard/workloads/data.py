"""Queries on sources, sinks, splits and run requests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.functions.requests import (
    BLANKS,
    parse_data_types,
    parse_feature_list,
    request_feature_order,
    request_violations,
    roles_of_requests,
    settle_roles,
)
from foldboard.operators.split import (
    drawn_fold,
    drawn_for_training,
    empty_training_sets,
    fold_counts,
    fold_number,
    hash_split,
    key_bucket,
    random_split,
    split_counts,
    split_name,
    with_draws,
)
from foldboard.scratch import scratch_path
from foldboard.sources.paths import bucket_of, key_of
from foldboard.sources.tables import from_rows, ingest_csv, land_csv, preview, profile, read_csv
from foldboard.workloads.tables import BUCKET_SQL, TRAIN_SQL, charges, line_bucket, table

PROFILED = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
# Points in time are compared as text, which every engine writes alike.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_SQL = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            profile(table(spark, sf_dir, name)).withColumn("table_name", F.lit(name))
            for name in PROFILED
        ],
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV and read again with inferred types, the date among them."""
    path = scratch_path(spark, "orders") + ".csv"
    table(spark, sf_dir, "orders").write.csv(path, header=True)
    read = read_csv(spark, path)
    inferred = read.schema["o_orderdate"].dataType.typeName()
    # Inference picks the narrowest integer, so keys are widened again.
    return read.withColumns(
        {c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")}
        | {
            "o_orderdate": F.date_format("o_orderdate", TIME_FORMAT),
            "date_is_time": F.lit(inferred.startswith("timestamp")),
        }
    )


def ingest_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items landed from CSV with a given schema."""
    lines = table(spark, sf_dir, "lineitem")
    csv = scratch_path(spark, "lines") + ".csv"
    lines.write.csv(csv, header=True)
    landed = spark.read.parquet(ingest_csv(spark, csv, scratch_path(spark, "landing"), lines.schema))
    return landed.withColumn("l_shipdate", F.date_format("l_shipdate", TIME_FORMAT))


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return preview(orders, order_by=["o_orderkey"]).withColumn(
        "o_orderdate", F.date_format("o_orderdate", TIME_FORMAT)
    )


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items landed from CSV of which some lines are broken: what became a row, and what was set aside, and why."""
    key = F.col("l_orderkey") + F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    line = F.concat_ws(
        ",",
        F.col("l_orderkey").cast("string"),
        F.when(key % 11 == 0, "first").otherwise(F.col("l_linenumber").cast("string")),
        F.when(key % 5 == 0, "").when(key % 7 == 0, "much").otherwise(price),
        F.when(key % 13 == 0, F.concat("l_returnflag", F.lit(",more"))).otherwise(F.col("l_returnflag")),
    )
    cut = F.when(key % 17 == 0, F.col("l_orderkey").cast("string")).otherwise(line)
    path = scratch_path(spark, "uploads") + "/lines.csv"
    written_lines = table(spark, sf_dir, "lineitem").select(cut.alias("value"))
    # Text files have no suffix to choose; the CSV guard looks at file names.
    written_lines.write.format("csv").option("quote", "").option("sep", "\u0001").save(path)
    landing = land_csv(
        spark,
        path,
        scratch_path(spark, "landing"),
        "l_orderkey bigint, l_linenumber int, price double, flag string",
        header=False,
    )
    nothing = lambda kind: F.lit(None).cast(kind)
    landed = landing.rows(spark).withColumns({c: nothing("string") for c in ("line", "reason", "fault_column")})
    rejected = landing.rejected(spark).withColumns(
        {"l_orderkey": nothing("bigint"), "l_linenumber": nothing("int"), "price": nothing("double"), "flag": nothing("string")}
    )
    return landed.unionByName(rejected)


def in_memory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of every nation, counted on executors, made a table of a few rows again, and told to every customer."""
    customers = table(spark, sf_dir, "customer")
    # A row per nation, however many customers there are.
    counted = customers.groupBy("c_nationkey").agg(
        F.count("*").alias("customers"), F.max("c_acctbal").alias("most")
    )
    rows = [tuple(row) for row in counted.collect()]
    nations = from_rows(spark, rows, ["nation", "customers", "most"])
    return customers.join(F.broadcast(nations), F.col("c_nationkey") == F.col("nation")).select(
        "c_custkey", "customers", (F.col("c_acctbal") == F.col("most")).alias("is_richest")
    )


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", bucket_of(url).alias("bucket"), key_of(url).alias("object_key")
    )


def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and label, everything else ignored."""
    return charges(spark, sf_dir).select(
        "l_quantity", "l_extendedprice", "l_returnflag", "charge"
    )


def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = key_bucket("o_orderkey", "o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        bucket.alias("bucket"),
        split_name(bucket).alias("split"),
        fold_number(bucket).cast("bigint").alias("fold"),
    )


def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which every tenth has lost its customer, with the part that got them."""
    key = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", key_bucket("o_orderkey", key).alias("bucket")
    )
    bucket = F.col("bucket")
    train, test = hash_split(orders, bucket)
    parts = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    return parts.select(
        "o_orderkey",
        "part",
        split_name(bucket).alias("split"),
        fold_number(bucket).cast("bigint").alias("fold"),
    )


def orders_without_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as data sets of their own: those whose lines all fall into the test part."""
    return empty_training_sets(table(spark, sf_dir, "lineitem"), "l_orderkey", line_bucket())


def line_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_counts(table(spark, sf_dir, "lineitem"), line_bucket())


def line_fold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_counts(table(spark, sf_dir, "lineitem"), line_bucket()).select(
        F.col("fold").cast("bigint").alias("fold"), "row_count"
    )


def random_split_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both random parts together: every row lands on exactly one side."""
    columns = ["l_orderkey", "l_linenumber", "l_quantity"]
    train, test = random_split(table(spark, sf_dir, "lineitem").select(*columns))
    return train.unionByName(test)


def random_split_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both random parts, whether their shares are as asked (within five deviations), and rows in both."""
    keyed = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    row = F.xxhash64(*keyed.columns)
    train, test = (part.select(row.alias("row")) for part in random_split(keyed.distinct()))
    parts = train.withColumn("side", F.lit(1)).unionByName(test.withColumn("side", F.lit(0)))
    both = parts.groupBy("row").agg(F.sum("side").alias("train"), F.count("*").alias("n"))
    count, share = F.sum("n"), F.sum("train") / F.sum("n")
    return both.agg(
        count.alias("row_count"),
        (F.abs(share - 0.8) < 5 * F.sqrt(0.16 / count)).alias("share_as_asked"),
        F.count_if(F.col("n") > 1).alias("rows_in_both"),
    )


def random_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Side and fold of every line item by three columns that many lines share, copies told apart by their ordinal."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag")
    return with_draws(lines).select(
        *lines.columns,
        F.col("_ordinal").alias("ordinal"),
        F.when(drawn_for_training(), "train").otherwise("test").alias("split"),
        drawn_fold().cast("bigint").alias("fold"),
    )


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run request per part, as a form would send it, faults included."""
    words = F.split("p_name", " ")
    size = F.col("p_size")
    kind = F.when(size % 3 == 0, "categorical").when(size % 3 == 1, "numerical").otherwise("text")
    names = F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit(" ,\t")), F.lit(" , "))
    types = F.concat(
        F.lit('{"'), words[1], F.lit('": "categorical", "'), words[0], F.lit('": "'), kind, F.lit('"'),
        F.when(size % 10 == 0, "").otherwise("}"),
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("request_id"),
        F.when(size % 17 == 0, " , ").otherwise(names).alias("feature_text"),
        types.alias("types_text"),
        F.when(size % 11 == 0, "").when(size % 5 == 0, words[0]).otherwise(F.lower("p_type")).alias("label_col"),
        F.when(size % 13 != 0, size / 50).alias("train_test_split"),
        F.when(size % 4 == 0, F.array(words[0], F.lower("p_type")))
        .otherwise(F.array(words[0], words[1], F.lower("p_type")))
        .alias("columns"),
        F.array(words[1]).alias("string_cols"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_requests(spark, sf_dir).withColumns(
        {
            "feature_cols": parse_feature_list(F.col("feature_text")),
            "data_types": parse_data_types(F.col("types_text")),
        }
    )


def spec_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.transform(
        F.map_entries("data_types"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return requests(spark, sf_dir).select(
        "request_id",
        F.array_join("feature_cols", "|").alias("features"),
        F.array_join(pairs, "|").alias("types"),
        F.col("data_types").isNull().alias("malformed"),
    )


def text_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lists of any length: the whole texts of the documents."""
    parts = parse_feature_list(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(parts).cast("bigint").alias("name_count"),
        F.array_join(parts, "|").alias("names"),
    )


def event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON objects of another shape, from the event log."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.explode(parse_data_types(F.col("props"))).alias("column_name", "data_type")
    )


def spec_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_violations(requests(spark, sf_dir), "request_id")


def feature_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_feature_order(requests(spark, sf_dir), "request_id").withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def project_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles_of_requests(requests(spark, sf_dir), "request_id").withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def role_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log read as role selections: a session per user, a column per event type."""
    choice = F.col("event_id") % 3
    selections = table(spark, sf_dir, "events").withColumn(
        "role", F.when(choice == 0, "Label").when(choice == 1, "Feature").otherwise("Ignore")
    )
    return settle_roles(selections, "user_id", "event_type", "role", F.col("event_id"))


QUERIES = {
    "profile": profiles,
    "csv_roundtrip": csv_roundtrip,
    "ingest_parquet": ingest_parquet,
    "ingest_quarantine": ingest_quarantine,
    "preview": first_rows,
    "path_parts": path_parts,
    "project_columns": project_columns,
    "in_memory_rows": in_memory_rows,
    "hash_split": sides,
    "split_missing_keys": missing_keys,
    "training_set_empty": orders_without_training,
    "split_counts": line_split_counts,
    "fold_counts": line_fold_counts,
    "random_split_whole": random_split_whole,
    "random_split_check": random_split_check,
    "random_split_rows": random_split_rows,
    "spec_parse": spec_parse,
    "feature_list_texts": text_lists,
    "data_types_events": event_types,
    "spec_violations": spec_violations,
    "feature_order": feature_order,
    "project_roles": project_roles,
    "role_selection": role_selection,
}

WHITE_SQL = " || ".join(f"chr({ord(c)})" for c in BLANKS)

REQUESTS_SQL = f"""
WITH raw AS (
    SELECT p_partkey AS request_id, p_size AS size,
           split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2, lower(p_type) AS kind,
           CASE WHEN p_size % 17 = 0 THEN ' , '
                ELSE ' ' || replace(p_name, ' ', ' ,' || chr(9)) || ' , ' END AS feature_text
    FROM part
), requests AS (
    SELECT request_id, w1, w2,
           list_filter([trim(x, {WHITE_SQL}) FOR x IN string_split(feature_text, ',')], lambda x: x <> '')
               AS features,
           CASE WHEN size % 10 = 0 THEN NULL ELSE [w2, w1] END AS typed,
           CASE size % 3 WHEN 0 THEN 'categorical' WHEN 1 THEN 'numerical' ELSE 'text' END AS w1_type,
           CASE WHEN size % 11 = 0 THEN '' WHEN size % 5 = 0 THEN w1 ELSE kind END AS label_col,
           CASE WHEN size % 13 = 0 THEN 0.8 ELSE size / 50.0 END AS ratio,
           CASE WHEN size % 4 = 0 THEN [w1, kind] ELSE [w1, w2, kind] END AS columns
    FROM raw
)
"""

ORACLES = {
    "profile": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS row_count, "
        f"CAST((SELECT count(*) FROM (DESCRIBE SELECT * FROM {name})) AS INTEGER) AS column_count"
        for name in PROFILED
    ),
    "csv_roundtrip": f"""
        SELECT * EXCLUDE (o_orderdate), {TIME_SQL.format('o_orderdate')}, true AS date_is_time FROM orders
    """,
    "ingest_parquet": f"SELECT * EXCLUDE (l_shipdate), {TIME_SQL.format('l_shipdate')} FROM lineitem",
    "preview": f"""
        SELECT * EXCLUDE (o_orderdate), {TIME_SQL.format('o_orderdate')} FROM orders ORDER BY o_orderkey LIMIT 10
    """,
    "in_memory_rows": """
        SELECT c_custkey, count(*) OVER nation AS customers, c_acctbal = max(c_acctbal) OVER nation AS is_richest
        FROM customer WINDOW nation AS (PARTITION BY c_nationkey)
    """,
    "ingest_quarantine": """
        WITH lines AS (
            SELECT l_orderkey, l_linenumber, l_returnflag, l_orderkey + l_linenumber AS k,
                   CASE WHEN k % 11 = 0 THEN 'first' ELSE l_linenumber::VARCHAR END AS number,
                   CASE WHEN k % 5 = 0 THEN '' WHEN k % 7 = 0 THEN 'much'
                        ELSE l_extendedprice::DECIMAL(18, 2)::VARCHAR END AS price
            FROM lineitem
        ), told AS (
            SELECT *, CASE WHEN k % 17 = 0 OR k % 13 = 0 THEN 'field_count'
                           WHEN k % 11 = 0 OR (k % 7 = 0 AND k % 5 <> 0) THEN 'wrong_type' END AS why
            FROM lines
        )
        SELECT CASE WHEN why IS NULL THEN l_orderkey END AS l_orderkey,
               CASE WHEN why IS NULL THEN l_linenumber END AS l_linenumber,
               CASE WHEN why IS NULL AND price <> '' THEN price::DOUBLE END AS price,
               CASE WHEN why IS NULL THEN l_returnflag END AS flag,
               CASE WHEN why IS NULL THEN NULL WHEN k % 17 = 0 THEN l_orderkey::VARCHAR
                    ELSE concat_ws(',', l_orderkey, number, price,
                                   l_returnflag || CASE WHEN k % 13 = 0 THEN ',more' ELSE '' END) END AS line,
               why AS reason,
               CASE WHEN why = 'wrong_type' THEN CASE WHEN k % 11 = 0 THEN 'l_linenumber' ELSE 'price' END END
                   AS fault_column
        FROM told
    """,
    "random_split_rows": """
        WITH numbered AS (
            SELECT l_suppkey, l_linenumber, l_returnflag,
                   row_number() OVER (PARTITION BY l_suppkey, l_linenumber, l_returnflag) - 1 AS ordinal,
                   md5(length(l_suppkey::VARCHAR) || ':' || l_suppkey || length(l_linenumber::VARCHAR) || ':'
                       || l_linenumber || length(l_returnflag) || ':' || l_returnflag) AS content
            FROM lineitem
        ), drawn AS (SELECT *, md5('42/' || content || '/' || ordinal) AS digits FROM numbered)
        SELECT l_suppkey, l_linenumber, l_returnflag, ordinal,
               CASE WHEN ('0x' || digits[1:8])::BIGINT < floor(0.8 * 4294967296) THEN 'train' ELSE 'test' END AS split,
               ('0x' || digits[9:16])::BIGINT % 3 AS fold
        FROM drawn
    """,
    "split_missing_keys": """
        SELECT o_orderkey, split AS part, split, coalesce(bucket % 3, 0) AS fold
        FROM (SELECT *, CASE WHEN bucket < 0.8 * 10007 THEN 'train' ELSE 'test' END AS split
              FROM (SELECT o_orderkey, (o_orderkey * 2654435761
                        + CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END * 40503) % 10007 AS bucket
                    FROM orders))
    """,
    "training_set_empty": f"""
        SELECT l_orderkey, 'training_set_empty' AS rule, count(*) AS row_count
        FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER ({TRAIN_SQL}) = 0
    """,
    "random_split_check": """
        SELECT count(*) AS row_count, true AS share_as_asked, 0::BIGINT AS rows_in_both
        FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)
    """,
    "path_parts": """
        SELECT page_id, split_part(replace(replace(url, 'https://', ''), 'http://', ''), '/', 1) AS bucket,
               regexp_extract(regexp_replace(url, '^https?://[^/]*/*', ''), '^[^?#]*') AS object_key
        FROM pages
    """,
    "project_columns": """
        SELECT l_quantity, l_extendedprice, l_returnflag,
               l_quantity * l_extendedprice * (1 - l_discount) AS charge
        FROM lineitem
    """,
    "hash_split": """
        SELECT o_orderkey, bucket, CASE WHEN bucket < 0.8 * 10007 THEN 'train' ELSE 'test' END AS split,
               bucket % 3 AS fold
        FROM (SELECT o_orderkey, (o_orderkey * 2654435761 + o_custkey * 40503) % 10007 AS bucket FROM orders)
    """,
    "split_counts": f"""
        SELECT CASE WHEN {TRAIN_SQL} THEN 'train' ELSE 'test' END AS split, count(*) AS row_count
        FROM lineitem GROUP BY 1
    """,
    "fold_counts": f"""
        SELECT {BUCKET_SQL} % 3 AS fold, count(*) AS row_count FROM lineitem WHERE {TRAIN_SQL} GROUP BY 1
    """,
    "random_split_whole": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
    "spec_parse": REQUESTS_SQL
    + """
        SELECT request_id, array_to_string(features, '|') AS features,
               CASE WHEN typed IS NOT NULL THEN w2 || '=categorical|' || w1 || '=' || w1_type END AS types,
               typed IS NULL AS malformed
        FROM requests
    """,
    "feature_list_texts": f"""
        SELECT doc_id, len(names) AS name_count, array_to_string(names, '|') AS names
        FROM (SELECT doc_id, list_filter([trim(x, {WHITE_SQL}) FOR x IN string_split(text, ',')],
                                         lambda x: x <> '') AS names
              FROM documents)
    """,
    "data_types_events": """
        SELECT event_id, column_name, json_extract_string(props, '$."' || column_name || '"') AS data_type
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS column_name FROM events)
    """,
    "spec_violations": REQUESTS_SQL
    + """
        SELECT request_id, 'features_empty' AS rule, '' AS column_name FROM requests WHERE len(features) = 0
        UNION ALL SELECT request_id, 'label_empty', '' FROM requests WHERE label_col = ''
        UNION ALL SELECT request_id, 'types_empty', '' FROM requests WHERE typed IS NULL
        UNION ALL SELECT request_id, 'split_out_of_range', '' FROM requests WHERE NOT (ratio > 0 AND ratio < 1)
        UNION ALL SELECT request_id, 'label_not_found', label_col FROM requests
                  WHERE label_col <> '' AND NOT list_contains(columns, label_col)
        UNION ALL SELECT request_id, 'feature_not_found', f
                  FROM (SELECT request_id, columns, unnest(features) AS f FROM requests)
                  WHERE NOT list_contains(columns, f)
        UNION ALL SELECT request_id, 'typed_column_not_found', t
                  FROM (SELECT request_id, columns, unnest(typed) AS t FROM requests)
                  WHERE NOT list_contains(columns, t)
        UNION ALL SELECT request_id, 'label_in_features', label_col FROM requests
                  WHERE list_contains(features, label_col)
        UNION ALL SELECT request_id, 'untyped_feature', f
                  FROM (SELECT request_id, typed, w1, w1_type, unnest(features) AS f FROM requests)
                  WHERE typed IS NULL OR (f = w1 AND w1_type = 'text')
    """,
    "feature_order": REQUESTS_SQL
    + """
        , ordered AS (
            SELECT request_id,
                   CASE WHEN w1_type = 'numerical' THEN [w1 || '_imputed', w2 || '_indexed']
                        WHEN w1_type = 'categorical' THEN [w2 || '_indexed', w1]
                        ELSE [w2 || '_indexed'] END AS inputs
            FROM requests WHERE typed IS NOT NULL AND len(features) > 0
        )
        SELECT request_id, generate_subscripts(inputs, 1) - 1 AS pos, unnest(inputs) AS column_name FROM ordered
    """,
    "project_roles": REQUESTS_SQL
    + """
        SELECT request_id, pos, column_name,
               CASE WHEN column_name = label_col THEN 'Label'
                    WHEN list_contains(features, column_name) THEN 'Feature' ELSE 'Ignore' END AS role,
               data_type
        FROM (SELECT request_id, features, label_col, 0::BIGINT AS pos, w2 AS column_name, 'categorical' AS data_type
              FROM requests WHERE typed IS NOT NULL
              UNION ALL
              SELECT request_id, features, label_col, 1, w1, w1_type FROM requests WHERE typed IS NOT NULL)
    """,
    "role_selection": """
        WITH picks AS (
            SELECT user_id, event_type, event_id,
                   CASE event_id % 3 WHEN 0 THEN 'Label' WHEN 1 THEN 'Feature' ELSE 'Ignore' END AS role
            FROM events
        ), last AS (
            SELECT * FROM picks
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1
        )
        SELECT user_id, event_type,
               CASE WHEN role = 'Label' AND EXISTS (
                        SELECT 1 FROM picks p
                        WHERE p.user_id = last.user_id AND p.role = 'Label' AND p.event_id > last.event_id)
                    THEN 'Ignore' ELSE role END AS role
        FROM last
    """,
}
