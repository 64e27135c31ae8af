import json
import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foldboard import RunSpec
from foldboard.functions.requests import (
    parse_data_types,
    parse_feature_list,
    request_feature_order,
    request_violations,
    settle_roles,
)
from foldboard.operators.features import FEATURES, plan_features, preprocessing

SCHEMA = "a double, n int, s string, b boolean, d date, label double, text_label string"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            (1.0, 1, "x", True, None, 1.0, "low"),
            (None, 2, "y", False, None, 2.0, "high"),
            (math.nan, None, None, True, None, 3.0, None),
            (4.0, 4, "x", False, None, 4.0, "low"),
        ],
        SCHEMA,
    )


def types(**kinds):
    return {c: {"n": "numerical", "c": "categorical"}.get(k, k) for c, k in kinds.items()}


@pytest.mark.parametrize(
    "spec, expected",
    [
        (RunSpec(["a"], "label", types(a="n")), []),
        (RunSpec([], "", {}), [("features_empty", ""), ("label_empty", ""), ("types_empty", "")]),
        (RunSpec(["a"], "label", types(a="n"), 1.0), [("split_out_of_range", "")]),
        (
            RunSpec(["zz"], "yy", types(zz="n")),
            [("label_not_found", "yy"), ("feature_not_found", "zz"), ("typed_column_not_found", "zz")],
        ),
        (
            RunSpec(["a", "label"], "label", types(a="n", label="n")),
            [("label_in_features", "label")],
        ),
        (RunSpec(["a", "n"], "label", types(a="n", n="text")), [("untyped_feature", "n")]),
    ],
)
def test_single_runs_and_request_tables_agree(spark, rows, spec, expected):
    assert spec.violations(rows.schema) == expected
    request = spark.createDataFrame(
        [(1, list(spec.feature_cols), spec.label_col, dict(spec.data_types), spec.train_test_split, rows.columns)],
        "id int, feature_cols array<string>, label_col string, data_types map<string,string>, "
        "train_test_split double, columns array<string>",
    )
    found = [(r["rule"], r["column_name"]) for r in request_violations(request, "id").collect()]
    assert sorted(found) == sorted(expected)


@pytest.mark.parametrize(
    "spec, rule",
    [
        (RunSpec(["s"], "label", types(s="n")), "numerical_not_numeric"),
        (RunSpec(["b"], "label", types(b="n")), "numerical_not_numeric"),
        (RunSpec(["d"], "label", types(d="c")), "categorical_unsupported"),
        (RunSpec(["a"], "d", types(a="n")), "label_unsupported"),
    ],
)
def test_physical_types(rows, spec, rule):
    assert rule in [v[0] for v in spec.violations(rows.schema)]
    with pytest.raises(ValueError, match=rule):
        spec.require(rows.schema)


def test_lenient_runs_pass_over_untyped_features(rows):
    spec = RunSpec(["a", "n"], "label", types(a="n"))
    with pytest.raises(ValueError, match="untyped_feature n"):
        spec.require(rows.schema)
    spec.require(rows.schema, strict=False)
    assert plan_features(spec.feature_cols, "label", spec.data_types, rows.schema).numericals == ("a",)


def test_roles():
    spec = RunSpec.from_roles({"a": "Feature", "s": "Feature", "label": "Label", "d": "Ignore"}, {"s": "categorical"})
    assert (list(spec.feature_cols), spec.label_col, spec.train_test_split) == (["a", "s"], "label", 0.8)
    assert spec.data_types == {"a": "numerical", "s": "categorical", "label": "numerical", "d": "numerical"}


def test_a_later_label_replaces_the_earlier_one(spark):
    picks = [(1, "a", "Label"), (2, "b", "Label"), (3, "b", "Feature"), (4, "c", "Label"), (5, "c", "Label")]
    df = spark.createDataFrame(picks, "seq int, col string, role string").withColumn("run", F.lit("r"))
    found = {r["col"]: r["role"] for r in settle_roles(df, "run", "col", "role", F.col("seq")).collect()}
    assert found == {"a": "Ignore", "b": "Feature", "c": "Label"}


def test_parsing(spark):
    texts = [
        (" a, b ,,\tc\n,", '{"a": "numerical", "b": "x", "a": "categorical"}'),
        ("", "{'a': 'x'}"),
        (" , ", '{"a": '),
        ("é, z", "[1]"),
        ("a", '{"a": "x"} and more'),
        ("a", '{"a": "x"}] ['),
        ("a", '{"a": "x"}} {'),
        ("a", '{"a": "x"}, {"b": "y"}'),
        ("a", ""),
        ("a", ' {"a": 1, "b": null} '),
    ]
    df = spark.createDataFrame(texts, "names string, types string")
    found = df.select(parse_feature_list(F.col("names")), parse_data_types(F.col("types"))).collect()
    assert [r[0] for r in found] == [["a", "b", "c"], [], [], ["é", "z"]] + [["a"]] * 6
    assert [r[1] for r in found] == [{"a": "categorical", "b": "x"}] + [None] * 8 + [{"a": "1", "b": None}]


def test_vector_order(spark, rows):
    """Numericals first, both groups in the order of the types; only strings are indexed."""
    data_types = types(s="c", n="c", a="n", b="c", label="n")
    plan = plan_features(["b", "a", "n", "s"], "label", data_types, rows.schema)
    assert plan.assembler_inputs == ["a_imputed", "s_indexed", "n", "b"]
    assert plan.source_columns == ["a", "s", "n", "b", "label"]
    request = spark.createDataFrame(
        [(["b", "a", "n", "s"], json.dumps(data_types), ["s"])],
        "feature_cols array<string>, types_text string, string_cols array<string>",
    ).withColumn("data_types", parse_data_types(F.col("types_text")))
    ordered = request_feature_order(request).orderBy("pos").collect()
    assert [r["column_name"] for r in ordered] == plan.assembler_inputs


def transformed(rows, features, label, data_types):
    plan = plan_features(features, label, data_types, rows.schema)
    return preprocessing(plan).fit(rows).transform(rows), plan


def test_imputation_of_doubles_and_integers(rows):
    df, _ = transformed(rows, ["a", "n"], "label", types(a="n", n="n"))
    assert [r["a_imputed"] for r in df.orderBy("label").collect()] == [1.0, 2.5, 2.5, 4.0]
    # The mean 7/3 loses its fraction in an integer column.
    assert [r["n_imputed"] for r in df.orderBy("label").collect()] == [1, 2, 2, 4]


def test_string_label_and_constant_feature(rows):
    constant = rows.withColumn("a", F.lit(3.0))
    df, plan = transformed(constant, ["a", "s"], "text_label", types(a="n", s="c"))
    assert plan.label == "text_label_indexed_label_for_regression"
    assert [r[plan.label] for r in df.orderBy("label").collect()] == [0.0, 1.0, 2.0, 0.0]
    assert [r[0] for r in df.select(vector_to_array(FEATURES)[0]).collect()] == [0.0] * 4


def test_missing_number_in_a_categorical_is_an_error(rows):
    with pytest.raises(Exception, match="null|NULL|NaN"):
        transformed(rows, ["n"], "label", types(n="c"))[0].collect()


def test_many_categories_need_no_bins(spark, sf_dir):
    """Scaling drops the category metadata, so trees take any number of categories."""
    from pyspark.ml.regression import DecisionTreeRegressor

    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_name", "p_retailprice")
    df, _ = transformed(parts, ["p_name"], "p_retailprice", types(p_name="c"))
    DecisionTreeRegressor(labelCol="p_retailprice").fit(df)


def test_requests_and_forms():
    request = RunSpec.from_request({"key": "k", "feature_cols": ["a"], "label_col": "l", "data_types": types(a="n")})
    form = RunSpec.from_form(" a , ,", " l ", '{"a": "numerical"}')
    assert request == form == RunSpec(["a"], "l", types(a="n"), 0.8)
    for text in ("{", "[1]"):
        with pytest.raises(ValueError, match="data_types"):
            RunSpec.from_form("a", "l", text)


def test_thousands_of_names_in_one_request(spark):
    """Parsing and checking grow with the names, not with their square."""
    names = [f"column{k}" for k in range(5_000)]
    kinds = {n: "numerical" if k % 2 else "categorical" for k, n in enumerate(names)}
    request = spark.createDataFrame(
        [(1, ",".join(names), json.dumps(kinds), "label", 0.5, [*names, "label"], names[:10])],
        "id int, feature_text string, types_text string, label_col string, train_test_split double, "
        "columns array<string>, string_cols array<string>",
    ).withColumns(
        {
            "feature_cols": parse_feature_list(F.col("feature_text")),
            "data_types": parse_data_types(F.col("types_text")),
        }
    )
    assert request_violations(request, "id").isEmpty()
    assert request_feature_order(request, "id").count() == 5_000


def test_null_ratio_is_the_default():
    spec = RunSpec.from_request({"feature_cols": ["a"], "train_test_split": None, "data_types": None})
    assert spec.train_test_split == 0.8 and spec.data_types == {}
