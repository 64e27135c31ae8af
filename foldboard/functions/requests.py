"""Run requests as tables: parsing, checking and ordering them, one row per request.

A request has ``feature_cols array<string>``, ``label_col string``,
``data_types map<string,string>``, ``train_test_split double`` and, for checking,
``columns array<string>``, the columns its data set really has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldboard.operators.features import IMPUTED_SUFFIX, INDEXED_SUFFIX
from foldboard.operators.split import DEFAULT_RATIO

# Blanks around the names in a comma list: all that ``str.strip`` removes.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Rules that a run may choose to pass over.
LENIENT_RULES = ("label_in_features", "untyped_feature")


def parse_feature_list(text: Column) -> Column:
    """Names in a comma list, trimmed, blanks dropped."""
    names = F.transform(F.split(text, ",", -1), lambda name: F.btrim(name, F.lit(BLANKS)))
    return F.filter(names, lambda name: name != "")


def parse_data_types(text: Column) -> Column:
    """Logical type per column from a JSON object; NULL if it is none."""
    strict = {"allowSingleQuotes": "false"}
    # The parser stops at the end of a value and would accept any text behind it.
    # Inside brackets such text is an error; stray closing signs fit only one kind.
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string,string>>", strict)
    keyed = F.from_json(
        F.concat(F.lit('{"types":'), text, F.lit("}")), "map<string,map<string,string>>", strict
    )
    parsed = F.when(keyed.isNotNull() & (F.size(listed) == 1), listed[0])

    def without_repeats(types: Column) -> Column:
        # A repeated name keeps its first place and its last value. Only then are
        # the entries gone through again for each name.
        keys = F.map_keys(types)
        names = F.array_distinct(keys)
        settled = F.map_from_arrays(names, F.transform(names, lambda name: _last_value(types, name)))
        return F.when(F.size(names) == F.size(keys), types).otherwise(settled)

    # A one-element transform names the parsed object, so that it is parsed once.
    return F.element_at(F.transform(F.array(parsed), without_repeats), 1)


def _last_value(types: Column, name: Column) -> Column:
    same = F.filter(F.map_entries(types), lambda entry: entry["key"] == name)
    return F.element_at(same, -1)["value"]


def request_violations(requests: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, rule, column_name)``: one row for everything wrong with a request."""
    features, label, types = F.col("feature_cols"), F.col("label_col"), F.col("data_types")
    columns = F.col("columns")
    typed = F.coalesce(F.map_keys(types), F.array().cast("array<string>"))
    ratio = F.coalesce("train_test_split", F.lit(DEFAULT_RATIO))
    known = F.map_filter(types, lambda _, kind: kind.isin("numerical", "categorical"))
    usable = F.coalesce(F.map_keys(known), F.array().cast("array<string>"))

    def overall(rule: str, broken: Column) -> Column:
        return named(rule, F.when(broken, F.array(F.lit(""))))

    def named(rule: str, names: Column) -> Column:
        names = F.coalesce(names, F.array().cast("array<string>"))
        return F.transform(
            names, lambda c: F.struct(F.lit(rule).alias("rule"), c.alias("column_name"))
        )

    no_label = F.coalesce(label, F.lit("")) == ""
    found = F.concat(
        overall("features_empty", F.coalesce(F.size(features), F.lit(0)) <= 0),
        overall("label_empty", no_label),
        overall("types_empty", F.size(typed) == 0),
        overall("split_out_of_range", ~((ratio > 0) & (ratio < 1))),
        named("label_not_found", F.when(~no_label, F.array_except(F.array(label), columns))),
        named("feature_not_found", F.array_except(features, columns)),
        named("typed_column_not_found", F.array_except(typed, columns)),
        named("label_in_features", F.array_intersect(F.array(label), features)),
        named("untyped_feature", F.array_except(features, usable)),
    )
    return requests.select(*keys, F.inline(found))


def request_feature_order(requests: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, pos, column_name)``: inputs of the feature vector, in order.

    ``string_cols array<string>`` names the columns that hold strings.
    """
    types, features, strings = F.col("data_types"), F.col("feature_cols"), F.col("string_cols")

    def of_type(kind: str) -> Column:
        names = F.map_keys(F.map_filter(types, lambda _, value: value == kind))
        return F.array_intersect(names, features)

    numericals = F.transform(of_type("numerical"), lambda c: F.concat(c, F.lit(IMPUTED_SUFFIX)))
    categoricals = F.transform(
        of_type("categorical"),
        lambda c: F.when(F.array_contains(strings, c), F.concat(c, F.lit(INDEXED_SUFFIX))).otherwise(c),
    )
    return requests.select(
        *keys, F.posexplode(F.concat(numericals, categoricals)).alias("pos", "column_name")
    )


def roles_of_requests(requests: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, pos, column_name, role, data_type)`` for every typed column of a request."""
    role = (
        F.when(F.col("column_name") == F.col("label_col"), "Label")
        .when(F.array_contains("feature_cols", F.col("column_name")), "Feature")
        .otherwise("Ignore")
    )
    return requests.select(
        *keys, "feature_cols", "label_col", F.posexplode("data_types").alias("pos", "column_name", "data_type")
    ).select(*keys, "pos", "column_name", role.alias("role"), "data_type")


def settle_roles(
    selections: DataFrame, request: str, column: str, role: str, order: Column
) -> DataFrame:
    """``(request, column, role)`` after a log of role selections.

    A column keeps its last selected role, except that a label gives way to a
    label picked later for another column of the request. ``order`` is a number,
    unique within a request. Both aggregations combine before they shuffle, so
    a request with very many selections is not gathered in one place.
    """
    # Roles travel as numbers: a string in an aggregation buffer would force a sort.
    code = F.when(F.col(role) == "Label", 2).when(F.col(role) == "Feature", 1).otherwise(0)
    picks = selections.select(
        F.col(request), F.col(column), code.alias("_role"), order.alias("_order")
    )
    last = picks.groupBy(request, column).agg(
        F.max_by("_role", "_order").alias("_role"), F.max("_order").alias("_order")
    )
    labels = (
        picks.filter("_role = 2").groupBy(request).agg(F.max("_order").alias("_last_label"))
    )
    outdated = (F.col("_role") == 2) & (F.col("_order") < F.col("_last_label"))
    settled = F.when(outdated, "Ignore").when(F.col("_role") == 2, "Label").when(
        F.col("_role") == 1, "Feature"
    )
    return last.join(labels, request, "left").select(
        request, column, F.coalesce(settled, F.lit("Ignore")).alias("role")
    )
