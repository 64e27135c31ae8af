from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType

from foldboard import RunSpec
from foldboard.plans.spec import CATEGORICAL, NUMERICAL
from foldboard.scratch import scratch_root, written
from foldboard.sources.paths import bucket_of, key_of, object_uri
from foldboard.sources.registry import manifest, model_path
from foldboard.sources.catalogue import chosen_models, publish, published
from foldboard.sources.tables import from_rows, ingest_csv, land_csv, preview, profile, read_csv, read_table, spread

TREES = """height,branches,evergreen,planted

12,31,true pine,1987-04-02
7,,birch,2001-10-19

25,64,true fir,1950-03-30
"""


@pytest.fixture
def trees(tmp_path):
    path = tmp_path / "in" / "trees.csv"
    path.parent.mkdir()
    path.write_text(TREES)
    (path.parent / "notes.txt").write_text("not,a,table\n1,2,3\n")
    return str(path.parent)


def test_inferred_schema_empty_cells_and_blank_lines(spark, trees):
    df = read_csv(spark, trees)
    assert [f.dataType for f in df.schema] == [IntegerType(), IntegerType(), StringType(), DateType()]
    assert [r["branches"] for r in df.orderBy("height").collect()] == [None, 31, 64]
    assert profile(df).first().asDict() == {"row_count": 3, "column_count": 4}
    spec = RunSpec(["evergreen"], "height", {"evergreen": CATEGORICAL, "branches": NUMERICAL})
    assert spec.violations(df.schema) == []


def test_given_schema(spark, trees):
    df = read_csv(spark, trees, "height double, branches bigint, evergreen string, planted date")
    assert df.agg(F.sum("height")).first()[0] == 44.0


@pytest.mark.parametrize("schema", [None, "a int"])
def test_other_suffixes_are_refused(spark, tmp_path, schema):
    (tmp_path / "rows.txt").write_text("a\n1\n")
    with pytest.raises(ValueError, match="no .csv file"):
        read_csv(spark, str(tmp_path), schema)


def test_landing_gives_every_upload_its_own_place(spark, trees, tmp_path):
    first, second = (ingest_csv(spark, trees, str(tmp_path / "lake")) for _ in range(2))
    assert first != second
    assert read_table(spark, first).count() == 3


def test_preview(spark):
    df = spark.range(100).select(F.col("id").alias("n"))
    assert [r["n"] for r in preview(df, order_by=["n"]).collect()] == list(range(10))
    assert preview(df, 3).count() == 3


def test_rows_in_memory(spark):
    df = from_rows(spark, [(1.0, 2.0), (2.0, 3.0)], ["feature", "label"])
    assert df.columns == ["feature", "label"] and df.count() == 2


def test_paths(spark):
    uris = [
        "s3a://bucket/in/1/tree list.csv", "s3a://bucket", "plain/key", "http://h.example//a/b?x=1#y",
        object_uri("bucket", "/models/1/Linear Regression"),
    ]
    df = spark.createDataFrame([(u,) for u in uris], "uri string")
    found = [tuple(r) for r in df.select(bucket_of(F.col("uri")), key_of(F.col("uri"))).collect()]
    assert found == [
        ("bucket", "in/1/tree list.csv"), ("bucket", ""), ("", "plain/key"), ("h.example", "a/b"),
        ("bucket", "models/1/Linear Regression"),
    ]


def test_model_paths_are_fresh_and_without_blanks():
    first, second = (model_path("root/", "Linear Regression") for _ in range(2))
    assert first != second and first.startswith("root/models/") and first.endswith("/linear-regression")


def test_manifest(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "model" / "data"))
    assert manifest(spark, str(tmp_path / "model")).columns == ["path", "length", "modificationTime"]
    with pytest.raises(FileNotFoundError):
        manifest(spark, str(tmp_path / "nothing"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        manifest(spark, str(tmp_path / "empty"))


def test_spread_uses_all_cores_and_leaves_large_tables_alone(spark):
    assert spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == 8
    many = spark.range(10, numPartitions=20)
    assert spread(many) is many


def test_written_tables_lie_in_the_shared_folder(spark):
    df = written(spark.range(4).toDF("n"), "numbers")
    assert all(scratch_root(spark).removeprefix("file:") in f for f in df.inputFiles())
    assert df.count() == 4


BROKEN = """height,branches,evergreen
12,31,true pine

seven,4,birch
8,,"oak, tall"
9,5
10,many,elm
11,6,ash,extra
x,y,z
"""


def test_broken_lines_are_set_aside(spark, tmp_path):
    path = tmp_path / "trees.csv"
    path.write_text(BROKEN)
    landing = land_csv(spark, str(path), str(tmp_path / "lake"), "height int, branches int, evergreen string")
    assert sorted(map(tuple, landing.rows(spark).collect())) == [(8, None, "oak, tall"), (12, 31, "true pine")]
    assert sorted(map(tuple, landing.rejected(spark).collect()), key=str) == [
        ("10,many,elm", "wrong_type", "branches"),
        ("11,6,ash,extra", "field_count", None),
        ("9,5", "field_count", None),
        ("seven,4,birch", "wrong_type", "height"),
        ("x,y,z", "wrong_type", "height"),
    ]


def test_landing_without_broken_lines_and_without_rows(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("a\n1\n")
    bad.write_text("a\nno\n")
    landings = [land_csv(spark, str(p), str(tmp_path / "lake"), "a int") for p in (good, bad)]
    assert landings[0].path != landings[1].path
    assert [(x.rows(spark).count(), x.rejected(spark).count()) for x in landings] == [(1, 0), (0, 1)]
    with pytest.raises(ValueError, match="no .csv file"):
        land_csv(spark, str(tmp_path / "lake"), str(tmp_path / "lake"), "a int")
    with pytest.raises(ValueError, match="cannot have columns named line"):
        land_csv(spark, str(good), str(tmp_path / "lake"), "line int")


def runs(spark, *rows):
    schema = "dataset string, run_id string, finished_at timestamp, model string, rmse double, is_best boolean"
    named = spark.createDataFrame(rows, schema)
    return named.withColumns({"r2": F.lit(0.5), "avg_cv_rmse": F.lit(1.0), "model_path": F.concat_ws("/", "run_id", "model")})


def test_publishing_twice_gives_one_run(spark, tmp_path):
    root = str(tmp_path)
    early, late = datetime(2024, 1, 1), datetime(2024, 6, 1)
    assert chosen_models(spark, root).count() == published(spark, root).count() == 0
    first = runs(spark, ("d", "a", early, "m1", 1.0, True), ("d", "a", early, "m2", 2.0, False))
    for _ in range(2):
        publish(first, root)
    publish(runs(spark, ("d", "b", late, "m1", 3.0, True), ("e", "c", late, "m2", 9.0, True)), root)
    assert published(spark, root).count() == 4
    chosen = lambda: {
        (r["dataset"], r["kind"]): (r["run_id"], r["rmse"], r["model_path"]) for r in chosen_models(spark, root).collect()
    }
    assert chosen() == {
        ("d", "latest"): ("b", 3.0, "b/m1"),
        ("d", "best"): ("a", 1.0, "a/m1"),
        ("e", "latest"): ("c", 9.0, "c/m2"),
        ("e", "best"): ("c", 9.0, "c/m2"),
    }
    # A run with other models takes the place of what it had; until its marker is there it is not read.
    again = runs(spark, ("d", "a", early, "m3", 0.5, True))
    publish(again, root, finished=False)
    assert chosen()["d", "best"] == ("b", 3.0, "b/m1")
    publish(again, root)
    assert chosen()["d", "best"] == ("a", 0.5, "a/m3")
    # Ties: the later run id is the latest, the earlier one the best; a run without a winner is none.
    publish(runs(spark, ("e", "a", late, "m9", 9.0, True), ("e", "z", datetime(2025, 1, 1), "m9", 1.0, False)), root)
    assert (chosen()["e", "latest"][0], chosen()["e", "best"][0]) == ("c", "a")
