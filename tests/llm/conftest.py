import pytest

#: Names that the operators use themselves, as columns of the input.
CLASHES = "score string, key string, class string, words string, bytes string, weight string, item string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Missing ids, texts and sources, empty and very long texts, copies, repeated rows, clashing columns."""
    plain = " ".join(f"word{k}" for k in range(60)) + "."
    long = " ".join(f"w{k % 977}x{k}" for k in range(40_000))
    blob = "y" * 100_000
    rows = [
        (1, plain, "en", "a"),
        (2, plain, "en", "a"),
        (3, None, "en", None),
        (4, "", None, "a"),
        (4, "", None, "a"),
        (None, "one two", "de", "b"),
        (None, None, None, None),
        (6, long, "en", "b"),
        (7, blob, "en", "b"),
        (8, plain + " and", "fr", "a"),
        (8, " \n\n ", "fr", "a"),
    ]
    clash = ("x",) * 7
    return spark.createDataFrame(
        [(*r, len(r[1] or ""), *clash) for r in rows],
        f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}",
    )


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="module")
def sparse(spark):
    """Operators of many small jobs run with few partitions in a module that asks for it, and in no other."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
