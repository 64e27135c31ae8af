"""Benchmark passages in documents, by a prefix-filtered set join.

The sets are windows: 13 consecutive words of an item, or all words of a shorter item. A window occurs only where its
rarest word occurs, and for exact containment this prefix of one is all that is necessary. So words are ordered by
their counts over all documents, document words are joined with windows on the rarest word, the place of that word
in the window fixes where the window would start (positional bound) and that it must fit into the document (length bound),
and what is left is compared word by word. Document words never leave their row before they are verified:
only places of real occurrences are shuffled.

The benchmark side is broadcast in blocks of at most BLOCK_BYTES, as many as it needs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldboard.llm.common import col, lower_ascii, table
from foldboard.scratch import written

WINDOW = 13
NO_TERM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What of the benchmark one join broadcasts, in bytes of its words.
BLOCK_BYTES = 32 << 20


def term_array(text: Column) -> Column:
    """Runs of letters and digits, A-Z in lower case."""
    return F.array_remove(F.split(lower_ascii(text), NO_TERM), "")


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct (item, words) of all windows; an item without id is named by empty text."""
    words = term_array(F.coalesce(col(text_col), F.lit("")))
    items = benchmark.select(
        F.coalesce(col(item_col).cast("string"), F.lit("")).alias("item"), words.alias("all")
    ).filter(F.size("all") > 0)
    last = F.greatest(F.size("all") - window + 1, F.lit(1))
    starts = items.select("item", "all", F.explode(F.sequence(F.lit(1), last)).alias("at"))
    return starts.select("item", F.slice("all", F.col("at"), window).alias("words")).distinct()


def blocks(df: DataFrame, size: Column, key: str) -> list[DataFrame]:
    """``df`` in parts of at most about BLOCK_BYTES, split by a hash of ``key``."""
    total = df.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    n = total // BLOCK_BYTES + 1
    part = F.pmod(F.xxhash64(key), F.lit(n))
    return [df.filter(part == k) if n > 1 else df for k in range(n)]


def with_rarest_word(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """Windows with their rarest word over ``docs`` (column words) and its first place, from 0."""
    vocabulary = written(
        windows.select(F.explode("words").alias("word")).distinct(), "benchmark-words"
    )
    tokens = docs.select(F.explode("words").alias("word"))
    counted = [
        tokens.join(F.broadcast(part), "word", "left_semi").groupBy("word").count()
        for part in blocks(vocabulary, F.octet_length("word") + 16, "word")
    ]
    counts = reduce(DataFrame.unionByName, counted)
    spread = windows.select("item", "words", F.posexplode("words").alias("place", "word"))
    return (
        spread.join(counts, "word", "left")
        .groupBy("item", "words")
        .agg(
            F.min(
                F.struct(F.coalesce("count", F.lit(0)).alias("count"), "word", "place")
            ).alias("rarest")
        )
        # A word that no document has rules its windows out.
        .filter("rarest.count > 0")
        .select("item", "words", "rarest.word", "rarest.place")
    )


def occurrences(docs: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct (keys, start, length, item) of all windows in ``docs`` (column words)."""
    tokens = docs.select(*keys, "words", F.posexplode("words").alias("_at", "_word"))
    length = F.size("_window")
    found = []
    size = F.octet_length(F.concat_ws(" ", "words")) + 16 * F.size("words") + 64
    for part in blocks(windows, size, "word"):
        prefix = part.select(
            F.col("word").alias("_word"), "place", F.col("words").alias("_window"), "item"
        )
        start = F.col("_at") - F.col("place")
        found.append(
            tokens.join(F.broadcast(prefix), "_word")
            .filter((start >= 0) & (start + length <= F.size("words")))
            .filter(F.slice("words", start + 1, length) == F.col("_window"))
            .select(*keys, start.alias("start"), length.alias("length"), "item")
        )
    return reduce(DataFrame.unionByName, found).distinct()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, _hash of the text, n_words, n_hit, items (sorted ids as text).

    Missing and empty texts have no words. Rows with equal id and text share what is found in them, and each gets its
    row; ids may be missing. Repeated items and windows count once. Empty tables on either side give no hits. Other columns
    are ignored.
    """
    keys = ["doc_id", "_hash"]
    split = docs.select(
        col(id_col).alias("doc_id"),
        F.xxhash64(col(text_col)).alias("_hash"),
        term_array(F.coalesce(col(text_col), F.lit(""))).alias("words"),
    )
    plain = item_windows(benchmark, item_col, item_text_col, window)
    windows = written(with_rarest_word(plain, split), "windows")
    hits = written(occurrences(split, windows, keys), "occurrences")
    # Union of the intervals: what a window adds beyond all that started before it.
    before = (
        Window.partitionBy(*keys)
        .orderBy("start", "length")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    end = F.col("start") + F.col("length")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    added = F.greatest(end - F.greatest("start", reached), F.lit(0))
    words_hit = (
        hits.select(*keys, "start", "length")
        .distinct()
        .select(*keys, added.alias("added"))
        .groupBy(*keys)
        .agg(F.sum("added").alias("n_hit"))
    )
    items = (
        hits.select(*keys, "item")
        .distinct()
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    per_doc = words_hit.join(items, _same(words_hit, items, keys)).select(
        words_hit["doc_id"], words_hit["_hash"], "n_hit", "items"
    )
    rows = split.select(*keys, F.size("words").cast("long").alias("n_words"))
    return rows.join(per_doc, _same(rows, per_doc, keys), "left").select(
        rows["doc_id"],
        rows["_hash"],
        "n_words",
        F.coalesce(per_doc["n_hit"], F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(per_doc["items"], F.array().cast("array<string>")).alias("items"),
    )


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def contaminated() -> Column:
    """A twentieth of the words or more is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    # What is dropped is found first; most documents never take part in a shuffle of texts.
    dirty = (
        contamination(docs, benchmark)
        .filter(contaminated())
        .select(F.col("doc_id").alias("_dirty_id"), F.col("_hash").alias("_dirty_hash"))
        .distinct()
    )
    dirty = written(dirty, "contaminated")
    same = docs["doc_id"].eqNullSafe(dirty["_dirty_id"]) & (
        F.xxhash64(docs["text"]) == dirty["_dirty_hash"]
    )
    return docs.join(dirty, same, "left_anti")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


CONTAMINATION_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, array_to_string(w[i:i + {WINDOW} - 1], ' ') AS gram,
    least(len(w), {WINDOW}) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW} + 2, 2))) AS i
        FROM items WHERE len(w) > 0)),
places AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM texts, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT r, i, places.n, item FROM places JOIN windows USING (gram, n)),
words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM texts LEFT JOIN words USING (r) LEFT JOIN listed USING (r)"""

QUERIES = {"op10_decontamination": op10_decontamination}
ORACLES = {"op10_decontamination": CONTAMINATION_SQL}
