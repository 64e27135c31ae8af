"""Recurring lines found by a log-template tree.

A line goes down a tree of fixed depth: by its number of tokens, then by its leading tokens, where a token with a digit
counts as a variable field. In a leaf a token stays constant if enough line-document pairs have it at its place; all others
become variable fields. Constants and fields together are the template of a line. Lines are dropped if their template has
mostly constants and occurs in enough different texts, so a banner with a changing name or date goes like one that
never changes.

Texts are parsed once. What follows is kept small by a bound: lines of one template agree on all but a quarter of their tokens,
so if a line is cut into one piece more than it may have fields, one of its pieces stands at the same place in all of them.
Only lines with such a piece that recurs (candidates) are taken apart. Support from the other lines of a leaf matters only
where a recurring template has a field, and is counted there alone, so the result is that of counting all tokens.
Pieces and tokens are aggregated as hashes or after a semi-join; texts are shuffled once, to put together what remains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.llm.common import col, table
from foldboard.scratch import discard, scratch_path, written

LEADING = 2
FIELD = "<*>"
#: A token with a digit, matched from its start only.
NUMBERED = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
#: Blanks within a line, other than the common one.
OTHER_BLANKS = "\t\x0b\x0c\r"
MIN_DOCS = 5
#: Templates need so many constants, and so large a share of them in percent.
MIN_CONSTANTS, CONSTANT_PERCENT = 4, 75
#: Keys of 16 bytes that may be broadcast; more of them are joined by shuffle.
BROADCAST_KEYS = 1_000_000


def plain_blanks(text: Column) -> Column:
    """All blanks but line feeds as spaces."""
    other = F.lit(False)
    for blank in OTHER_BLANKS:
        other |= F.contains(text, F.lit(blank))
    return F.when(other, F.translate(text, OTHER_BLANKS, " " * len(OTHER_BLANKS))).otherwise(text)


def masked(line: Column) -> Column:
    """The line with variable fields for tokens that have a digit."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, NUMBERED, FIELD)).otherwise(line)


def tokens(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def parsed(docs: DataFrame) -> DataFrame:
    """(doc, at, length, leaf, shape, line) of every line; ``length`` is its number of tokens and ``line`` is masked.

    ``doc`` is a hash of the text, ``shape`` one of the line's tokens. Lines too short for a template are still in it:
    a filter here would split every line twice.
    """
    lines = docs.select("doc", F.posexplode(F.split(plain_blanks(F.col("text")), "\n")).alias("at", "line"))
    lines = lines.select("doc", "at", masked(F.col("line")).alias("line"))
    lines = lines.select("doc", "at", "line", tokens(F.col("line")).alias("tokens"))
    leading = [F.get("tokens", F.lit(k)) for k in range(LEADING)]
    return lines.select(
        "doc",
        "at",
        F.size("tokens").alias("length"),
        F.xxhash64(F.size("tokens"), *leading).alias("leaf"),
        F.xxhash64("tokens").alias("shape"),
        "line",
    )


def pieces(leaf: Column, words: Column) -> Column:
    """Hashes of the pieces of a line, by their places; pieces with a field are left out.

    There is one piece more than a template of this length may have fields. The leading tokens are in the leaf.
    """
    length = F.size(words)
    constants = F.greatest(F.lit(MIN_CONSTANTS), F.ceil(length * CONSTANT_PERCENT / 100).cast("int"))
    number = length - constants + 1
    rest = length - LEADING

    def piece(k: Column) -> Column:
        start, end = (F.floor(rest * (k + more) / number).cast("int") for more in (0, 1))
        part = F.slice(words, start + LEADING + 1, end - start)
        return F.when(~F.array_contains(part, FIELD), F.xxhash64(leaf, k, part))

    return F.array_compact(F.transform(F.sequence(F.lit(0), number - 1), piece))


def few(keys: DataFrame) -> bool:
    return keys.count() <= BROADCAST_KEYS


def maybe_broadcast(keys: DataFrame) -> DataFrame:
    """``keys`` (already written), marked for broadcast while their number is small."""
    return F.broadcast(keys) if few(keys) else keys


def candidates(lines: DataFrame, min_docs: int) -> DataFrame:
    """(leaf, shape) of the lines with a piece that recurs. Copies count here too, so these are never too few."""
    leaves = lines.groupBy("leaf").count().filter(F.col("count") >= min_docs).select("leaf")
    leaves = written(leaves, "leaves")
    # Beyond what can be broadcast the pieces alone decide; they hold the leaf.
    inside = lines.join(F.broadcast(leaves), "leaf", "left_semi") if few(leaves) else lines
    words = inside.select("leaf", "shape", tokens(F.col("line")).alias("tokens"))
    cut = words.select("leaf", "shape", pieces(F.col("leaf"), F.col("tokens")).alias("pieces"))
    path = scratch_path(lines.sparkSession, "line-pieces")
    cut.write.parquet(path)
    cut = lines.sparkSession.read.schema(cut.schema).parquet(path)
    cut = cut.select("leaf", "shape", F.explode("pieces").alias("piece"))
    often = cut.groupBy("piece").count().filter(F.col("count") >= min_docs).select("piece")
    often = maybe_broadcast(written(often, "often"))
    found = written(cut.join(often, "piece", "left_semi").select("leaf", "shape").distinct(), "candidates")
    discard(lines.sparkSession, path)
    return found


def generalised(words: DataFrame, constant: Column) -> DataFrame:
    """(leaf, shape, template, constants, length) from (leaf, shape, place, token) rows."""
    part = F.struct("place", F.when(constant, F.col("token")).otherwise(FIELD).alias("token"))
    return words.groupBy("leaf", "shape").agg(
        F.array_join(F.sort_array(F.collect_list(part))["token"], " ").alias("template"),
        F.count_if(constant).alias("constants"),
        F.count("*").alias("length"),
    )


def in_texts(templates: DataFrame, places: DataFrame, min_docs: int) -> DataFrame:
    """(leaf, shape, template, texts) of templates that ``min_docs`` texts have."""
    templates = templates.select("leaf", "shape", "template", F.xxhash64("template").alias("t"))
    texts = (
        places.join(templates.select("leaf", "shape", "t"), ["leaf", "shape"])
        .select("leaf", "t", "doc")
        .distinct()
        .groupBy("leaf", "t")
        .agg(F.count("*").alias("texts"))
        .filter(F.col("texts") >= min_docs)
    )
    return templates.join(texts, ["leaf", "t"]).select("leaf", "shape", "template", "texts")


def recurring_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(leaf, shape, template, texts): lines, as ``parsed`` gives them, of templates that ``min_docs`` different texts have."""
    lines = lines.filter(F.col("length") >= MIN_CONSTANTS)
    chosen = candidates(lines, min_docs)
    own = maybe_broadcast(chosen)
    # Copies of a text, and repeated lines in a text, count once.
    places = lines.select("leaf", "shape", "doc").join(own, ["leaf", "shape"], "left_semi").distinct()
    places = written(places, "line-places")
    shapes = places.groupBy("leaf", "shape").agg(F.count("*").alias("n"))
    worded = (
        lines.select("leaf", "shape", "line")
        .join(own, ["leaf", "shape"], "left_semi")
        .groupBy("leaf", "shape")
        .agg(F.first("line").alias("line"))
        .join(shapes, ["leaf", "shape"])
    )
    split = F.posexplode(tokens(F.col("line"))).alias("place", "token")
    words = written(worded.select("leaf", "shape", "n", split), "line-tokens")
    key = ["leaf", "place", "token"]
    support = words.filter(F.col("token") != FIELD).groupBy(*key).agg(F.sum("n").alias("support"))
    words = written(words.drop("n").join(support, key, "left"), "line-support")
    templates = (
        generalised(words, F.coalesce(F.col("support") >= min_docs, F.lit(False)))
        .filter(F.col("constants") >= MIN_CONSTANTS)
        .filter(100 * F.col("constants") >= CONSTANT_PERCENT * F.col("length"))
    )
    first = written(in_texts(written(templates, "templates"), places, min_docs), "first-templates")

    # Tokens in the fields of these templates that other lines of the leaf may make constant.
    words = words.join(maybe_broadcast(first.select("leaf", "shape")), ["leaf", "shape"], "left_semi")
    unsure = words.filter((F.col("token") != FIELD) & (F.col("support") < min_docs))
    unsure = written(unsure.groupBy(*key).agg(F.max("support").alias("support")), "unsure")
    leaves = written(unsure.select("leaf").distinct(), "unsure-leaves")
    others = (
        lines.select("leaf", "shape", "doc", "line")
        .join(maybe_broadcast(leaves), "leaf", "left_semi")
        .join(own, ["leaf", "shape"], "left_anti")
        .select("leaf", "shape", "doc", split)
        .join(maybe_broadcast(unsure.select(*key)), key, "left_semi")
        .distinct()
        .groupBy(*key)
        .agg(F.count("*").alias("more"))
    )
    sure = unsure.join(others, key).filter(F.col("support") + F.col("more") >= min_docs)
    sure = written(sure.select(*key, F.lit(True).alias("sure")), "sure")
    constant = F.coalesce((F.col("support") >= min_docs) | F.col("sure"), F.lit(False))
    templates = written(generalised(words.join(maybe_broadcast(sure), key, "left"), constant), "templates")
    return written(in_texts(templates, places, min_docs), "recurring")


def without_recurring_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, text without its recurring lines, n_lines, n_dropped.

    A missing text stays missing with 0 lines; an empty one has one line, which stays, as do blank lines and lines of
    fewer than MIN_CONSTANTS tokens. Texts and lines of any length are taken whole. Rows with equal id and text get equal results; ids may
    be missing. A template with just enough texts or constants counts as recurring. An empty table gives no rows; other columns
    are ignored.
    """
    rows = docs.select(
        col(id_col).alias("doc_id"), F.xxhash64(col(text_col)).alias("doc"), col(text_col).alias("text")
    )
    known = rows.filter("text IS NOT NULL")
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "lines")
    every = parsed(known)
    every.write.parquet(path)
    parts = spark.read.schema(every.schema).parquet(path)
    drop = recurring_lines(parts, min_docs).select("leaf", "shape")
    # The place of a line depends on its text alone, so rows with the same text share one list.
    gone = (
        parts.filter(F.col("length") >= MIN_CONSTANTS)
        .select("doc", "at", "leaf", "shape")
        .join(maybe_broadcast(drop), ["leaf", "shape"], "left_semi")
        .groupBy("doc")
        .agg(F.collect_set("at").alias("gone"))
    )
    gone = written(gone, "dropped-lines")
    discard(spark, path)
    lines = F.split("text", "\n")
    left = F.filter(lines, lambda _, at: ~F.array_contains("gone", at))
    # The lists grow with the texts, so they meet by shuffle at every size.
    return rows.join(gone.hint("merge"), "doc", "left").select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text"))
        .otherwise(F.array_join(left, "\n"))
        .alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped from every document, and what is left of it."""
    cleaned = without_recurring_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars_left"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"),
    )


LINE_SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
lines AS (
  SELECT r, text, k, string_split(text, chr(10))[k] AS line
  FROM (SELECT r, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS k
        FROM texts WHERE text IS NOT NULL)),
parsed AS (
  SELECT *, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'),
    lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END) AS w FROM lines),
shapes AS (
  SELECT w, count(DISTINCT text) AS n FROM parsed WHERE len(w) >= {MIN_CONSTANTS} GROUP BY w),
words AS (SELECT w, n, p, w[p] AS token
  FROM (SELECT w, n, unnest(range(1, len(w) + 1)) AS p FROM shapes)),
support AS (
  SELECT *, sum(n) OVER (PARTITION BY len(w), w[1], w[2], p, token) AS s FROM words),
templates AS (
  SELECT w, string_agg(CASE WHEN token <> '{FIELD}' AND s >= {MIN_DOCS} THEN token
      ELSE '{FIELD}' END, ' ' ORDER BY p) AS template,
    count(*) FILTER (token <> '{FIELD}' AND s >= {MIN_DOCS}) AS constants
  FROM support GROUP BY w),
recurring AS (
  SELECT len(w) AS n, w[1] AS a, w[2] AS b, template FROM parsed JOIN templates USING (w)
  WHERE constants >= {MIN_CONSTANTS} AND 100 * constants >= {CONSTANT_PERCENT} * len(w)
  GROUP BY ALL HAVING count(DISTINCT text) >= {MIN_DOCS}),
dropped AS (
  SELECT w FROM templates t JOIN recurring g
  ON len(w) = g.n AND w[1] = g.a AND w[2] = g.b AND t.template = g.template),
marked AS (SELECT r, k, line, w IN (SELECT w FROM dropped) AS gone FROM parsed),
left_over AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '') AS t
  FROM marked GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
  length(coalesce(t, '')) AS n_chars_left, md5(coalesce(t, '')) AS text_md5
FROM texts LEFT JOIN left_over USING (r)"""

QUERIES = {"op6_line_dedup": op6_line_dedup}
ORACLES = {"op6_line_dedup": LINE_SQL}
