"""Quality rules as a ledger of measurements and failure bits.

Every text is measured once and every rule judged once. A row of the ledger keeps the measurements and one bit per
failed rule. A policy is a named set of rules, that is, a bit mask: applying another version, or asking what a rule
alone costs, is bitwise work on the ledger and never looks at the texts again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StructField, StructType

from foldboard.llm.common import col, table

MEASURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper_words"
).split()
SYMBOLS = "#*$%&|<>"

#: Rule and the condition under which it fails, in integers so that every engine agrees. The place is the bit.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 16 * n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "shouting": "3 * n_upper_words > n_words",
}
BASE = ("few_words", "repeated_words")
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "shouting"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(rules: Iterable[str]) -> int:
    places = list(RULES)
    return sum(1 << places.index(rule) for rule in set(rules))


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that the text has at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    inside = bytearray(len(words))
    for place, window in enumerate(windows):
        if times[window] > 1:
            inside[place : place + 3] = b"\1\1\1"
    return sum(inside)


def measured(text: str | None) -> tuple[int, ...]:
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    full = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        sum(len(w) for w in words) - sum(_following(w) for w in words if not w.isascii()),
        sum(raw.count(s) for s in SYMBOLS.encode()),
        len(full) - len(set(full)),
        repeated_words(words),
        len(full),
        sum(map(bytes.isupper, words)),
    )


def _following(word: bytes) -> int:
    """Bytes that only continue a character."""
    return len(word) - len(word.decode("utf-8"))


@pandas_udf(StructType([StructField(name, LongType()) for name in MEASURES]))
def measure(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measured(t) for t in texts], columns=MEASURES, dtype="int64")


def failure_bits() -> Column:
    bits = F.lit(0).cast("long")
    for place, fails in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << place)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, measurements, fail_bits.

    A missing or empty text measures 0 everywhere and fails ``few_words``. Repeated rows and missing ids stay rows of
    their own; an empty table gives an empty ledger; other columns are ignored.
    """
    rows = docs.select(col(id_col).alias("doc_id"), measure(col(text_col)).alias("_m"))
    return rows.select("doc_id", "_m.*").withColumn("fail_bits", failure_bits())


def apply_policy(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``policy``, ``kept`` and ``base_failed``."""
    failed = lambda rules: F.col("fail_bits").bitwiseAND(F.lit(mask(rules))) != 0
    return entries.withColumns(
        {
            "policy": F.lit(policy),
            "base_failed": failed(BASE),
            "kept": ~failed((*BASE, *POLICIES[policy])),
        }
    )


def ablation(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of the policy: rows it fails, rows only it fails, rows kept with it and without it.

    Rows are first counted per pattern of bits (at most 2 ** rules), so nothing grows with the corpus.
    """
    active = mask(POLICIES[policy])
    patterns = entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(active)).alias("bits")).count()

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("count"))), F.lit(0))

    kept = F.col("bits") == 0
    lines = []
    for rule in POLICIES[policy]:
        bit = F.lit(mask([rule])).cast("long")
        alone = F.col("bits") == bit
        lines.append(
            F.struct(
                F.lit(rule).alias("rule"),
                rows(F.col("bits").bitwiseAND(bit) != 0).alias("n_failed"),
                rows(alone).alias("n_only_this"),
                rows(kept).alias("n_kept"),
                rows(kept | alone).alias("n_kept_without"),
            )
        )
    return patterns.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents under the current policy."""
    return apply_policy(ledger(table(spark, sf_dir, "documents")))


def oracle() -> str:
    bits = " | ".join(
        f"(CASE WHEN {fails} THEN {1 << place} ELSE 0 END)"
        for place, fails in enumerate(RULES.values())
    )
    symbols = "".join("\\" + s if s in "$|*" else s for s in SYMBOLS)
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, list_filter(
      string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
inside AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r),
measures AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[{symbols}]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(inside.n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')))
      AS n_upper_words
  FROM split LEFT JOIN inside USING (r)),
judged AS (SELECT *, CAST({bits} AS BIGINT) AS fail_bits FROM measures)
SELECT *, '{CURRENT}' AS policy, fail_bits & {mask(BASE)} <> 0 AS base_failed,
  fail_bits & {mask((*BASE, *POLICIES[CURRENT]))} = 0 AS kept
FROM judged"""


QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLES = {"op9_quality_rules": oracle()}
