"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are what stands between blanks (space, tab, line feed to carriage return).
BLANK_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col(f"`{name}`")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def id_remainder(name: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a missing id counts as empty text."""
    text = F.coalesce(col(name).cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(text), F.lit(n)).cast("int")


def lower_bytes(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case; ``split()`` of it gives the words."""
    return b"" if text is None else text.encode("utf-8", "replace").lower()
