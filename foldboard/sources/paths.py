"""Object-store locations: composing them and taking them apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
_KEY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?/*([^?#]*)"


def object_uri(bucket: str, key: str, scheme: str = "s3a") -> str:
    """Location understood by Spark readers and writers."""
    return f"{scheme}://{bucket}/{key.lstrip('/')}"


def bucket_of(uri: Column) -> Column:
    """Bucket (or host) of a location; empty when it has none.

    A pattern instead of ``parse_url``, which rejects the blanks that model
    paths may contain.
    """
    return F.regexp_extract(uri, _AUTHORITY, 1)


def key_of(uri: Column) -> Column:
    """Key of a location: its path without leading slashes."""
    return F.regexp_extract(uri, _KEY, 1)
