"""File and collection names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters kept in a collection name besides letters and
# digits, and the name used when nothing is left.
NAME_EXTRA_CHARS = "-._"
DEFAULT_COLLECTION = "imported_collection"


def base_name(path: Column) -> Column:
    """The part after the last ``/``."""
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """Base name without its extension; leading dots are not an
    extension (``.env`` keeps its name)."""
    base = base_name(path)
    s = F.regexp_extract(base, r"^(.*?)(\.[^.]*)?$", 1)
    return F.when(s.rlike(r"^\.*$"), base).otherwise(s)


def safe_name(path: Column) -> Column:
    """Collection name from a file path: every character that is not a
    letter, a digit or one of ``-._`` becomes ``_``; empty gives the default."""
    cleaned = F.regexp_replace(stem(path), r"[^\p{L}\p{N}._-]", "_")
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(DEFAULT_COLLECTION))
