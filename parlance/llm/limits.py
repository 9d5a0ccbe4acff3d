"""The small table of size limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def limit(size_limits: DataFrame, purpose: str) -> tuple[int, int]:
    """(max_words, overlap_words) of a purpose; a fixed table of a few rows, read on the driver."""
    found = size_limits.where(F.col("purpose") == purpose).select("max_words", F.coalesce("overlap_words", F.lit(0))).orderBy("max_words").first()
    if found is None:
        raise ValueError(f"size_limits has no purpose {purpose}")
    return int(found[0]), int(found[1])
