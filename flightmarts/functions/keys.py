"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightmarts.constants import NULL_KEY_TEXT


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the columns' texts joined by ``-``; NULLs count as a fixed text."""
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY_TEXT))
        for c in columns
    ]
    return F.md5(F.concat_ws("-", *texts))
