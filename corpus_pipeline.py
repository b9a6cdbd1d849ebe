"""From raw documents to the piece ids of a deduplicated, mixed corpus.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept;
all but the last return rows of ``docs`` with the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flightmarts.llm import exact_dedup, jaccard_join, mixing, piece_codec, quality_rules
from flightmarts.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard_join.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: never, once or up to three times."""
    return mixing.mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document of the mix, decoded again to prove them."""
    return piece_codec.round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mix),
    ("piece_codec", pieces),
]

# Hash-ordered mixing and Viterbi have no SQL form; tests run plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
