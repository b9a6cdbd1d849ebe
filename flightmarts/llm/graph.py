"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmarts.llm.common import stored


def _stars(pairs: DataFrame) -> DataFrame:
    """Every pair ``(node, other)`` beside the least of node and its others."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    least = least.withColumn("least", F.least("node", "least"))
    return pairs.join(least, "node")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                F.struct(F.col("b").alias("node"), F.col("a").alias("other")),
            )
        )
    )
    large = (
        _stars(both)
        .filter("other > node AND other != least")
        .select(F.col("other").alias("node"), F.col("least").alias("other"))
        .distinct()
    )
    small = _stars(large)
    return (
        small.select(F.col("other").alias("a"), F.col("least").alias("b"))
        .union(small.select(F.col("node").alias("a"), F.col("least").alias("b")))
        .filter("a != b")
        .distinct()
    )


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """``(node, root)`` of all nodes but the roots, root being the component's least node.

    ``edges`` has two columns of ids; nulls and loops count for nothing. Each
    round hangs neighbours on the least node around them, first the larger
    ones, then the smaller: edges never outgrow their first number, and a hub
    is a group of a join that adaptive execution can split. Stops when the
    edges are stars, that is when a round changes nothing.
    """
    first, second = edges.columns
    now = stored(
        edges.select(
            F.greatest(first, second).alias("a"), F.least(first, second).alias("b")
        )
        .filter(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col("a") != F.col("b")))
        .distinct(),
        "edges",
    )
    state = None
    for _ in range(rounds):
        seen = now.agg(
            F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")
        ).first()
        if seen == state or not seen["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = seen
        now = stored(_round(now), "edges")
    raise RuntimeError(f"components not found in {rounds} rounds")
