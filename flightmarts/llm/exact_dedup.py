"""Exact duplicates by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightmarts.llm.common import SPACES, bitmap, flagged, stored, table, text_or_empty

PREFIX = 64  # code points


def normalised(name: str = "text") -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(text_or_empty(name), SPACES, " ")


def exact_groups(docs: DataFrame, with_digest: bool = False) -> DataFrame:
    """``doc_id, keep_id, group_size, kept``, one row per row of ``docs``.

    Texts are equal when identical after normalisation; the row with the
    smallest ``doc_id`` stays, exactly one per group even if that id repeats.
    Reads only ``doc_id`` and ``text``: other columns may have any name. A null
    text is empty, and all empty texts are one group. A null ``doc_id`` comes
    after all others. An empty table gives an empty result. ``with_digest``
    adds ``text_sha256`` of every row, also of those outside any group.

    1. One scan keeps length and prefix hash of each text, nothing else.
    2. Lengths that occur once are done; of the others, prefixes that occur once.
    3. A second scan hashes the full text of rows in surviving groups. It knows
       them by a bitmap of fixed size (128 KB), the only thing broadcast; where
       it errs, a text is hashed in vain. Texts are never shuffled.

    A group that holds a third of all rows is counted on the map side; giving
    its rows their result is a join that adaptive execution splits.
    """
    return _grouped(docs.select("doc_id", "text"), [], with_digest)


def _grouped(docs: DataFrame, carried: list[str], with_digest: bool = False) -> DataFrame:
    normed = docs.select("doc_id", normalised().alias("norm"), *carried)
    sized = {
        "length": F.length("norm"),
        "prefix": F.xxhash64(F.substring("norm", 1, PREFIX)),
    }
    profile = stored(normed.withColumns(sized).select("length", "prefix"), "profile")
    lengths = profile.groupBy("length").count().filter("count > 1").select("length")
    # Counted before the lengths meet, so that a frequent length brings few rows.
    groups = (
        profile.groupBy("length", "prefix").count().filter("count > 1")
        .join(lengths, "length", "left_semi")
        .select("length", "prefix")
    )
    seen = flagged(
        normed.withColumns(sized), bitmap(groups, "length", "prefix"), "survives", "length", "prefix"
    )
    sha = F.unhex(F.sha2(F.col("norm").cast("binary"), 256))
    if with_digest:
        seen = seen.withColumn("sha", sha)
        sha = F.col("sha")
    kept_columns = [*carried, "sha"] if with_digest else carried
    hashed = stored(
        seen.select(
            "doc_id", "length", F.when(F.col("survives"), sha).alias("full"), *kept_columns,
            F.monotonically_increasing_id().alias("row"),
        ),
        "hashed",
    )
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    copies = (
        hashed.filter("full IS NOT NULL").groupBy("full", "length")
        .agg(F.min(order).alias("least"), F.count("*").alias("n")).filter("n > 1")
    )
    found = hashed.join(copies, ["full", "length"], "left")
    alone = F.col("n").isNull()
    result = [
        F.col("doc_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("least.row"))).alias("kept"),
    ]
    result += [F.col(c) for c in carried]
    if with_digest:
        result.append(F.lower(F.hex("sha")).alias("text_sha256"))
    return found.select(result)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row is found again by its id and a hash of its text, so rows without an id,
    or under the same one, are told apart; of rows that share both, one stays.
    """
    mark = F.xxhash64(normalised())
    kept = (
        _grouped(docs.withColumn("_mark", mark).select("doc_id", "text", "_mark"), ["_mark"])
        .filter("kept").select(F.col("doc_id").alias("_stays"), F.col("_mark").alias("_as")).distinct()
    )
    rank = F.row_number().over(Window.partitionBy("_stays", "_as").orderBy("_as"))
    own = docs.withColumn("_mark", mark)
    return (
        own.join(kept, own["doc_id"].eqNullSafe(kept["_stays"]) & (own["_mark"] == kept["_as"]))
        .withColumn("_nth", rank).filter("_nth = 1").select(docs.columns)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), with_digest=True)


ORACLE = r"""
WITH n AS (
    SELECT doc_id,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), g AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM n JOIN g USING (text_sha256)
"""
