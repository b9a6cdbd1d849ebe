"""Target-distribution importance resampling over hashed word n-grams."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.llm.common import small_batches, stored, table, text_or_empty

ORDER, BUCKETS = 2, 10_000
MIN_WORDS, PERCENT, SEED = 20, 25, 7
_CHUNK = 1 << 20  # n-grams hashed at a time
_ROW_BITS = 33  # of Spark's row numbers within a partition


def _folding() -> bytes:
    """ASCII capitals as small letters, other ASCII but digits and small letters as spaces."""
    kept = {ord(c): ord(c) for c in "abcdefghijklmnopqrstuvwxyz0123456789"}
    kept |= {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return bytes(kept.get(b, 32) if b < 128 else b for b in range(256))


_FOLD = _folding()
_SPACES = re.compile(rb"  +")


def collapsed(text: bytes) -> bytes:
    """Words of a text with single spaces around them; ``b" "`` if there are none."""
    return _SPACES.sub(b" ", b" %b " % text.translate(_FOLD))


def gram_pattern(n: int) -> regex.Pattern:
    """Runs of ``n`` words, from a space (left out of the match) up to a space.

    Possessive words make no match go back, and with ``overlapped`` the search
    goes on at the next word and not behind the run.
    """
    return regex.compile(rb" \K[^ ]++" + rb" [^ ]++" * (n - 1) + rb"(?= )")


class Grams:
    """Counts a text's n-grams by the CRC-32 of their bytes, modulo the buckets."""

    def __init__(self, order: int = ORDER, buckets: int = BUCKETS) -> None:
        self.buckets = buckets
        self.patterns = [gram_pattern(n) for n in range(1, order + 1)]

    def counts(self, text: bytes) -> tuple[int, np.ndarray]:
        """Number of words, and a count per bucket. Long texts are hashed a chunk at a time."""
        words = collapsed(text)
        total = np.zeros(self.buckets, np.int64)
        for pattern in self.patterns:
            spans = pattern.finditer(words, overlapped=True)
            hashes = map(zlib.crc32, map(itemgetter(0), spans))
            while len(chunk := np.fromiter(islice(hashes, _CHUNK), np.uint32)):
                total += np.bincount(chunk % np.uint32(self.buckets), minlength=self.buckets)
        return words.count(b" ") - 1, total


_FEATURES = "n_words long, n_features long, tie long, buckets binary, counts binary"


def features(docs: DataFrame, *carried: str, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """Per row its ``carried`` columns, words, n-grams, and its counts by bucket.

    Counts are sparse, so that a row never holds more than ``buckets`` pairs
    however long its text. ``tie`` is a hash of the text.
    """
    small_batches(docs.sparkSession)
    text = text_or_empty().cast("binary")
    rows = docs.select(*carried, text.alias("_text"), F.xxhash64(text).alias("_tie"))
    schema = T.StructType([docs.schema[c] for c in carried])
    schema = T.StructType(schema.fields + T.StructType.fromDDL(_FEATURES).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(order, buckets)
        for batch in batches:
            words, sums, keys, values = [], [], [], []
            for text in batch.column("_text"):
                n, total = grams.counts(text.as_py())
                found = np.flatnonzero(total)
                words.append(n)
                sums.append(int(total.sum()))
                keys.append(found.astype(np.uint32).tobytes())
                values.append(total[found].astype(np.uint64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in carried), pa.array(words, pa.int64()),
                    pa.array(sums, pa.int64()), batch.column("_tie"),
                    pa.array(keys, pa.binary()), pa.array(values, pa.binary()),
                ],
                schema.names,
            )

    return rows.mapInArrow(run, schema)


def _sparse(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for keys, values in zip(batch.column("buckets"), batch.column("counts")):
        yield np.frombuffer(keys.as_py(), np.uint32), np.frombuffer(values.as_py(), np.uint64)


def bucket_totals(counted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Sum of the counts of all rows per bucket.

    Each task adds up its rows, so that a shuffle of a row per task and bucket
    follows, and a number per bucket comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for keys, values in _sparse(batch):
                total[keys] += values.astype(np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(total[found])], ["bucket", "n"]
        )

    sums = (
        counted.select("buckets", "counts").mapInArrow(run, "bucket int, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n"))
    )
    total = np.zeros(buckets, np.int64)
    for row in sums.collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, target over source, per bucket."""
    b = len(source)
    in_source, in_target = float(source.sum() + b), float(target.sum() + b)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * in_source / ((s + 1) * in_target)))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighted(counted: DataFrame, gain: np.ndarray, *carried: str) -> DataFrame:
    """Rows of ``features`` with ``weight``: the floored mean of their n-grams' gains."""
    shared = counted.sparkSession.sparkContext.broadcast(gain)
    kept = [*carried, "n_words", "n_features", "tie"]
    schema = T.StructType([counted.schema[c] for c in kept]).add("weight", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            sums = [int((own[k] * v.astype(np.int64)).sum()) for k, v in _sparse(batch)]
            weights = [s // n if n else 0 for s, n in zip(sums, batch.column("n_features").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(weights, pa.int64())], schema.names
            )

    return counted.mapInArrow(run, schema)


def _with_score(rows: DataFrame, seed: int) -> DataFrame:
    """Adds the weight and a Gumbel variate that the id alone decides."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    uniform = (drawn + 0.5) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000) * F.log(-F.log(uniform)))
    return rows.withColumn("score", F.col("weight") + noise)


def _with_rank(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """Adds each row's place in the draw, null for rows not drawn.

    A range-partitioned sort gives every row a number within its partition, which
    a stored copy keeps; the partitions' sizes, summed, make the numbers global.
    No task holds more than its range, and no range a whole score: rows of one
    score are ordered, and cut, by id and text.
    """
    rows = scored.withColumn("long_enough", F.col("n_words") >= min_words)
    order = [
        F.desc("long_enough"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("tie"),
    ]
    numbered = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "ordered",
    )
    numbered = numbered.withColumns(
        {
            "part": F.shiftright("place", _ROW_BITS),
            "nth": F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    sizes = numbered.groupBy("part").agg(
        F.count("*").alias("n"), F.count_if("long_enough").alias("eligible")
    )
    # A row per partition.
    summed = sizes.selectExpr(
        "part", "sum(n) OVER (ORDER BY part) - n AS before",
        f"({percent} * sum(eligible) OVER ()) DIV 100 AS wanted",
    )
    rank = F.col("before") + F.col("nth") + 1
    return numbered.join(F.broadcast(summed), "part").withColumn(
        "rank", F.when(F.col("long_enough") & (rank <= F.col("wanted")), rank)
    )


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
    seed: int = SEED, order: int = ORDER, buckets: int = BUCKETS,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank, tie``, one row per row of ``docs``.

    Of the rows with at least ``min_words`` words the highest-scoring
    ``percent`` are drawn; ``rank`` counts them from 1. A score is the weight
    plus Gumbel noise, so this is a draw without replacement with chances in
    proportion to the exponent of the weight.

    Reads ``doc_id`` and ``text`` (``target``: ``text``) only. A null text has
    no words and weight 0. A null id takes part as an empty one and stands last
    among ties. Rows of one id share the noise; equal rows are ranked in any
    order. Without a target all weights favour what is rare. An empty table
    gives an empty result.

    One scan of the texts; their counts are stored, sparse, and read twice.
    """
    counted = stored(features(docs, "doc_id", order=order, buckets=buckets), "grams")
    source = bucket_totals(counted, buckets)
    wanted = bucket_totals(features(target, order=order, buckets=buckets), buckets)
    scored = _with_score(weighted(counted, gains(source, wanted), "doc_id"), seed)
    return _with_rank(scored, percent, min_words).select(
        "doc_id", "n_features", "weight", "score", "rank", "tie"
    )


def drawn(docs: DataFrame, target: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns.

    Found again by id and a hash of the text: equal rows come together if one is drawn.
    """
    found = resample(docs, target, **options).filter("rank IS NOT NULL").select(
        F.col("doc_id").alias("_id"), F.col("tie").alias("_same")
    ).distinct()
    mark = F.xxhash64(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    same = docs["doc_id"].eqNullSafe(found["_id"]) & (mark == found["_same"])
    return docs.join(found, same).select([docs[c] for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resample(docs, target).drop("tie")


# CRC-32 has no function in the twin's SQL: its table is made by the polynomial, bit
# by bit, and each distinct n-gram folded over its bytes.
_CRC_STEP = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
ORACLE = f"""
WITH RECURSIVE steps AS (
    SELECT i AS b, CAST(i AS BIGINT) AS v, 0 AS k FROM range(256) AS r(i)
    UNION ALL
    SELECT b, {_CRC_STEP}, k + 1 FROM steps WHERE k < 8
), crc AS (
    SELECT list(v ORDER BY b) AS t FROM steps WHERE k = 8
), texts AS (
    SELECT 'd' AS side, doc_id, row_number() OVER () AS row, text FROM documents
    UNION ALL SELECT 't', NULL, row_number() OVER (), text FROM benchmark
), worded AS (
    SELECT side, doc_id, row, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
    FROM texts
), grams AS (
    SELECT side, row, unnest(w) AS gram FROM worded
    UNION ALL
    SELECT side, row, unnest(list_transform(
        list_zip(w[:len(w) - 1], w[2:]), lambda p: p[1] || ' ' || p[2])) FROM worded WHERE len(w) > 1
), counted AS (
    SELECT side, row, gram, count(*) AS n FROM grams GROUP BY ALL
), hashed AS (
    SELECT gram, xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(octet_length(encode(gram))),
            lambda i: CAST(16 * (instr('0123456789ABCDEF', hex(encode(gram))[2 * i + 1]) - 1)
                + instr('0123456789ABCDEF', hex(encode(gram))[2 * i + 2]) - 1 AS BIGINT))),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT gram FROM counted), crc
), totals AS (
    SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s,
           coalesce(sum(n) FILTER (WHERE side = 't'), 0) AS t
    FROM counted JOIN hashed USING (gram) GROUP BY bucket
), gained AS (
    SELECT bucket, CAST(floor(1000 * ln(
        CAST(t + 1 AS DOUBLE) * CAST((SELECT sum(s) FROM totals) + 10000 AS DOUBLE)
        / (CAST(s + 1 AS DOUBLE) * CAST((SELECT sum(t) FROM totals) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM totals
), weighed AS (
    SELECT row, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total
    FROM counted JOIN hashed USING (gram) JOIN gained USING (bucket) WHERE side = 'd' GROUP BY row
), scored AS (
    SELECT doc_id, row, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
        CASE WHEN n_features > 0 THEN (total - ((total % n_features) + n_features) % n_features) // n_features
             ELSE 0 END AS weight,
        16777216 * (16 * (instr('0123456789abcdef', h[1]) - 1) + instr('0123456789abcdef', h[2]) - 1)
        + 65536 * (16 * (instr('0123456789abcdef', h[3]) - 1) + instr('0123456789abcdef', h[4]) - 1)
        + 256 * (16 * (instr('0123456789abcdef', h[5]) - 1) + instr('0123456789abcdef', h[6]) - 1)
        + 16 * (instr('0123456789abcdef', h[7]) - 1) + instr('0123456789abcdef', h[8]) - 1 AS h
    FROM (SELECT *, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM worded WHERE side = 'd')
    LEFT JOIN weighed USING (row)
), summed AS (
    SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM scored
), placed AS (
    SELECT *, row_number() OVER (
            PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
        count(*) FILTER (WHERE n_words >= 20) OVER () AS n
    FROM summed
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank
FROM placed
"""
