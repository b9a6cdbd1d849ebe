"""Phrase collocations from counts of longest windows, rolled up to their prefixes."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightmarts.llm.common import small_batches, stored, table, text_or_empty
from flightmarts.llm.hashing import Prefixes, mix, word_bounds

LONGEST, LEAST, FIRST = 5, 100, 2000
SCALE, COVERED = 1000, 100  # of the score, and percent of a phrase that a longer one must hold
BITS = 27  # of the hash that words and pairs are counted by before they are spelled out
_PAGE_BITS = 16  # buckets counted side by side
_CHUNK = 16 << 20  # bytes of text taken together
_HELD = 1 << 20  # counted windows that a task holds back to add the next ones up with

_U = np.uint64
# What ends a piece, and what parts words.
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b".,;:!?\x0b\x0c\r" + b"\t",
    b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ",
)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Folded texts of a task, put together by language and cut between pieces only."""
    open_: dict[str, list[bytes]] = defaultdict(list)
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            text = text.as_py().translate(_FOLD)
            at = 0
            while len(text) - at > _CHUNK and (end := text.find(b"\n", at + _CHUNK)) >= 0:
                yield lang, text[at:end]
                at = end
            open_[lang].append(text[at:])
            held += len(text) - at
            if held > _CHUNK:
                yield from _joined(open_)
                held = 0
    yield from _joined(open_)


def _joined(open_: dict[str, list[bytes]]) -> Iterator[tuple[str, bytes]]:
    while open_:
        lang, texts = open_.popitem()
        yield lang, b"\n".join(texts)


def _hashes(words: pa.StringArray) -> np.ndarray:
    """Hash of each word, from the bytes they lie in one behind the other."""
    if not len(words):
        return np.zeros(0, _U)
    _, offsets, letters = words.buffers()
    bounds = np.frombuffer(offsets, np.int32)[: len(words) + 1]
    return Prefixes(np.frombuffer(letters, np.uint8)[: bounds[-1]]).of(bounds[:-1], bounds[1:])


class Words:
    """The words of a chunk as numbers into a list of its distinct words."""

    def __init__(self, lang: str, text: bytes) -> None:
        data = np.frombuffer(text, np.uint8)
        starts, ends = word_bounds(data)
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        letters = data[(data != 32) & (data != 10)]
        spelled = pa.StringArray.from_buffers(
            len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))
        ).dictionary_encode()
        self.distinct: pa.StringArray = spelled.dictionary
        self.codes = spelled.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(data == 10, dtype=np.int32)[starts] if len(starts) else starts
        #: Whether the next word follows within the piece.
        self.adjacent = piece[:-1] == piece[1:]
        seed = _U(zlib.crc32(lang.encode()) << 17 | 1)
        self.hashes = mix(_hashes(self.distinct) ^ seed)

    def runs(
        self, packed: np.ndarray, counted: int, upto: int
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``k``, places and buckets of the runs of ``k`` words that may be frequent, by ``k``.

        Runs of up to ``counted`` words are looked up in ``packed``, a bit per
        bucket, and only frequent ones are left. A longer run may be frequent if
        what it is without its last and without its first word may be.
        """
        own = self.hashes[self.codes]
        hashes, alive = own.copy(), np.ones(len(own), bool)
        for k in range(1, upto + 1):
            if k > 1:
                # Both parts lie within their piece, and with three words they overlap.
                alive = alive[:-1] & alive[1:] & (self.adjacent if k == 2 else True)
                alive = np.append(alive, False)
            at = np.flatnonzero(alive)
            if k > 1:
                hashes[at] = mix(hashes[at] * _U(0x9E3779B97F4A7C15) + own[at + k - 1])
            buckets = (mix(hashes[at] + _U(k)) >> _U(64 - BITS)).astype(np.int64)
            if k <= counted:
                frequent = (packed[buckets >> 3] >> (buckets & 7).astype(np.uint8) & 1).astype(bool)
                alive[at] = frequent
                at, buckets = at[frequent], buckets[frequent]
            yield k, at, buckets


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"),
        text_or_empty().cast("binary").alias("text"),
    )


def frequent_buckets(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> np.ndarray:
    """A bit per bucket: whether its runs of words, of all documents, add up to ``least``.

    Single words first; then pairs of frequent words; then longer runs of
    frequent pairs: a run is no more frequent than any part of it, so ever fewer
    are left to count. A run that occurs so often sets its bit; the few others
    that share a bucket do no harm, as they are counted by their spelling
    afterwards. What comes to the driver, and is broadcast, is 2^27 bits or 16 MB,
    whatever the input.
    """
    packed = np.zeros(1 << (BITS - 3), np.uint8)
    counted = 0
    for upto in sorted({1, min(2, longest), longest}):
        packed |= _counted_buckets(docs, packed, counted, upto, least)
        counted = upto
    return packed


def _counted_buckets(
    docs: DataFrame, packed: np.ndarray, counted: int, upto: int, least: int
) -> np.ndarray:
    """Bits of the frequent buckets of runs of ``counted + 1`` to ``upto`` words."""
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    entry = np.dtype([("at", "<u2"), ("n", "u1" if least < 256 else "<u4")])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text in _chunks(batches):
            runs = Words(lang, text).runs(shared.value, counted, upto)
            buckets = np.concatenate([own for k, _, own in runs if k > counted])
            buckets, often = np.unique(buckets.astype(np.int32), return_counts=True)
            entries = np.empty(len(buckets), entry)
            entries["at"] = buckets & ((1 << _PAGE_BITS) - 1)
            entries["n"] = np.minimum(often, least)
            pages, first = np.unique(buckets >> _PAGE_BITS, return_index=True)
            parts = [p.tobytes() for p in np.split(entries, first[1:])] if len(pages) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(pages, pa.int32()), pa.array(parts, pa.binary())], ["page", "entries"]
            )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for page, own in zip(batch.column("page").to_pylist(), batch.column("entries")):
                own = np.frombuffer(own.as_py(), entry)
                if page not in total:
                    total[page] = np.zeros(1 << _PAGE_BITS, np.uint32)
                so_far = total[page][own["at"]] + own["n"]
                total[page][own["at"]] = np.minimum(so_far, least)
        for page, counts in total.items():
            bits = np.packbits(counts >= least, bitorder="little").tobytes()
            yield pa.RecordBatch.from_pydict({"page": pa.array([page], pa.int32()), "bits": [bits]})

    # Counts travel as pages of counters, three bytes an entry. A task adds its pages up as
    # they come: all counters together are 512 MB, over however many tasks.
    pages = (
        _texts(docs).mapInArrow(found, "page int, entries binary")
        .repartition("page").mapInArrow(summed, "page int, bits binary")
    )
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    size = 1 << (_PAGE_BITS - 3)
    for row in pages.toArrow().to_pylist():
        own = np.frombuffer(row["bits"], np.uint8)[: len(bits)]
        bits[row["page"] * size :][: len(own)] = own
    return bits


def _lead(k: int) -> str:
    return f"w{k}"


def _summed(tables: list[pa.Table], columns: list[str]) -> pa.Table:
    """Counted windows, each once."""
    keys = ["lang", *columns]
    summed = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([("n", "sum")])
    return summed.rename_columns({"n_sum": "n"}).select([*keys, "n"])


def windows(docs: DataFrame, frequent: Broadcast, longest: int = LONGEST) -> DataFrame:
    """``lang, w1, ..., n``: how often each longest window begins at a word.

    A window is a word and the words that lead it, padded with nulls from the
    end of its piece on, and from where it is no longer frequent. Words that
    are not frequent themselves give windows of nulls alone.

    There are as many tasks as cores at most, each of which takes several splits
    one behind the other and adds its windows up over all of them.
    """
    columns = [_lead(k) for k in range(1, longest + 1)]
    schema = ", ".join(["lang string", *[f"{c} string" for c in columns], "n long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: list[pa.Table] = []
        for lang, text in _chunks(batches):
            words = Words(lang, text)
            codes = words.codes
            if not len(codes):
                continue
            # Windows of no word and of one need no sorting.
            reach = np.zeros(len(codes), np.int8)
            for k, at, _ in words.runs(frequent.value, longest, longest):
                reach[at] = k
            alone = np.bincount(codes[reach == 1], minlength=len(words.distinct))
            single = np.flatnonzero(alone)
            starts = np.flatnonzero(reach > 1)
            led = [codes[starts]]
            for k in range(1, longest):
                held = reach[starts] > k
                led.append(np.full(len(starts), -1))
                led[k][held] = codes[starts[held] + k]
            counted = pa.table(dict(zip(columns, map(pa.array, led)))).group_by(
                columns, use_threads=False
            ).aggregate([([], "count_all")])
            rows = [np.concatenate([[-1], single, counted.column("w1").to_numpy()])]
            pad = np.full(1 + len(single), -1)
            rows += [np.concatenate([pad, counted.column(c).to_numpy()]) for c in columns[1:]]
            n = np.concatenate([[(reach == 0).sum()], alone[single], counted.column("count_all").to_numpy()])
            tables.append(
                pa.table(
                    [
                        pa.array([lang] * len(n), pa.string()),
                        *(words.distinct.take(pa.array(r, mask=r < 0)) for r in rows),
                        pa.array(n.astype(np.int64)),
                    ],
                    ["lang", *columns, "n"],
                )
            )
            # Added up whenever they have doubled, and handed on when they are many.
            if sum(map(len, tables)) > max(2 * len(tables[0]), _HELD // 8):
                tables = [_summed(tables, columns)]
                if len(tables[0]) > _HELD:
                    yield from tables.pop().to_batches()
        if tables:
            yield from _summed(tables, columns).to_batches()

    # Windows frequent over all are in nearly every split, and a task gives each of its own once:
    # a task per split would give rows by the product of both numbers, which grow with the input.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return (
        _texts(docs).coalesce(cores).mapInArrow(run, schema)
        .groupBy("lang", *columns).agg(F.sum("n").alias("n"))
    )


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang, size, w1, ..., phrase, f``: phrases found ``least`` times or more; stored.

    Size 0 is the language as a whole, ``f`` its words. Only longest windows
    are counted from the texts; ROLLUP sums them over ever shorter prefixes, and
    a phrase is the prefix of just those windows that begin where it occurs.
    """
    columns = [_lead(k) for k in range(1, longest + 1)]
    shared = docs.sparkSession.sparkContext.broadcast(frequent_buckets(docs, longest, least))
    rolled = (
        windows(docs, shared, longest).rollup("lang", *columns)
        .agg(F.sum("n").alias("f"), F.grouping_id().cast("int").alias("rolled"))
    )
    # As many words are kept as low bits are clear.
    size = sum(
        ((F.shiftright("rolled", longest - k) % 2 == 0).cast("int") for k in range(1, longest + 1)),
        F.lit(0),
    )
    padded = F.get(F.array(*columns), F.col("size") - 1).isNull()
    return stored(
        rolled.filter("lang IS NOT NULL").withColumn("size", size)
        .filter((F.col("size") == 0) | (~padded & (F.col("f") >= least)))
        .select("lang", "size", *columns, F.concat_ws(" ", *columns).alias("phrase"), "f"),
        "phrases",
    )


def _part(columns: list[str]) -> Column:
    return F.concat_ws(" ", *columns)


def _cuts(longest: int) -> Column:
    """A candidate's cuts: after how many words, and both parts. Null parts are past its end."""
    columns = [_lead(k) for k in range(1, longest + 1)]
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("cut"), _part(columns[:k]).alias("head"), _part(columns[k:]).alias("rest")
            )
            for k in range(1, longest)
        ]
    )


def _inner(longest: int) -> Column:
    """Phrases of two words and more that lie inside a candidate, without itself."""
    columns = [_lead(k) for k in range(1, longest + 1)]
    runs = [
        F.when(
            (F.col("size") >= i + size) & (F.col("size") > size), _part(columns[i : i + size])
        )
        for size in range(2, longest)
        for i in range(longest - size + 1)
    ]
    return F.array_compact(F.array(*runs))


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, first: int = FIRST
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases.

    Candidates are phrases of 2 to ``longest`` words found ``a >= least``
    times. A cut into parts found ``l`` and ``r`` times scores
    ``floor(1000 a n / (l r))``, in decimals that hold the products; the least
    score counts, of equal ones that of the earliest cut. Dropped are candidates
    inside a longer one that is found at least as often.

    Reads ``lang`` and ``text`` only. A null language is ``und``; a null or empty
    text has no words; repeated rows count each; an empty table gives an empty
    result. Ties in score go by ``a``, then by the phrase's bytes.

    Four scans. Three find which buckets of words, pairs and longer runs are
    frequent, so that in the last only windows travel that may matter; counts
    are summed in map tasks before each shuffle, and a phrase with a third of
    all occurrences is a row per task. Beyond some 10^10 words the buckets fill up
    and more windows travel, without a change in the result.
    """
    found = phrase_counts(docs, longest, least)
    known = found.filter("size >= 1").select("lang", "phrase", "f")
    whole = found.filter("size = 0").select("lang", F.col("f").alias("n"))
    candidates = found.filter("size >= 2")

    covered = (
        candidates.filter("size >= 3")
        .select("lang", F.explode(_inner(longest)).alias("phrase"), F.col("f").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    kept = candidates.join(covered, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(COVERED) * F.col("longer") < F.lit(100) * F.col("f"))
    )
    cut = kept.select("lang", "phrase", "size", F.col("f").alias("a"), F.inline(_cuts(longest))).filter(
        "cut < size"
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # One row per language.
    scored = (
        cut.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
        .join(whole, "lang")
        .withColumn(
            "score",
            F.expr(
                f"(CAST({SCALE} AS DECIMAL(4,0)) * (CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0))))"
                " DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"
            ),
        )
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("best.a"), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= first)
        .select("lang", "rank", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS w FROM pieces
), placed AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), sizes AS (
    SELECT k FROM range(1, 6) AS r(k)
), counts AS (
    SELECT lang, k, w[i:i + k - 1] AS words, count(*) AS f
    FROM placed JOIN sizes ON i + k - 1 <= len(w) GROUP BY ALL
), whole AS (
    SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
), found AS (
    SELECT lang, k, words, array_to_string(words, ' ') AS phrase, f FROM counts WHERE f >= 100
), inner_ AS (
    SELECT b.lang, b.f, array_to_string(b.words[i:i + s.k - 1], ' ') AS phrase
    FROM found AS b JOIN sizes AS s ON s.k BETWEEN 2 AND b.k - 1, range(1, 5) AS r(i)
    WHERE i + s.k - 1 <= b.k
), covered AS (
    SELECT lang, phrase, max(f) AS longer FROM inner_ GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, whole.n, s.k AS cut,
        (CAST(1000 AS HUGEINT) * c.f * CAST(whole.n AS HUGEINT)) // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM found AS c JOIN sizes AS s ON s.k < c.k JOIN whole ON whole.lang = c.lang
    JOIN found AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[:s.k], ' ')
    JOIN found AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[s.k + 1:], ' ')
    LEFT JOIN covered ON covered.lang = c.lang AND covered.phrase = c.phrase
    WHERE c.k >= 2 AND (longer IS NULL OR 100 * longer < 100 * c.f)
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM lowest QUALIFY rank <= 2000
"""
