"""Self-join of documents on the Jaccard similarity of their word 5-gram sets."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.llm.common import (
    bitmap,
    flagged,
    row_key,
    small_batches,
    stored,
    table,
    text_or_empty,
)
from flightmarts.llm.graph import components
from flightmarts.llm.hashing import fold, mix, shingle_set

SHINGLE = 5
HASHES = 256
RECALL = 0.995
# A unit of verification holds two blocks of at most about so many n-grams and documents.
BLOCK_GRAMS = 1_500_000
BLOCK_DOCS = 2000
_WORDS = 1 << 16  # of the bitmap of documents with candidates: 512 KB
# n-grams in more documents of a unit than this are counted by matrix products.
COMMON = 48


def banding(threshold: float, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows: the longest rows that still find a pair at ``threshold`` with ``recall``.

    A pair of similarity s shares some band with probability 1 - (1 - s^rows)^bands.
    """
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    raise ValueError("no banding reaches that recall")


def _name(grams: np.ndarray) -> bytes:
    """A whole set as 16 bytes: two sums of independent scramblings."""
    sums = [mix(grams + np.uint64(k)).sum(dtype=np.uint64) for k in (1, 2)]
    return np.array(sums, np.uint64).tobytes()


class _Signer:
    def __init__(self, bands: int, rows: int) -> None:
        random = np.random.default_rng(20240229)
        n = bands * rows
        self.scale = random.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1)
        self.shift = random.integers(0, 1 << 32, n, np.uint32)
        self.bands, self.rows = bands, rows

    def bands_of(self, grams: np.ndarray) -> np.ndarray:
        """Band keys of one non-empty set; a key says which band it is of."""
        small = (grams >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.scale), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(small), 1024):
            block = small[at : at + 1024, None] * self.scale + self.shift
            np.minimum(least, block.min(axis=0), out=least)
        grid = least.reshape(self.bands, self.rows)
        keys = fold(grid, 1)
        return mix(keys + np.arange(self.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _sketches(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = _Signer(bands, rows)
        for batch in batches:
            sets, keys, sizes = [], [], []
            for text in batch.column(1):
                grams = shingle_set(text.as_py())
                sizes.append(len(grams))
                if len(grams):
                    sets.append(_name(grams))
                    keys.append(signer.bands_of(grams).view(np.int64))
                else:
                    sets.append(None)
                    keys.append(np.zeros(0, np.int64))
            offsets = np.zeros(len(keys) + 1, np.int32)
            np.cumsum([len(k) for k in keys], out=offsets[1:])
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sets, pa.binary()), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                ["doc_id", "node", "n_grams", "bands"],
            )

    return run


_UNIT = ["unit", "left", "right"]
_MEMBER = "block int, node binary, copies long, home binary, bands array<long>, grams binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to their sets, repeated for each unit of work the document is part of."""
    names = ["unit", "left", "right", "block", "node", "copies", "home", "bands", "grams"]
    types = [pa.binary(), *[pa.int32()] * 3, pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
    for batch in batches:
        columns = [batch.column(n) for n in ("text", "node", "copies", "home", "bands", "units")]
        for text, *own in zip(*columns, strict=True):
            node, copies, home, bands, units = (value.as_py() for value in own)
            grams = shingle_set(text.as_py())
            if not len(grams) or _name(grams) != node:
                continue  # another row under the same id
            for unit in units:
                blocks, block = unit["blocks"], unit["block"]
                shared = [block, node, copies, home, bands if len(unit["unit"]) == 8 else None, grams.tobytes()]
                out = [[unit["unit"]] * blocks, [min(block, k) for k in range(blocks)],
                       [max(block, k) for k in range(blocks)], *[[value] * blocks for value in shared]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(o, t) for o, t in zip(out, types, strict=True)], names
                )


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every two sets, as a matrix."""
    n = len(sets)
    counts = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n, dtype=np.int32), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    sizes = np.diff(np.r_[starts, len(values)])
    common = starts[sizes > COMMON]
    widths = sizes[sizes > COMMON]
    for at in range(0, len(common), 1024):
        grid = np.zeros((n, len(common[at : at + 1024])), np.float32)
        for column, (start, width) in enumerate(
            zip(common[at : at + 1024], widths[at : at + 1024], strict=True)
        ):
            grid[owner[start : start + width], column] = 1
        counts += grid @ grid.T
    flat = counts.reshape(-1)
    for width in range(2, COMMON + 1):
        chosen = starts[sizes == width]
        first, second = np.triu_indices(width, 1)
        step = max(1, 1_000_000 // len(first))
        for at in range(0, len(chosen), step):
            members = owner[chosen[at : at + step, None] + np.arange(width)]
            cells = members[:, first].astype(np.int64) * n + members[:, second]
            cells, times = np.unique(cells, return_counts=True)
            flat[cells] += times
            flat[cells % n * n + cells // n] += times
    return counts


def _of_first_bucket(hit: np.ndarray, home: np.ndarray, bands: np.ndarray, key: int) -> np.ndarray:
    """Of the hits in the bucket of ``key``: pairs of two homes that share no earlier band."""
    hit &= home[:, None] != home
    for i in np.flatnonzero(hit.any(axis=1)):
        others = np.flatnonzero(hit[i])
        first = (bands[others] == bands[i]).argmax(axis=1)
        hit[i, others] = bands[i, first] == key
    return hit


def _verify(threshold: float):
    """Links per linked document of one unit, and a spanning star of each of its components."""
    up, down = Fraction(str(threshold)).as_integer_ratio()
    kinds = (pa.binary(), pa.int64(), pa.binary())
    none = pa.table([pa.array([], kind) for kind in kinds], ["node", "links", "root"])

    def run(key: tuple, group: pa.Table) -> pa.Table:
        unit, left, right = (k.as_py() for k in key)
        bucket = len(unit) == 8
        if left != right and len(group.column("block").unique()) < 2:
            return none  # one block is empty, and pairs within the other belong to its own unit
        nodes, first = np.unique(
            np.array(group.column("node").to_pylist(), object), return_index=True
        )
        group = group.take(first)
        home = np.unique(np.array(group.column("home").to_pylist(), object), return_inverse=True)[1]
        if len(nodes) < 2 or bucket and home.max() == 0:
            return none
        copies = group.column("copies").to_numpy()
        block = group.column("block").to_numpy()
        sets = [np.frombuffer(g.as_py(), np.uint64) for g in group.column("grams")]
        size = np.array([len(s) for s in sets])
        shared = shared_counts(sets)
        hit = np.empty(shared.shape, bool)
        for i in range(len(sets)):
            hit[i] = shared[i].astype(np.int64) * (up + down) >= up * (size[i] + size)
        del shared
        np.fill_diagonal(hit, False)
        if left != right:  # pairs within a block belong to the block's own unit
            hit &= block[:, None] != block
        if bucket:
            bands = np.array(group.column("bands").to_pylist(), np.int64)
            hit = _of_first_bucket(hit, home, bands, int.from_bytes(unit, "big", signed=True))
        root = np.full(len(sets), -1)
        for i in range(len(sets)):
            if root[i] < 0:
                root[i], front = i, np.array([i])
                while len(front):
                    near = hit[front].any(axis=0) & (root < 0)
                    root[near] = i
                    front = np.flatnonzero(near)
        linked = np.flatnonzero(hit.any(axis=1))
        links = [int(copies[hit[i]].sum()) for i in linked]
        found = (nodes[linked], links, nodes[root[linked]])
        return pa.table([pa.array(f, k) for f, k in zip(found, kinds, strict=True)], none.column_names)

    return run


def classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``doc_id, class_id, n_links, n_grams``, one row per row of ``docs``.

    Two documents are linked if the Jaccard similarity of their sets of word
    5-grams is at least ``threshold``; the class of a document is the connected
    component of links, named by its smallest ``doc_id``. ``n_links`` counts the
    other rows it is linked to. A text of one to four words is one n-gram; a
    text without words (null, empty) is linked to nothing, and neither is a row
    whose ``doc_id`` is null (its class is null). Repeated rows are copies of each
    other. Reads ``doc_id`` and ``text`` only. An empty table gives an empty
    result. Words are compared as they are.

    1. MinHash signatures in bands, chosen for a recall of 99.5 % at the threshold.
    2. Rows with the very same set are one from here on, with a count.
    3. Shuffled by band key, each document learns the least one of each of its
       buckets; the least of these is its home. Nothing is closed transitively:
       a home and its documents share a bucket.
    4. Full sets meet per home, and all pairs of a home are verified exactly.
       Pairs of two homes are verified in the first bucket they share; buckets of
       one home have none and send nothing. So a set travels once and once more
       for each bucket on a border between homes, however long chains of near
       copies grow, and each candidate pair is verified in one place.
       A bitmap of fixed size, broadcast, keeps most other texts in place.
       A large home or bucket is cut into blocks by hash, and a task verifies two
       blocks: memory is bounded by the block, work is spread, and pairs are
       only ever counted, never emitted. Out come a link count per document
       and a spanning star per block pair; components are of verified links.
    """
    small_batches(docs.sparkSession)
    rows = stored(
        docs.select("doc_id", text_or_empty().cast("binary").alias("text")).mapInArrow(
            _sketches(*banding(threshold)),
            T.StructType([docs.schema["doc_id"]]).add("node", "binary")
            .add("n_grams", "long").add("bands", T.ArrayType(T.LongType())),
        ),
        "sketches",
    )
    nodes = stored(
        rows.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("first"), F.count("*").alias("copies"),
            F.first("n_grams").alias("size"), F.first("bands").alias("bands"),
        ),
        "nodes",
    )
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    least = (
        keyed.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("n"))
        .filter("n > 1").drop("n")
    )
    tied = stored(keyed.join(least, "key"), "tied")
    homes = stored(tied.groupBy("node").agg(F.min("least").alias("home")), "homes")
    placed = tied.select("key", "node").join(homes, "node")
    borders = (
        placed.groupBy("key").agg(F.min("home").alias("low"), F.max("home").alias("high"))
        .filter("low != high").select("key")
    )
    at_borders = tied.select("key", "node").join(borders, "key")
    # Units are named by a home's 16 bytes or a bucket's eight.
    parts = stored(
        homes.select(F.col("home").alias("unit"), "node")
        .union(at_borders.select(F.unhex(F.lpad(F.hex("key"), 16, "0")), "node"))
        .join(nodes.select("node", "size"), "node"),
        "parts",
    )
    blocks = parts.groupBy("unit").agg(
        F.ceil(F.greatest(F.sum("size") / BLOCK_GRAMS, F.count("*") / BLOCK_DOCS))
        .cast("int").alias("blocks"),
        F.count("*").alias("n"),
    ).filter("n > 1").drop("n")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    # A document is in one home and at most as many buckets as there are bands.
    members = stored(
        parts.join(blocks, "unit").groupBy("node")
        .agg(F.collect_list(F.struct("unit", "blocks", block)).alias("units"))
        .join(homes, "node").join(nodes.select("node", "copies", "first", "bands"), "node"),
        "members",
    )
    # Few documents have a candidate: a bitmap keeps most texts out of the shuffle.
    texts = flagged(
        docs.select(F.col("doc_id").alias("first"), text_or_empty().cast("binary").alias("text")),
        bitmap(members, "first", words=_WORDS), "near", "first", words=_WORDS,
    ).filter("near").drop("near")
    units = members.hint("merge").join(texts, "first").mapInArrow(
        _sets, f"unit binary, left int, right int, {_MEMBER}"
    )
    verified = stored(
        units.groupBy(*_UNIT).applyInArrow(_verify(threshold), "node binary, links long, root binary"),
        "verified",
    )
    linked = components(verified.select("node", "root"))
    named = (
        nodes.select("node", "first", "copies")
        .join(verified.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
        .join(linked, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    names = named.groupBy("root").agg(F.min("first").alias("class_id"))
    found = named.join(names, "root").select(
        "node", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    alone = F.col("doc_id").isNull() | F.col("class_id").isNull()
    return rows.select("doc_id", "node", "n_grams").join(found, "node", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        "n_grams",
    )


def representatives(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class, with all its columns: that of the least id.

    Rows are told apart by id and text, so that those without an id, or under
    one, have classes as all others; of rows that share both, one stays.
    """
    named = docs.withColumn("_key", row_key(F.col("doc_id"), F.xxhash64(text_or_empty())))
    heads = (
        classes(named.select(F.col("_key").alias("doc_id"), "text")).filter("doc_id = class_id")
        .select(F.col("doc_id").alias("_key")).distinct()
    )
    first = Window.partitionBy("_key").orderBy("_key")
    return (
        named.join(heads, "_key").withColumn("_nth", F.row_number().over(first)).filter("_nth = 1")
        .select(docs.columns)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
