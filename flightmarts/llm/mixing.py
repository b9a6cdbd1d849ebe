"""Mixing sources to target weights by a low-discrepancy schedule of blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightmarts.llm.common import WORD, row_key, stored, table, text_or_empty

GOLDEN = 0.6180339887498949
CAP = 3  # times a source's size that its target may be
# A source is cut into the longest of these blocks of words that its target holds often enough.
BLOCKS, BLOCKS_PER_TARGET = (4096, 512, 64, 8, 1), 1024
_PIECES = 4096  # pieces of a source's shuffled order, summed on their own
_CHUNK = 1 << 16  # slots of the schedule ranked on their own
_CELLS = 4096  # of the unit interval, by which points find their sources
_COPIES = 4096  # equal rows spelled out side by side


def sources_of(sized: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = CAP) -> DataFrame:
    """A row per source: ``source, source_no, source_size, target, block, low, high``; stored.

    Sources by code point, null last; weights repeat. All sizes are shared by
    weight, and what exceeds ``cap`` times a size goes to the others: the least
    room per weight fills first. ``block`` is a source's block length; sources of
    one length share a schedule, in which ``low`` to ``high`` is a source's part.

    Windows run over a row per source, however many documents there are.
    """
    named = Window.orderBy(F.asc_nulls_last("source"))
    sizes = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    numbered = sizes.withColumn("source_no", F.row_number().over(named) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("source_no") % len(weights) + 1)
    by_room = Window.orderBy("room", "source_no")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy()
    sum_before = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    roomy = numbered.withColumns({"w": weight, "most": cap * F.col("source_size").cast("double")})
    shared = roomy.withColumn("room", F.col("most") / F.col("w")).withColumns(
        {
            "rest": F.sum("source_size").over(all_).cast("double") - sum_before("most"),
            "left": F.sum("w").over(all_) - sum_before("w"),
        }
    )
    # Full sources come first; from the first with room on, what is left is shared by weight.
    full = F.min((F.col("rest") * F.col("w") >= F.col("most") * F.col("left")).cast("int")).over(
        by_room.rowsBetween(Window.unboundedPreceding, 0)
    )
    shared = shared.withColumn("full", full)
    open_ = lambda c: F.max(F.when(F.col("full") == 0, F.col(c))).over(all_)
    target = F.when(F.col("full") == 1, F.col("most")).otherwise(open_("rest") * F.col("w") / open_("left"))
    block = F.coalesce(
        *[F.when(F.col("target") >= b * BLOCKS_PER_TARGET, b) for b in BLOCKS[:-1]], F.lit(BLOCKS[-1])
    )
    cut = shared.withColumn("target", target).withColumn("block", block)
    own = Window.partitionBy("block")
    high = F.sum("target").over(own.orderBy("source_no")) / F.nullif(F.sum("target").over(own), F.lit(0.0))
    return stored(
        cut.withColumn("high", F.coalesce(high, F.lit(0.0)))
        .withColumn("low", F.coalesce(F.lag("high").over(own.orderBy("source_no")), F.lit(0.0)))
        .select("source", "source_no", "source_size", "target", "block", "low", "high"),
        "sources",
    )


def schedule(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """``source_no, block_no, passes``: how often the mix takes each block of a source; stored.

    Per block length, slot ``t`` of the mix is the point ``frac(t * golden ratio)``;
    the source whose part of the cumulative targets holds it gets the slot, so
    that any stretch of the mix has nearly the target shares. A source's slots
    are ranked, within chunks and then over the chunks' sums, and slot ``k`` takes
    block ``k`` modulo its blocks, three times at most. A source has at most
    8,192 slots unless its blocks are the longest, whatever the other sources are.
    """
    totals = sources.groupBy("block").agg(F.sum("target").alias("total")).orderBy("block").collect()
    point = (F.col("id") + 1) * F.lit(GOLDEN)
    slots = [
        spark.range(round(row["total"] / row["block"])).select(
            "id", F.lit(row["block"]).alias("block"), (point - F.floor(point)).alias("point")
        )
        for row in totals
    ] or [spark.range(0).selectExpr("id", "0 AS block", "0.0D AS point")]
    points = slots[0]
    for more in slots[1:]:
        points = points.unionAll(more)
    cell = lambda x: F.floor(x * _CELLS).cast("int")
    parts = sources.filter("high > low").select(
        "source_no", "block", "low", "high", F.ceil(F.col("source_size") / F.col("block")).alias("own"),
        F.explode(F.sequence(cell(F.col("low")), F.least(cell(F.col("high")), F.lit(_CELLS - 1)))).alias("cell"),
    )
    # The last part of a length is open to one, whatever its sum was rounded to.
    last = F.max("high").over(Window.partitionBy("block"))
    parts = parts.withColumn("high", F.when(F.col("high") == last, F.lit(2.0)).otherwise(F.col("high")))
    placed = (
        points.withColumn("cell", cell(F.col("point"))).join(parts, ["block", "cell"])
        .filter("point >= low AND point < high")
        .select("source_no", "own", "id", (F.col("id") / _CHUNK).cast("long").alias("chunk"))
    )
    sums = placed.groupBy("source_no", "chunk").agg(F.count("*").alias("n"))
    before = sums.withColumn(
        "before",
        F.sum("n").over(Window.partitionBy("source_no").orderBy("chunk")) - F.col("n"),
    ).drop("n")
    in_chunk = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("id"))
    ranked = placed.withColumn("nth", in_chunk - 1).join(before, ["source_no", "chunk"])
    return stored(
        ranked.select("source_no", (F.col("before") + F.col("nth")).alias("rank"), "own")
        .filter(f"own > 0 AND rank < {CAP} * own")
        .groupBy("source_no", F.expr("rank % own").alias("block_no"))
        .agg(F.count("*").alias("passes")),
        "schedule",
    )


def sized_documents(docs: DataFrame) -> DataFrame:
    """``source, doc_id, mark, size, n``: equal rows once, with their number; stored.

    ``mark`` is a hash of the text, ``size`` its words.
    """
    size = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    rows = docs.select("source", "doc_id", F.xxhash64(text_or_empty()).alias("mark"), size.alias("size"))
    return stored(rows.groupBy("source", "doc_id", "mark", "size").agg(F.count("*").alias("n")), "sizes")


def _streamed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Groups of equal rows with ``start``: the place of their words in their source's order.

    The order is that of a hash of id and text. Places are summed over fixed
    pieces of it first, and a group of equal rows is one row: a source with a
    third of all documents is spread over 4,096 windows.
    """
    own = sources.select(F.col("source").alias("_source"), "source_no", "block")
    order = F.xxhash64("doc_id", "mark", F.lit("mix"))
    placed = (
        sized.join(own, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
        .withColumns({"h": order, "piece": F.pmod(order, F.lit(_PIECES)), "words": F.col("size") * F.col("n")})
    )
    sums = placed.groupBy("source_no", "piece").agg(F.sum("words").alias("total"))
    before = sums.withColumn(
        "before",
        F.sum("total").over(Window.partitionBy("source_no").orderBy("piece")) - F.col("total"),
    ).drop("total")
    in_piece = Window.partitionBy("source_no", "piece").orderBy("h", "doc_id", "mark")
    ends = F.sum("words").over(in_piece.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        placed.withColumn("end", ends).join(before, ["source_no", "piece"])
        .withColumn("start", F.col("before") + F.col("end") - F.col("words"))
        .drop("piece", "words", "end", "before")
    )


def _each_copy(groups: DataFrame) -> DataFrame:
    """A row for each of the ``n`` equal rows of a group, numbered by ``copy``; large groups are spread."""
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _COPIES))
    spread = groups.withColumn("chunk", F.explode(chunks)).repartition("h", "chunk")
    first = F.col("chunk") * _COPIES
    last = F.least(F.col("n"), first + _COPIES) - 1
    return (
        spread.withColumn("copy", F.explode(F.sequence(first, last)))
        .withColumn("start", F.col("start") + F.col("copy") * F.col("size")).drop("chunk", "n", "h")
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, mark``, one row per row of ``docs``.

    Size is the words of the text, ``taken`` the words the mix takes of it over
    all passes, ``copies`` how often the block holding its first word is taken.
    Reads ``doc_id``, ``text`` and ``source`` only. A null or blank text has
    size 0 and is never taken. A null source is a source of its own, after all
    others. Repeated rows count each. An empty table gives an empty result.

    Within its source a document's place follows a hash of its id and text, so
    reruns agree, however files are split. The shuffled source is one stream of
    words cut into equal blocks; a document has a piece in each block it reaches.
    Lengths of blocks are each source's own, so that a small source makes no
    short blocks for the others. Only sizes are shuffled.
    """
    spark = docs.sparkSession
    sized = sized_documents(docs)
    sources = sources_of(sized, weights)
    taken_blocks = schedule(spark, sources)
    # Blocks behind the last that is taken need no pieces.
    upto = taken_blocks.groupBy("source_no").agg((F.max("block_no") + 1).alias("upto"))
    rows = _each_copy(_streamed(sized, sources)).join(upto, "source_no", "left")
    block, start, size = F.col("block"), F.col("start"), F.col("size")
    end = F.least(start + size, F.coalesce("upto", F.lit(0)) * block)
    reached = F.when(end > start, F.sequence(F.floor(start / block), F.floor((end - 1) / block))).otherwise(
        F.array(F.lit(-1).cast("long"))
    )
    number = F.col("block_no")
    pieces = rows.select("*", F.explode(reached).alias("block_no")).select(
        "source_no", "doc_id", "mark", "size", "copy", "block_no",
        (number * block <= start).alias("first"),
        (F.least(start + size, (number + 1) * block) - F.greatest(start, number * block)).alias("words"),
    )
    none = F.lit(0).cast("long")
    taken = (
        pieces.join(taken_blocks, ["source_no", "block_no"], "left")
        .groupBy("source_no", "doc_id", "mark", "size", "copy")
        .agg(
            F.coalesce(F.sum(F.col("words") * F.col("passes")), none).alias("taken"),
            F.coalesce(F.sum(F.when(F.col("first"), F.col("passes"))), none).alias("copies"),
        )
    )
    figures = sources.select("source_no", "source_size", "target")
    return taken.join(figures, "source_no").select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "mark"
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix of whole documents: each row of ``docs`` as often as the mix begins it.

    A row is found again by its id and text. Rows equal in both are one document
    here, of which one row (the least by a hash of its columns) comes as often
    as all of them together.
    """
    key = row_key(F.col("doc_id"), F.col("mark"))
    often = (
        mix(docs).filter("copies > 0").groupBy(key.alias("_key"))
        .agg(F.sum("copies").alias("_copies"))
    )
    own = docs.withColumn("_key", row_key(F.col("doc_id"), F.xxhash64(text_or_empty())))
    found = own.join(often, "_key")
    first = Window.partitionBy("_key").orderBy(F.xxhash64(*[found[c] for c in docs.columns]))
    # Few rows come very often, and then in parts.
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / _COPIES))
    in_part = F.least(F.lit(_COPIES).cast("long"), F.col("_copies") - F.col("_part") * _COPIES)
    return (
        found.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1")
        .withColumn("_part", F.explode(parts))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), in_part)))
        .select(docs.columns)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("mark")
