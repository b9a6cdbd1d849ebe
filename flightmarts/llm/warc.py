"""WARC archives: written by Spark's text writer, read back by boundary-chain verification."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightmarts.llm.common import bitmap, flagged, stored, table
from flightmarts.session import scratch_dir

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
LEAST_REVISIT = 100  # bytes; smaller payloads are stored in full each time
RECORDS_PER_FILE = 50_000
_DATE = "2024-01-01T00:00:00Z"


def _header(name: str, value: Column) -> Column:
    """A header line; nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame) -> DataFrame:
    """The text of one WARC record per row of ``pages``, without its last line ends.

    Equal payloads are found by size and SHA-256; which page has the smallest id
    is counted on the map side. Only groups of two or more are looked up again,
    from a stored table whose size decides how it is joined; a payload that
    fills a third of all pages is split by adaptive execution.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    sized = pages.select(
        "page_id", "url", payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    first = stored(
        sized.filter(F.col("size") >= LEAST_REVISIT).groupBy("digest", "size")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1").drop("n"),
        "payloads",
    )
    found = sized.join(first, ["digest", "size"], "left")
    revisit = F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull())
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    urn = F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))
    refers = F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))
    url = F.regexp_replace("url", r"[\r\n]+", " ")
    return found.select(
        F.concat(
            F.lit(MAGIC),
            _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            _header("WARC-Record-ID", urn),
            _header("WARC-Date", F.lit(_DATE)),
            _header("WARC-Target-URI", url),
            _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            _header("WARC-Refers-To", F.when(revisit, refers)),
            _header("X-Payload-Length", F.col("size").cast("string")),
            _header("Content-Type", F.lit("text/html; charset=utf-8")),
            _header("Content-Length", F.octet_length(body).cast("string")),
            F.lit("\r\n"),
            body,
        ).alias("value")
    )


def write(pages: DataFrame, path: str) -> None:
    """Archives of ``pages`` under ``path``, uncompressed, one per writing task or more."""
    records(pages).write.option("lineSep", END).option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(path)


def _field(name: str) -> Column:
    """A header's value in ``head``, or null."""
    found = F.regexp_extract(F.concat(F.lit("\r\n"), F.col("head")), rf"(?i)\r\n{name}: *([^\r\n]*)", 1)
    return F.when(found != "", found)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The bytes after each magic, up to the next, in file order by ``at``.

    Spark cuts files into splits of bytes and each split at the magic, wherever
    it stands; so what is inside a payload is cut there as well. ``at`` holds
    for one reading only, as splits may be packed otherwise in the next; ``m1``
    and ``m2`` name the bytes themselves.
    """
    return spark.read.option("lineSep", MAGIC).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("at"),
        F.xxhash64("value").alias("m1"),
        F.xxhash64(F.lit("b"), "value").alias("m2"),
    )


def _parsed(segments: DataFrame) -> DataFrame:
    """Segments by size, header fields, and digest of the payload if it is all there."""
    has_head = F.instr("value", END) > 0
    # A record may begin with an empty line after the magic only if it has no header.
    with_head = segments.withColumn(
        "head", F.when(has_head, F.substring_index("value", END, 1))
    ).withColumn("raw", F.col("value").cast("binary"))
    length = _field("Content-Length").cast("long")
    start = F.octet_length("head") + len(END)
    sized = with_head.withColumns({"length": length, "start": start}).withColumn(
        "whole", F.octet_length("raw") == F.col("start") + F.col("length") + len(END)
    )
    payload = F.substring(F.col("raw"), F.col("start") + 1, F.col("length").cast("int"))
    page = r"<urn:page:(-?[0-9]+)>"
    return sized.select(
        "file", "split", "file_size", "at", "m1", "m2",
        F.octet_length("raw").cast("long").alias("size"),
        "start", "length", F.coalesce("whole", F.lit(False)).alias("whole"),
        F.when(F.col("whole"), F.sha2(payload, 256)).alias("read_digest"),
        _field("WARC-Type").alias("record_type"),
        F.regexp_extract(F.coalesce(_field("WARC-Record-ID"), F.lit("")), page, 1).alias("page_id"),
        F.regexp_extract(F.coalesce(_field("WARC-Refers-To"), F.lit("")), page, 1).alias("refers_to"),
        F.regexp_extract(
            F.coalesce(_field("WARC-Payload-Digest"), F.lit("")), "sha256:([0-9a-f]+)", 1
        ).alias("digest"),
        _field("X-Payload-Length").cast("long").alias("payload_length"),
    )


def _with_offsets(parsed: DataFrame) -> DataFrame:
    """Candidates: offset of each segment's magic and of the record that should follow.

    Sizes are summed within splits, then over the splits of a file.
    """
    step = F.col("size") + len(MAGIC)
    own = Window.partitionBy("file", "split").orderBy("at")
    ends = parsed.withColumn("end", F.sum(step).over(own))
    sums = parsed.groupBy("file", "split").agg(F.sum(step).alias("n"))
    before = sums.withColumn(
        "before", F.sum("n").over(Window.partitionBy("file").orderBy("split")) - F.col("n")
    ).drop("n")
    # What stands before a file's first magic is a segment too, of no record.
    offset = F.col("before") + F.col("end") - step - len(MAGIC)
    after = F.col("offset") + len(MAGIC) + F.col("start") + F.col("length") + len(END)
    return (
        ends.join(before, ["file", "split"]).withColumn("offset", offset)
        .filter("offset >= 0").withColumn("after", after).drop("before", "end")
    )


def reachable(candidates: DataFrame, rounds: int = 64) -> DataFrame:
    """``file, offset`` of the records on the chain that begins at each file's start.

    Pointer jumping: in each round the reached offsets take the jumps of that
    round, and jumps double. Rounds grow with the logarithm of a file's records.
    """
    jumps = candidates.filter("after IS NOT NULL").select("file", "offset", "after")
    reached = stored(
        candidates.select("file").distinct().withColumn("offset", F.lit(0).cast("long")), "reached"
    )
    count = reached.count()
    for _ in range(rounds):
        landed = reached.join(jumps.hint("merge"), ["file", "offset"]).select("file", F.col("after").alias("offset"))
        reached = stored(reached.union(landed).distinct(), "reached")
        before, count = count, reached.count()
        if count == before:
            return reached
        further = jumps.select("file", F.col("offset").alias("after"), F.col("after").alias("then"))
        jumps = stored(
            jumps.hint("merge").join(further, ["file", "after"]).select("file", "offset", F.col("then").alias("after")),
            "jumps",
        )
    raise RuntimeError(f"records not found in {rounds} rounds")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` per record.

    Raises if a file's chain does not end at the file's end, or if a payload
    does not have the digest its header says.
    """
    segments = _segments(spark, path)
    candidates = stored(_with_offsets(stored(_parsed(segments), "segments")), "candidates")
    chain = reachable(candidates)
    own = candidates.join(chain.hint("merge"), ["file", "offset"], "left_semi")
    ends = own.groupBy("file").agg(F.max("after").alias("end"), F.max("file_size").alias("size"))
    if ends.filter("end IS NULL OR end != size").head(1):
        raise ValueError("an archive does not end with a whole record")
    whole = own.filter("whole").select("file", "offset", F.col("read_digest").alias("read"))
    # Records cut by magic inside their payload: their pieces meet again.
    cut = stored(own.filter("NOT whole").select("file", "offset", "start", "length"), "cut")
    starts = chain.withColumn("record", F.col("offset"))
    so_far = Window.partitionBy("file").orderBy("offset")
    pieces = (
        candidates.select("file", "offset", "m1", "m2").join(starts.hint("merge"), ["file", "offset"], "left")
        .withColumn("record", F.last("record", ignorenulls=True).over(so_far))
        .select("file", F.col("offset").alias("piece"), F.col("record").alias("offset"), "m1", "m2")
        .join(cut, ["file", "offset"])
    )
    # Their bytes are the only ones that are shuffled, equal ones once per task: a bitmap
    # leaves the rest. They are found by their hash, wherever this reading comes by them.
    pieces = stored(pieces, "pieces")
    needed = flagged(
        segments.select("value", "m1", "m2"), bitmap(pieces, "m1", "m2"), "needed", "m1", "m2"
    )
    joined = (
        needed.filter("needed").groupBy("m1", "m2").agg(F.first("value").alias("value"))
        .join(pieces.hint("merge"), ["m1", "m2"])
        .groupBy("file", "offset", "start", "length")
        .agg(F.sort_array(F.collect_list(F.struct("piece", F.col("value").cast("binary").alias("v")))).alias("p"))
        .select(
            "file", "offset",
            F.sha2(
                F.expr(
                    f"substring(aggregate(slice(p, 2, size(p)), p[0].v,"
                    f" (a, x) -> concat(a, encode('{MAGIC[:-2]}\\r\\n', 'UTF-8'), x.v)),"
                    " start + 1, CAST(length AS INT))"
                ),
                256,
            ).alias("read"),
        )
    )
    digests = whole.unionByName(joined)
    response = F.col("record_type") == "response"
    found = own.hint("merge").join(digests, ["file", "offset"]).withColumn(
        "right", ~response | (F.col("read") == F.col("digest"))
    )
    sound = F.when(F.col("right"), F.col("digest")).otherwise(
        F.raise_error(F.lit("a payload differs from its digest")).cast("string")
    )
    return found.select(
        F.when(F.col("page_id") != "", F.col("page_id").cast("long")).alias("page_id"),
        F.when(response, F.col("length")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        sound.alias("payload_digest"),
        "record_type",
        F.when(F.col("refers_to") != "", F.col("refers_to").cast("long")).alias("refers_to"),
    )


def archived(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes ``pages`` as archives (under ``path``, or scratch) and reads them back.

    One row per row of ``pages``. A null ``html`` is an empty payload, always
    stored in full, as are all under 100 bytes. A null ``page_id`` comes back as
    null and is never referred to unless a whole group has none. Rows that
    repeat the smallest id are all responses. Line ends in a ``url`` become
    spaces, a null one is left out. An empty table gives no records. Reads
    ``page_id``, ``url`` and ``html`` only.
    """
    spark = pages.sparkSession
    path = path or f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    return read(spark, path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


ORACLE = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), g AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id != first THEN 'revisit' ELSE 'response' END
           AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id != first THEN first END AS refers_to
FROM g
"""
