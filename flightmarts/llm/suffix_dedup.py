"""Repeated byte strings by sorting suffixes, and the texts without them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.llm.common import bitmap, flagged, small_batches, stored, table, text_or_empty
from flightmarts.llm.hashing import Prefixes, mix

LENGTH = 400  # bytes of a string that counts as repeated
# Every string has one suffix that stands for it, which begins in its first so many bytes.
REACH = 200
LEAD = LENGTH - REACH + 1  # bytes such a suffix shares with any equal string
STEP = 32  # strings of a suffix that are compared together
TOKEN = 50  # bytes of a token
_CHUNK = 4_000_000  # bytes of content sorted at a time
# Groups of at most so many rows (431 bytes each) meet in a task; strings of larger ones are counted.
GROUP_ROWS = 1000
_WORDS = 1 << 16  # of the bitmaps: 512 KB
_U = np.uint64


def sampled_suffixes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes that stand for all strings of ``data``, with first and last string of each.

    A string is stood for by the suffix at the least hash of eight bytes in its
    first 200 positions, the first of equals. That depends on the string alone,
    so equal strings have equal suffixes at the same distance; and neighbouring
    strings share a suffix, so one in about a hundred is left.
    """
    count = len(data) - LENGTH + 1
    if count < 1:
        none = np.zeros(0, np.int64)
        return none, none, none
    need = count + REACH - 1
    eights = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)[:need])
    values = eights.view(_U).reshape(-1) * _U(0x9E3779B97F4A7C15)
    values ^= values >> _U(29)
    values *= _U(0xBF58476D1CE4E5B9)
    keys = (values >> _U(32) << _U(32)) | np.arange(need, dtype=_U)
    # Sliding minimum from minima up to and from the borders of blocks.
    padded = np.full(-(-need // REACH) * REACH, 0xFFFFFFFFFFFFFFFF, _U)
    padded[:need] = keys
    grid = padded.reshape(-1, REACH)
    upto = np.minimum.accumulate(grid, axis=1).reshape(-1)
    since = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(since[:count], upto[REACH - 1 : REACH - 1 + count])
    at = (least & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first], first, np.r_[first[1:], count] - 1


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text and distinct suffix: hashes of its lead and of all it stands for."""
    for batch in batches:
        columns: list[list] = [[] for _ in range(7)]
        for t1, t2, text in zip(*(batch.column(n) for n in ("t1", "t2", "text")), strict=True):
            data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
            at, first, last = sampled_suffixes(data)
            if not len(at):
                continue
            hashes = Prefixes(data)
            lead = hashes.of(at, at + LEAD)
            left, strings = at - first, last - first + 1
            whole = mix(hashes.of(first, last + LENGTH) + (left * 1024 + strings).astype(_U))
            order = np.lexsort((whole, lead))
            new = np.r_[True, (lead[order][1:] != lead[order][:-1]) | (whole[order][1:] != whole[order][:-1])]
            heads = order[new]
            ends = np.r_[np.flatnonzero(new)[1:], len(order)]
            rows = len(heads)
            columns[0].append(np.full(rows, t1.as_py()))
            columns[1].append(np.full(rows, t2.as_py()))
            columns[2].append(lead[heads].view(np.int64))
            columns[3].append(whole[heads].view(np.int64))
            columns[4].append((first[order].astype(np.int32), np.diff(np.r_[0, ends])))
            columns[5].append(strings[heads].astype(np.int32))
            columns[6].append(left[heads].astype(np.int32))
        if columns[0]:
            sizes = np.concatenate([s for _, s in columns[4]])
            starts = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)),
                pa.array(np.concatenate([f for f, _ in columns[4]])),
            )
            flat = [pa.array(np.concatenate(c)) for i, c in enumerate(columns) if i != 4]
            yield pa.RecordBatch.from_arrays(
                [*flat[:4], starts, *flat[4:]],
                ["t1", "t2", "lead", "whole", "starts", "strings", "left"],
            )


_SUFFIX = "t1 long, t2 long, lead long, whole long, starts array<int>, strings int, left int"


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes with the bytes of their strings, a row per 32 strings at most.

    Equal strings lie at the same distance from their suffix, so they are in
    rows of the same step, which share the bytes that all strings of the step
    have: their hash is a second token to deal rows out by.
    """
    names = ["t1", "t2", "lead", "step", "core", "away", "start", "many", "content"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for t1, t2, text, found in zip(
            *(batch.column(n) for n in ("t1", "t2", "text", "found")), strict=True
        ):
            data = text.as_py()
            hashes = Prefixes(np.frombuffer(data, np.uint8))
            t1, t2 = t1.as_py(), t2.as_py()
            for s in found.as_py():
                low = s["start"]
                at, high = low + s["left"], low + s["strings"] - 1
                for step in range((at - high) // STEP, (at - low) // STEP + 1):
                    from_, to = max(low, at - step * STEP - STEP + 1), min(high, at - step * STEP)
                    core = at - step * STEP
                    mark = hashes.of(np.array([core]), np.array([core - STEP + 1 + LENGTH]))
                    out[0].append(t1)
                    out[1].append(t2)
                    out[2].append(s["lead"])
                    out[3].append(step)
                    out[4].append(int(mark.view(np.int64)[0]))
                    out[5].append(at - from_)
                    out[6].append(from_)
                    out[7].append(s["many"])
                    out[8].append(data[from_ : to + LENGTH])
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types, strict=True)], names)


_CONTENT = (
    "t1 long, t2 long, lead long, step int, core long, away int, start int, many boolean,"
    " content binary"
)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes with the hashes of all their strings, whole."""
    names = ["t1", "t2", "lead", "start", "many", "keys"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for t1, t2, text, found in zip(
            *(batch.column(n) for n in ("t1", "t2", "text", "found")), strict=True
        ):
            hashes = Prefixes(np.frombuffer(text.as_buffer(), np.uint8))
            for s in found.as_py():
                at = s["start"] + np.arange(s["strings"])
                row = (
                    t1.as_py(), t2.as_py(), s["lead"], s["start"], s["many"],
                    hashes.of(at, at + LENGTH).view(np.int64),
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types, strict=True)], names)


_KEYS = "t1 long, t2 long, lead long, start int, many boolean, keys array<long>"


def equal_strings(group: np.ndarray, starts: np.ndarray, hashes: Prefixes, weight: np.ndarray) -> np.ndarray:
    """Whether each string has an equal in its group (or stands for several itself).

    Multikey quicksort, all parts in step: each round splits every part by the
    next token of its strings, and parts of one string are done. What is left
    after the last token is equal.
    """
    repeated = weight > 1
    live = np.arange(len(starts))
    part = group
    for token in range(0, LENGTH, TOKEN):
        if not len(live):
            return repeated
        at = starts[live] + token
        key = hashes.of(at, at + TOKEN)
        order = np.lexsort((key, part))
        live, part, key = live[order], part[order], key[order]
        new = np.r_[True, (part[1:] != part[:-1]) | (key[1:] != key[:-1])]
        part = np.cumsum(new)
        many = np.bincount(part)[part] > 1
        live, part = live[many], part[many]
    repeated[live] = True
    return repeated


def _compared(rows: list[dict]) -> tuple[list, list, list, list]:
    """Runs of bytes that repeated strings cover, for rows of whole groups."""
    contents = [r["content"] for r in rows]
    at = np.cumsum([0, *map(len, contents)])
    hashes = Prefixes(np.frombuffer(b"".join(contents), np.uint8))
    counts = np.array([len(c) for c in contents]) - LENGTH + 1
    row = np.repeat(np.arange(len(rows)), counts)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    keys: dict[tuple, int] = {}
    group = np.array([keys.setdefault((r["lead"], r["step"], r["core"]), len(keys)) for r in rows])
    away = np.array([r["away"] for r in rows])[row] - offset
    weight = np.array([1 + r["many"] for r in rows])[row]
    hit = equal_strings(group[row] * LENGTH + away, at[row] + offset, hashes, weight)
    edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]) | np.r_[0, np.diff(row) != 0, 0])
    t1s, t2s, froms, tos = [], [], [], []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        own = rows[row[a]]
        if hit[a] and not own["many"]:
            t1s.append(own["t1"])
            t2s.append(own["t2"])
            froms.append(own["start"] + int(offset[a]))
            tos.append(own["start"] + int(offset[b - 1]) + LENGTH)
    return t1s, t2s, froms, tos


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of suffixes, ordered by lead, step and core: whole groups at a time."""
    held: list[dict] = []
    size, last = 0, None

    def done() -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(_compared(held), types, strict=True)], ["t1", "t2", "a", "b"]
        )

    for batch in batches:
        for r in batch.to_pylist():
            group = (r["lead"], r["step"], r["core"])
            if size > _CHUNK and group != last:
                yield done()
                held, size = [], 0
            held.append(r)
            size += len(r["content"])
            last = group
    if held:
        yield done()


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, spans, kept = [], [], []
        for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
            data = text.as_py()
            pairs = sorted((x["a"], x["b"]) for x in runs.as_py() or ())
            merged: list[list[int]] = []
            for a, b in pairs:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            ends = [0, *(x for pair in merged for x in pair), len(data)]
            rest = b"".join(data[ends[i] : ends[i + 1]] for i in range(0, len(ends), 2))
            removed.append(len(data) - len(rest))
            spans.append(len(merged))
            kept.append(rest)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()), pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def repeated_runs(texts: DataFrame) -> DataFrame:
    """``t1, t2, runs``: byte runs of each text that repeated strings cover; stored.

    ``texts`` has ``t1, t2`` (128 bits of hash that name a text) and ``text`` as
    bytes, a row per document. Copies of a text are several documents of one name.

    1. Each text is cut down to its sampled suffixes, about one in a hundred.
       Suffixes whose lead of 201 bytes occurs once cannot hold a repeated string
       and go; if all that share a lead stand for the very same bytes, all of
       their strings are repeated, as identical suffixes lie side by side in
       any order. Leads are counted on the map side first.
    2. Of the rest, suffixes that stand for the very same bytes as others are
       repeated likewise, and one of them is compared with those of other bytes.
       What is compared is distinct, so a lead has as many rows as it has kinds.
    3. For leads of few kinds the bytes are fetched, at most 32 strings to a row,
       from one copy of each text. Splitters sampled by Spark deal rows out in
       ranges of lead, step and core; equal strings have equal keys, so no range
       border can lie between them. Each range sorts its groups by multikey
       quicksort and compares neighbours.
    4. Leads of over ``GROUP_ROWS`` kinds would make groups that outgrow a task.
       Their strings are counted by the hash of all their bytes, on the map side
       first, and the counts over one joined back; no group is ever held.
    """
    suffixes = texts.mapInArrow(_suffixes, _SUFFIX)
    leads = stored(
        suffixes.groupBy("lead")
        .agg(
            F.sum(F.size("starts")).alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high")
        )
        .filter("n > 1").select("lead", (F.col("low") == F.col("high")).alias("same")),
        "leads",
    )
    hits = stored(suffixes.join(leads.hint("merge"), "lead"), "suffixes")
    kinds = stored(
        hits.filter("NOT same").groupBy("lead", "whole").agg(
            (F.sum(F.size("starts")) > 1).alias("many"),
            F.min(F.struct("t1", "t2", F.col("starts")[0].alias("start"), "strings", "left")).alias("own"),
        ),
        "kinds",
    )
    again = stored(kinds.filter("many").select("lead", "whole"), "again")
    alike = hits.filter("NOT same").join(again.hint("merge"), ["lead", "whole"])
    same = hits.filter("same").select("t1", "t2", "starts", "strings").unionByName(
        alike.select("t1", "t2", "starts", "strings")
    ).select(
        "t1", "t2",
        F.transform(
            "starts",
            lambda s: F.struct(s.alias("a"), (s + F.col("strings") - 1 + LENGTH).alias("b")),
        ).alias("runs"),
    ).select("t1", "t2", F.inline("runs"))
    wide = stored(
        kinds.groupBy("lead").agg(F.count("*").alias("n"))
        .select("lead", (F.col("n") > GROUP_ROWS).alias("wide")).filter("wide"),
        "wide",
    )
    open_ = stored(
        kinds.join(wide, "lead", "left")
        .select("lead", "many", "own.*", F.col("wide").isNotNull().alias("wide"))
        .groupBy("t1", "t2", "wide")
        .agg(F.collect_list(F.struct("lead", "start", "strings", "left", "many")).alias("found")),
        "open",
    )

    def fetched(some: DataFrame) -> DataFrame:
        """One copy of each text that ``some`` has suffixes of, with these."""
        near = flagged(texts, bitmap(some, "t1", "t2", words=_WORDS), "near", "t1", "t2", words=_WORDS)
        once = near.filter("near").groupBy("t1", "t2").agg(F.first("text").alias("text"))
        return once.join(some.hint("merge"), ["t1", "t2"])

    compared = (
        fetched(open_.filter("NOT wide")).mapInArrow(_contents, _CONTENT)
        .repartitionByRange("lead", "step", "core")
        .sortWithinPartitions("lead", "step", "core")
        .mapInArrow(_bucket, "t1 long, t2 long, a int, b int")
    )
    keys = stored(fetched(open_.filter("wide")).mapInArrow(_keys, _KEYS), "keys")
    strings = keys.select("t1", "t2", "lead", "start", "many", F.posexplode("keys").alias("nth", "key"))
    more = stored(
        strings.groupBy("lead", "key").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("n"))
        .filter("n > 1").select("lead", "key"),
        "more",
    )
    a = F.col("start") + F.col("nth")
    counted = strings.filter("NOT many").join(more.hint("merge"), ["lead", "key"]).select(
        "t1", "t2", a.alias("a"), (a + LENGTH).alias("b")
    )
    runs = same.unionByName(compared).unionByName(counted).groupBy("t1", "t2")
    return stored(runs.agg(F.collect_set(F.struct("a", "b")).alias("runs")), "runs")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``, one row per row of ``docs``.

    Bytes covered by a 400-byte string that also begins elsewhere, in any text
    or the same, are removed; ``kept`` is what is left, as bytes. Strings are
    judged on the input, never across documents. A null text is empty; a text
    under 400 bytes is kept whole; repeated rows are copies of each other. Reads
    ``doc_id`` and ``text`` only; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    named = docs.select("doc_id", text_or_empty().alias("t")).select(
        "doc_id", F.xxhash64("t").alias("t1"), F.xxhash64(F.lit("b"), "t").alias("t2"),
        F.octet_length("t").cast("long").alias("n_bytes"), F.col("t").cast("binary").alias("text"),
    )
    runs = repeated_runs(named.select("t1", "t2", "text"))
    marked = flagged(named, bitmap(runs, "t1", "t2", words=_WORDS), "near", "t1", "t2", words=_WORDS)
    schema = T.StructType([docs.schema["doc_id"]]).add("n_bytes", "long").add("n_removed", "long")
    cut = (
        marked.filter("near").join(runs.hint("merge"), ["t1", "t2"], "left")
        .select("doc_id", "n_bytes", "text", "runs")
        .mapInArrow(_without, schema.add("n_spans", "long").add("kept", "binary"))
    )
    zero = F.lit(0).cast("long")
    whole = marked.filter("NOT near").select(
        "doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").alias("kept")
    )
    return cut.unionByName(whole)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
