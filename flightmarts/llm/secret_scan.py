"""Secrets: fixed formats, and literals that flow into names which say secret."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.llm.common import small_batches, table, text_or_empty
from flightmarts.llm.secret_lexing import THRESHOLD, scored_literals

KINDS = ("assign", "access", "hex", "secret")
# The three formats. ASCII letters alone are matched in either case.
_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16

_SPANS = "array<struct<start:int,kind:int,end:int>>"
Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """``(start, kind, end)`` of the three formats, in order."""
    found = []
    if "=" in text or ":" in text:
        found += [
            (m.start(), 0, m.end()) for m in _ASSIGN.finditer(text)
            if m.end(1) - m.start(1) >= LEAST_VALUE
        ]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end()) for m in _ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST_ACCESS
        ]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def added_spans(text: str, base: list[Span], threshold: int = THRESHOLD) -> list[Span]:
    """Literals that score ``threshold`` or more and lie in no base span, none inside another."""
    if not re.search("[=:]|--|</", text):
        return []
    chosen = sorted(
        (start, -end) for (start, end), score in scored_literals(text).items() if score >= threshold
    )
    starts = [start for start, _, _ in base]
    reach = list(accumulate((end for _, _, end in base), max))
    found: list[Span] = []
    for start, back in chosen:
        end = -back
        inside = found and end <= found[-1][2]
        before = bisect_right(starts, start)
        if not inside and not (before and end <= reach[before - 1]):
            found.append((start, KINDS.index("secret"), end))
    return found


def secret_spans(docs: DataFrame, *carried: str, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id``, ``carried`` columns, ``base`` and ``added`` spans, one row per row of ``docs``.

    Offsets are code points, ends exclusive; ``kind`` numbers ``KINDS``. Base
    spans are the leftmost matches of three formats that pass their checks; of
    two kinds they may overlap. Added are the literals of assignments to
    sensitive names: in source code, key-value files, JSON, YAML, command-line
    options, addresses and elements. A constant, alone, joined by plus signs or
    named in a template, counts for every name that it reaches later in its text.

    A null text is empty; repeated rows are treated alike; an empty table gives
    an empty result. Reads ``doc_id`` and ``text`` only. One scan, no shuffle;
    memory is that of the longest text, and time grows with its length.
    """
    small_batches(docs.sparkSession)
    kept = ["doc_id", *carried]
    schema = T.StructType([docs.schema[c] for c in kept])
    schema = T.StructType(schema.fields).add("base", _parse(_SPANS)).add("added", _parse(_SPANS))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = lambda spans: [dict(zip(("start", "kind", "end"), s)) for s in spans]
        for batch in batches:
            base, added = [], []
            for text in batch.column("_text"):
                text = text.as_py()
                own = base_spans(text)
                base.append(named(own))
                added.append(named(added_spans(text, own, threshold)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(base, kind), pa.array(added, kind)],
                schema.names,
            )

    return docs.select(*kept, text_or_empty().alias("_text")).mapInArrow(run, schema)


def _parse(kind: str) -> T.DataType:
    return T.StructType.fromDDL(f"x {kind}")["x"].dataType


def named_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )
    return F.array_join(F.transform(spans, one), ",")


def redacted(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, text`` with every span replaced by its kind in brackets.

    Spans that overlap become one, named after the first of them.
    """
    small_batches(docs.sparkSession)
    schema = T.StructType([docs.schema["doc_id"]]).add("text", "string")

    def clean(text: str) -> str:
        base = base_spans(text)
        out, at = [], 0
        for start, kind, end in sorted([*base, *added_spans(text, base, threshold)]):
            if start >= at:
                out += [text[at:start], f"[{KINDS[kind]}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [clean(t.as_py()) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], schema.names
            )

    return docs.select("doc_id", text_or_empty().alias("_text")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))
    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[number(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(named_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        named_spans(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
