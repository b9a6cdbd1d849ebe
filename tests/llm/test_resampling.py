from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from odd_documents import SF_DIR, nothing, odd, plain  # noqa: F401
from pyspark.sql import functions as F

from flightmarts.llm import importance_resampling as resampling

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    words = re.findall(WORD, text.translate(FOLD))
    return len(words), [*words, *(" ".join(p) for p in zip(words, words[1:]))]


def plain_resample(docs, target, percent=25, min_words=20):
    """``docs`` of id and text; rows without rank have None."""
    bucket = lambda g: zlib.crc32(g.encode()) % 10_000
    counted = [(i, *grams(t)) for i, t in docs]
    source = Counter(bucket(g) for _, _, own in counted for g in own)
    wanted = Counter(bucket(g) for t in target for g in grams(t)[1])
    size, aim = sum(source.values()) + 10_000, sum(wanted.values()) + 10_000
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * size / ((source[b] + 1) * aim)))
    rows = []
    for i, n, own in counted:
        weight = sum(gain(bucket(g)) for g in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n])
    order = sorted(
        (k for k, r in enumerate(rows) if r[4] >= min_words),
        key=lambda k: (-rows[k][3], rows[k][0] is None, rows[k][0] or 0),
    )
    rank = {k: place for place, k in enumerate(order[: percent * len(order) // 100], 1)}
    return [(*r[:4], rank.get(k)) for k, r in enumerate(rows)]


def test_odd_documents(spark, odd, plain):
    target = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").withColumn("buckets", F.lit("clash"))
    texts = [r["text"] or "" for r in target.collect()]
    expected = plain_resample([(i, t) for i, t, *_ in plain], texts)
    found = resampling.resample(odd, target).drop("tie").collect()
    assert Counter(map(tuple, found)) == Counter(expected)
    ranks = sorted(r["rank"] for r in found if r["rank"])
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) > 10


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_ranks_go_on_over_partitions_and_ties(spark, partitions):
    rows = [(i % 50 if i % 7 else None, "same words in all of them " * (1 + i % 9)) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("other words",), (None,)], "text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = resampling.resample(docs, target, percent=60, min_words=12).drop("tie").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = plain_resample([(i, t) for i, t in rows], ["other words", ""], 60, 12)
    assert Counter(tuple(r)[:4] for r in found) == Counter(r[:4] for r in expected)
    # Rows of one id and score take their places in any order.
    places = lambda some: sorted((r[4], r[3], r[0]) for r in some if r[4])
    assert places(map(tuple, found)) == places(expected) and len(places(expected)) > 200


def test_spans_overlap_and_keep_to_words():
    words = resampling.collapsed("Ab--cd  é9\x00ÀB.x".encode())
    assert words == " ab cd é9 Àb x ".encode()
    spans = [m[0].decode() for m in resampling.gram_pattern(2).finditer(words, overlapped=True)]
    assert spans == ["ab cd", "cd é9", "é9 Àb", "Àb x"]
    assert resampling.collapsed(b" .- ") == b" "


def test_long_texts_are_hashed_in_chunks(monkeypatch):
    text = b"one two three " * 500
    whole = resampling.Grams().counts(text)
    monkeypatch.setattr(resampling, "_CHUNK", 7)
    words, total = resampling.Grams().counts(text)
    assert words == whole[0] == 1500 and (total == whole[1]).all() and total.sum() == 2999


def test_drawn_rows_keep_their_columns(odd, spark):
    target = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    rows = resampling.drawn(odd, target)
    assert rows.columns == odd.columns
    ranked = resampling.resample(odd, target).filter("rank IS NOT NULL")
    assert rows.select("doc_id").distinct().count() == ranked.select("doc_id").distinct().count()


def test_empty_tables(nothing, odd):
    assert resampling.resample(nothing, odd).count() == 0
    assert resampling.resample(odd, nothing).filter("rank IS NOT NULL").count() > 0
