from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from odd_documents import nothing, odd, plain  # noqa: F401

from flightmarts.llm import collocations

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def pieces(text):
    folded = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", folded)]


def plain_collocations(rows, longest=5, least=100, first=2000):
    """``rows`` of language and text, phrase by phrase."""
    found, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in pieces(text or ""):
            total[lang or "und"] += len(piece)
            for k in range(1, longest + 1):
                found[lang or "und"].update(tuple(piece[i : i + k]) for i in range(len(piece) - k + 1))
    for lang in sorted(found):
        f, n, scored = found[lang], total[lang], []
        frequent = [p for p in f if len(p) > 1 and f[p] >= least]
        inside = {
            b[i : i + k] for b in frequent for k in range(2, len(b)) for i in range(len(b) - k + 1)
            if 100 * f[b] >= 100 * f[b[i : i + k]]
        }
        for p in frequent:
            if p not in inside:
                score, _, left, right = min(
                    (1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                    for k in range(1, len(p))
                )
                scored.append((-score, -f[p], " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:first], 1):
            yield lang, rank, phrase.decode(), -a, left, right, n, -score


def result(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"least": 20, "first": 7}, {"least": 2, "longest": 3}])
def test_odd_documents(odd, plain, options):
    expected = sorted(plain_collocations([(lang, text) for _, text, lang, _ in plain], **options))
    assert len(expected) > 3
    assert result(collocations.collocations(odd, **options)) == expected


def test_few_buckets_change_nothing(spark, odd, plain, monkeypatch):
    """With buckets that nearly all fill up, windows travel whole and the counts are the same."""
    monkeypatch.setattr(collocations, "BITS", 8)
    monkeypatch.setattr(collocations, "_PAGE_BITS", 5)
    monkeypatch.setattr(collocations, "_CHUNK", 300)
    monkeypatch.setattr(collocations, "_HELD", 40)
    expected = sorted(plain_collocations([(lang, text) for _, text, lang, _ in plain], least=20))
    assert result(collocations.collocations(odd, least=20)) == expected


def test_ties_cuts_and_covered_phrases(spark):
    rows = [
        ("x", "a a a a, A b\tc. a b c! new york city hall; d\re"),
        (None, "und one two"), ("und", "one two"), ("x", None), ("x", ""), ("y", "é É é É.é É"),
    ] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    expected = sorted(plain_collocations(rows, least=3))
    assert result(collocations.collocations(docs, least=3)) == expected
    phrases = {(lang, p) for lang, _, p, *_ in expected}
    assert ("x", "new york city hall") in phrases and ("x", "york city") not in phrases
    assert ("und", "one two") in phrases and ("y", "é É") in phrases


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = 3_000_000_000_000
    score = spark.range(1).select(
        F.expr(
            f"(CAST(1000 AS DECIMAL(4,0)) * (CAST({big} AS DECIMAL(17,0)) * CAST({big + 7} AS DECIMAL(17,0))))"
            f" DIV (CAST({big + 1} AS DECIMAL(19,0)) * CAST({big + 3} AS DECIMAL(19,0)))"
        )
    ).first()[0]
    assert score == 1000 * big * (big + 7) // ((big + 1) * (big + 3))


def test_chunks_are_cut_between_pieces_only(monkeypatch):
    monkeypatch.setattr(collocations, "_CHUNK", 10)
    texts = ["one two three four five six", "a b. c d e f g h i j k l, m n o", ""]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["x"] * 3), pa.array([t.encode() for t in texts])], ["lang", "text"]
    )
    whole, cut = Counter(), Counter()
    for text in texts:
        for piece in pieces(text):
            whole.update(zip(piece, piece[1:]))
    for lang, text in collocations._chunks(iter([batch])):
        words = collocations.Words(lang, text)
        spelled = [words.distinct[int(c)].as_py() for c in words.codes]
        cut.update((spelled[i], spelled[i + 1]) for i in np.flatnonzero(words.adjacent))
    assert cut == whole


def test_only_frequent_windows_travel(spark):
    """Of words that are rare nothing but their number is shuffled."""
    text = " ".join(f"rare{i} word{i % 3}" for i in range(900))
    docs = spark.createDataFrame([("x", text)], "lang string, text string")
    shared = spark.sparkContext.broadcast(collocations.frequent_buckets(docs))
    rows = collocations.windows(docs, shared).collect()
    assert {(r["w1"], r["w2"], r["n"]) for r in rows} == {
        (None, None, 900), ("word0", None, 300), ("word1", None, 300), ("word2", None, 300)
    }


def test_windows_of_more_splits_are_no_more_rows(spark):
    """Tasks add windows up over all their splits, so more splits than cores add no rows."""
    cores = spark.sparkContext.defaultParallelism
    text = " ".join(f"word{i} next{i};" for i in range(20))
    docs = spark.createDataFrame([("x", text)] * 1200, "lang string, text string")

    def made(splits):
        cut = docs.repartition(splits)
        shared = spark.sparkContext.broadcast(collocations.frequent_buckets(cut))
        df = collocations.windows(cut, shared)
        summed = {(r["w1"], r["w2"]): r["n"] for r in df.collect()}
        assert summed == {(None, None): 0} | {
            w: 1200 for i in range(20) for w in ((f"word{i}", f"next{i}"), (f"next{i}", None))
        }
        node = df._jdf.queryExecution().executedPlan()
        while node.nodeName() != "MapInArrow":
            node = node.children().apply(0)
        return node.metrics().apply("pythonNumRowsReceived").value()

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = made(cores)
        assert rows == 41 * cores
        assert made(6 * cores) == rows
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_empty_table(nothing):
    assert collocations.collocations(nothing).count() == 0
