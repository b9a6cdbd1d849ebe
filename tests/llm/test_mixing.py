from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from odd_documents import nothing, odd, plain  # noqa: F401
from plain_operators import hashed, words

from flightmarts.llm import mixing


def reshared(sizes, weights, cap=3.0):
    """The excess over the caps goes round by weight until none is left."""
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(cap * sizes[i] for i in capped)
        open_ = [i for i in range(len(sizes)) if i not in capped]
        weight = sum(weights[i] for i in open_)
        own = {i: rest * weights[i] / weight for i in open_}
        over = {i for i in open_ if own[i] > cap * sizes[i] + 1e-9}
        if not over:
            return [cap * sizes[i] if i in capped else own[i] for i in range(len(sizes))]
        capped |= over


def plain_mix(rows):
    """``(id, size, source size, target, taken, copies)`` of ``(id, text, source)``, slot by slot."""
    names = sorted({s for *_, s in rows if s is not None}) + [None] * any(s is None for *_, s in rows)
    size = Counter({n: 0 for n in names})
    for _, text, source in rows:
        size[source] += len(words(text))
    targets = dict(zip(names, reshared([size[n] for n in names], [1 + i % 3 for i in range(len(names))])))
    block = {n: next(b for b in mixing.BLOCKS if b == 1 or targets[n] >= 1024 * b) for n in names}
    passes = defaultdict(Counter)
    for b in set(block.values()):
        own = [n for n in names if block[n] == b and targets[n] > 0]
        total = sum(targets[n] for n in own)
        rank, ends, so_far = Counter(), [], 0.0
        for n in own:
            so_far += targets[n]
            ends.append(so_far / total)
        for t in range(round(total / b) if own else 0):
            point = (t + 1) * mixing.GOLDEN
            point -= math.floor(point)
            n = own[next((i for i, e in enumerate(ends[:-1]) if point < e), len(own) - 1)]
            blocks = -(-size[n] // b)
            if rank[n] < 3 * blocks:
                passes[n][rank[n] % blocks] += 1
            rank[n] += 1
    for n in names:
        marked = [(i, hashed(text), len(words(text))) for i, text, s in rows if s == n]
        order = lambda r: hashed(r[0], r[1], "mix")
        marked.sort(key=lambda r: (order(r) % 4096, order(r), r[0] is not None, r[0] or 0, r[1]))
        at = 0
        for i, _, length in marked:
            taken = sum(passes[n][k // block[n]] for k in range(at, at + length))
            copies = passes[n][at // block[n]] if length else 0
            yield i, length, size[n], round(targets[n], 6), taken, copies
            at += length


def found(df):
    return Counter(
        (r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"], r["copies"]) for r in df.collect()
    )


@pytest.mark.parametrize(
    "sizes", [[10, 10, 10], [1, 1000, 5, 7, 300], [0, 5, 0], [100], [1, 1, 1, 1, 10_000], [3, 0, 900, 2, 2, 2], [0, 0]]
)
def test_targets(spark, sizes):
    sized = spark.createDataFrame([(f"s{i}", size, 1) for i, size in enumerate(sizes)], "source string, size long, n long")
    rows = sorted(mixing.sources_of(sized).collect(), key=lambda r: r["source"])
    assert [r["target"] for r in rows] == pytest.approx(reshared(sizes, [1.0 + i % 3 for i in range(len(sizes))]))


def test_mix_is_the_plain_version(odd, plain):
    rows = list(plain_mix([(i, text, source) for i, text, _, source in plain]))
    assert found(mixing.mix(odd)) == Counter(rows)
    taken, targets = Counter(), {}
    for _, _, size, target, own, _ in rows:
        taken[size, target] += own
    for (size, target), own in taken.items():
        assert own == pytest.approx(target, rel=0.02, abs=30)
    assert all(own <= 3 * length for _, length, _, _, own, _ in rows)


def test_reruns_agree_under_other_splits(spark, odd):
    first = found(mixing.mix(odd))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        assert odd.rdd.getNumPartitions() > 3
        assert found(mixing.mix(odd)) == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_small_source_makes_no_slots_for_others(spark):
    """Sources of 30 million words and of ten: blocks, slots and pieces stay few."""
    sized = spark.createDataFrame(
        [("big", i, i, 30_000, 1) for i in range(1000)] + [("small", -1, 0, 10, 1)],
        "source string, doc_id long, mark long, size long, n long",
    )
    sources = mixing.sources_of(sized)
    rows = {r["source"]: r for r in sources.collect()}
    assert (rows["big"]["block"], rows["small"]["block"]) == (4096, 1)
    slots = mixing.schedule(spark, sources).agg({"passes": "sum"}).first()[0]
    assert 7_000 <= slots <= 7_400


def test_many_sources(spark):
    rows = [(i, "one two three four", f"s{i % 11_000:05d}") for i in range(22_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == 22_000 and {r["source_size"] for r in got} == {8}
    assert sum(r["taken"] for r in got) == pytest.approx(88_000, rel=0.01)


def test_rows_without_id_are_spread_and_equal_rows_told_apart(spark):
    rows = [(None, f"text of number {i}", "a") for i in range(3000)] + [(None, "the same", "a")] * 9000
    rows += [(7, "other words", "b")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert found(mixing.mix(docs)) == Counter(plain_mix(rows))
    sized = mixing.sized_documents(docs)
    assert sized.count() == 3002
    placed = mixing._streamed(sized, mixing.sources_of(sized))
    assert placed.selectExpr("pmod(h, 4096) AS p").distinct().count() > 1500


def test_mixed_repeats_whole_documents(spark, odd):
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns
    want = Counter()
    for r in mixing.mix(odd).collect():
        want[r["doc_id"], r["mark"]] += r["copies"]
    got = Counter(
        (r["doc_id"], r["mark"]) for r in mixed.selectExpr("doc_id", "xxhash64(coalesce(text, '')) AS mark").collect()
    )
    assert got == +want
    rows = [(None, f"text of number {i % 5}", "a", i) for i in range(50)] + [(1, "x y z", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra long")
    often = Counter(r["text"] for r in mixing.mixed(docs).collect())
    assert sum(often.values()) == sum(r["copies"] for r in mixing.mix(docs).collect()) and often["x y z"] == 3


def test_empty_table(nothing):
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed(nothing).count() == 0
