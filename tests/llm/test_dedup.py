from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from odd_documents import nothing, odd, plain  # noqa: F401
from plain_operators import SPACE, near_classes, repeated

from flightmarts.llm import exact_dedup, jaccard_join, suffix_dedup
from flightmarts.llm.graph import components


def counted(rows):
    return Counter(map(tuple, rows))


def test_exact_groups(odd, plain):
    groups = defaultdict(list)
    for i, text, *_ in plain:
        groups[re.sub(SPACE, " ", text)].append(i)
    found = exact_dedup.exact_groups(odd, with_digest=True).collect()
    assert len(found) == len(plain)
    expected = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected.update((i, keep, len(ids), sha) for i in ids)
    assert counted((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == expected
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_deduplicated_keeps_one_row_and_all_columns(odd, plain):
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    texts = [re.sub(SPACE, " ", r["text"] or "") for r in kept.select("text").collect()]
    assert len(texts) == len(set(texts))
    assert set(texts) == {re.sub(SPACE, " ", t) for _, t, *_ in plain}


def test_jaccard_classes(odd, plain):
    expected = near_classes([(i, t) for i, t, *_ in plain])
    found = jaccard_join.classes(odd).collect()
    assert counted((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == counted(expected)


def test_large_components_are_verified_in_blocks(odd, plain, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_GRAMS", 60)
    expected = near_classes([(i, t) for i, t, *_ in plain])
    found = jaccard_join.classes(odd).collect()
    assert counted((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == counted(expected)


def test_links_count_once_if_near_copies_share_one_of_two_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_GRAMS", 100)
    texts = []
    for pair in range(8):  # 96 n-grams each: two blocks, and half of the pairs leave one empty
        words = [f"w{pair}x{k}" for k in range(100)]
        texts += [" ".join(words), " ".join([*words[:-1], "other"])]
    rows = list(enumerate(texts))
    found = jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert counted((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == counted(near_classes(rows))
    assert {r["n_links"] for r in found} == {1}


def test_banding_reaches_its_recall():
    bands, rows = jaccard_join.banding(0.8)
    assert bands * rows <= jaccard_join.HASHES
    assert 1 - (1 - 0.8**rows) ** bands >= jaccard_join.RECALL


def test_components(spark):
    pairs = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (None, 6), (4, 1)]
    pairs += [(100 + i, 101 + i) for i in range(40)]
    edges = spark.createDataFrame(pairs, "x long, y long")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {2: 1, 3: 1, 4: 1, 9: 7, 8: 7} | {101 + i: 100 for i in range(40)}


def test_repeated_strings(odd, plain):
    texts = [t for _, t, *_ in plain]
    expected = counted(
        (i, len(t.encode()), n, runs, rest)
        for (i, t, *_), (n, runs, rest) in zip(plain, repeated(texts), strict=True)
    )
    found = suffix_dedup.without_repeats(odd).collect()
    assert (
        counted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found)
        == expected
    )


def test_short_periods_and_overlaps(spark):
    base = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(900))
    texts = ["ab" * 400, "ab" * 200, "ab" * 199, base, base[300:701], base[250:649], "z" * 400, "z" * 401]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in suffix_dedup.without_repeats(docs).collect()}
    for i, (n, runs, rest) in enumerate(repeated(texts)):
        assert (found[i]["n_removed"], found[i]["n_spans"], bytes(found[i]["kept"])) == (n, runs, rest)


def test_a_passage_of_many_texts_never_meets_in_one_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", 8, raising=False)
    bucket, sizes = suffix_dedup._bucket, str(tmp_path)

    def watched(batches):
        groups = Counter()

        def seen():
            for batch in batches:
                groups.update(zip(*(batch.column(n).to_pylist() for n in ("lead", "step", "core"))))
                yield batch

        yield from bucket(seen())
        for n in set(groups.values()):
            open(f"{sizes}/{n}", "w").close()

    monkeypatch.setattr(suffix_dedup, "_bucket", watched)
    words = lambda seed, n: " ".join(hashlib.md5(f"{seed} {k}".encode()).hexdigest()[:7] for k in range(n))
    passage, other = words("p", 70), words("o", 70)
    texts = [f"{words(i, 20)} {passage} {words(-i - 1, 60)}" for i in range(40)]
    texts += [texts[0]] * 12 + [texts[1] + " " + words("end", 70)]  # copies, also within another text
    texts += [f"{other} {words(i, 30)}" for i in range(100, 103)]  # a passage of few texts
    rows = list(enumerate(texts))
    found = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found.collect()}
    assert got == dict(enumerate(repeated(texts)))
    assert 0 < max(int(p.name) for p in tmp_path.iterdir()) <= 8


@pytest.mark.parametrize(
    "operator", [exact_dedup.exact_groups, jaccard_join.classes, suffix_dedup.without_repeats]
)
def test_empty_table(operator, nothing):
    assert operator(nothing).count() == 0


def test_one_row_of_each_class_stays_without_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [
        (None, base, 1), (None, base + " end", 2), (None, "quite another text of seven words", 3),
        (5, base + " tail", 4), (5, "something else under the same id five", 5), (5, base + " tail", 6), (None, None, 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _nth long")
    kept = jaccard_join.representatives(docs).collect()
    assert sorted((str(r["doc_id"]), (r["text"] or "")[-5:]) for r in kept) == sorted(
        [("5", " tail"), ("None", "words"), ("5", " five"), ("None", "")]
    )


def chain(length: int, words: int = 120, step: int = 2) -> list[tuple[int, str]]:
    """Texts of which each shares all but ``step`` words with the next."""
    line = [f"c{k * 7919 % 104729}" for k in range(words + step * length)]
    return [(i, " ".join(line[i * step : i * step + words])) for i in range(length)]


@pytest.mark.parametrize("block_docs", [2000, 5])
def test_chains_of_near_copies(spark, monkeypatch, block_docs):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", block_docs)
    rows = chain(60) + [(1000 + i, t + " tail") for i, t in chain(60)[::3]]
    found = jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in found.collect()}
    expected = {i: (c, n) for i, c, n in near_classes(rows)}
    assert {c for c, _ in got.values()} == {0}
    assert {c for c, _ in expected.values()} == {0}
    # No pair twice, and no more missed than the banding allows at the threshold.
    assert all(got[i][1] <= n for i, (_, n) in expected.items())
    assert sum(n for _, n in got.values()) >= 0.98 * sum(n for _, n in expected.values())


def test_a_chain_ships_sets_in_proportion_to_its_length(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 4)
    shipped, run = [], jaccard_join.stored

    def counting(df, name):
        out = run(df, name)
        if name == "members":
            shipped.append(
                out.selectExpr("sum(aggregate(units, 0, (a, u) -> a + u.blocks)) AS n").first()["n"]
            )
        return out

    monkeypatch.setattr(jaccard_join, "stored", counting)
    for length in (40, 160):
        jaccard_join.classes(spark.createDataFrame(chain(length, step=6), "doc_id long, text string"))
    assert shipped[1] < 1.5 * 4 * shipped[0]
