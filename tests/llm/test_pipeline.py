from __future__ import annotations

import inspect

import corpus_pipeline
from plain_operators import near_classes

from flightmarts.llm import exact_dedup, mixing, quality_rules, registry
from flightmarts.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def test_stages_follow_one_another(spark):
    """Each stage against a plain version of it, on what its predecessor kept."""
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "near_dedup", "mixing", "piece_codec",
    ]
    rows = {r["doc_id"]: r for r in docs.collect()}
    keep = {r["doc_id"] for r in quality_rules.judged(docs).filter("kept").collect()}
    first: dict[str, int] = {}
    for i in sorted(keep):
        first.setdefault(" ".join(rows[i]["text"].split(" ")), i)
    exact = set(first.values())
    near = {c for _, c, _ in near_classes([(i, rows[i]["text"]) for i in exact])}
    expected = [keep, None, near]
    for (name, stage), ids in zip(corpus_pipeline.STAGES[:3], expected):
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns
        found = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(found) == len(set(found))
        if ids is not None:
            assert set(found) == ids
    mix = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    docs = corpus_pipeline.stored(corpus_pipeline.mix(spark, docs, SF_DIR), "mixing")
    assert docs.columns == columns
    counts = {r["doc_id"]: r["count"] for r in docs.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in mix.items() if n}
    last = corpus_pipeline.pieces(spark, docs, SF_DIR).collect()
    assert len(last) == sum(mix.values()) and all(r["round_trip"] for r in last)


def test_run_is_all_stages(spark):
    first = corpus_pipeline.run(spark, SF_DIR).collect()
    again = corpus_pipeline.run(spark, SF_DIR).collect()
    assert first and sorted(map(str, first)) == sorted(map(str, again))


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in registry.QUERIES
    assert set(registry.ORACLES) <= set(registry.QUERIES)
    for query in registry.QUERIES.values():
        assert list(inspect.signature(query).parameters) == ["spark", "sf_dir"]


def test_sql_twins(spark):
    import duckdb

    for name in registry.ORACLES:
        con = duckdb.connect()
        for t in ("documents", "pages", "benchmark"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
        twin = con.sql(registry.ORACLES[name])
        own = registry.QUERIES[name](spark, SF_DIR).select(*twin.columns).collect()
        assert sorted(map(repr, map(tuple, own))) == sorted(map(repr, twin.fetchall()))


def test_exact_dedup_is_idempotent(spark):
    docs = corpus_pipeline.stored(exact_dedup.deduplicated(table(spark, SF_DIR, "documents")), "once")
    assert exact_dedup.exact_groups(docs).filter("NOT kept").count() == 0
