"""The query that lands arrivals and loads them by the stream."""

from __future__ import annotations

import datetime as dt
import glob

from flightmarts import catalog
from flightmarts.constants import RAW_ARRIVALS
from flightmarts.sources.landing import ARRIVALS
from flightmarts.sources.lineitem_flights import payload_documents, raw_flights


def test_landed_files_are_packed_and_bounded(spark, tmp_path, monkeypatch):
    # Two of five order keys fall into one airport's busy morning; parts repeat, some keys are null.
    rows = [
        (None if i % 50 == 49 else i // 2, i % 97, i % 13, 1 + i % 4, dt.datetime(1996, 1, 1 + i % 28))
        for i in range(800)
    ]
    columns = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(catalog, "LANDED_DOCUMENTS", 5)
    found = catalog.raw_arrivals_streamed(spark, str(tmp_path))

    files = glob.glob(f"{tmp_path}/stream/landing/**/*.txt*", recursive=True)
    assert files and all(f.endswith(".gz") for f in files)
    assert max(spark.read.text(f).count() for f in files if "airport=ARN" in f) <= 5
    flights = raw_flights(spark, str(tmp_path))[RAW_ARRIVALS].drop("_dlt_load_id", "_dlt_id")
    kept = [c for c in flights.columns if c in found.columns]
    assert sorted(map(str, found.select(kept).collect())) == sorted(map(str, flights.select(kept).collect()))
    # Order lines are shuffled, not documents: nothing is built below the exchange.
    plan = payload_documents(spark, str(tmp_path), ARRIVALS, by_day=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS document") < plan.index("RepartitionByExpression")
