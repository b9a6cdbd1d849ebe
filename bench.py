"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the test data, ``BENCH_CPUS`` the number of local cores.
Every query runs once to warm up and is then timed from building the plan to
the last row, without storing the result. Nothing cached is left from one run
to the next.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from flightmarts import catalog
from flightmarts.session import get_session

HEADLINE = [
    "raw_arrivals_from_payload",
    "stg_flights_arrivals",
    "stg_flights_departures",
    "int_flights",
    "fct_flights",
    "fct_flights_stored",
    "dim_airline",
    "mart_airline_punctuality",
    "mart_airport_hourly_traffic",
    "mart_airport_punctuality",
    "mart_baggage_performance",
    "mart_route_popularity",
    "explore_flights_per_hour",
    "explore_delay_per_flight",
    "explore_airline_delays",
    "explore_top_routes_by_type",
    "explore_movement_share",
    "explore_completeness",
    "serve_peak_hours",
    "serve_domestic_comparison",
    "serve_airline_comparison",
    "serve_top_routes",
    "serve_slowest_carousels",
    "serve_weekly_trend",
    "quality_not_null",
    "quality_unique",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    queries = catalog.queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        run(queries[name](spark, sf_dir))
        spark.catalog.clearCache()
        started = time.perf_counter()
        run(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()

    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total warm seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
