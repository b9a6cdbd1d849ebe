"""Every query of the library by name, on the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmarts.constants import RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.plans import explore, history, periods, serving, star_joins, surroundings
from flightmarts.plans.dimensions import airport_dimension, holiday_dimension
from flightmarts.plans.marts import in_order
from flightmarts.plans.quality import quality_report
from flightmarts.plans.warehouse import KEYED_FLIGHTS, Models
from flightmarts.session import scratch_path, use_utc
from flightmarts.sources import bronze, drift, landing
from flightmarts.sources.event_weather import memberships, observations
from flightmarts.sources.lineitem_flights import payload_documents, raw_flights
from flightmarts.sources.tables import DAILY_STATES, ParquetStore
from flightmarts.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# The calendar's relative flags and the serving questions need a fixed day.
AS_OF = "2026-01-25"
MONTH = "2026-01-01"
# Documents of a landed file at most, some 30 MB of text.
LANDED_DOCUMENTS = 50_000


def lazy_models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(raw_flights(use_utc(spark), sf_dir), AS_OF)


def models_on_stored_flights(spark: SparkSession, sf_dir: str) -> Models:
    """Models above one stored copy of the deduplicated flights.

    For results that read several models, so that flights are deduplicated
    once and not once per model. The copy lies in the scratch folder: no
    executor's memory holds on to it, and no other query reads it.
    """
    store = ParquetStore(spark, scratch_path(spark, "flights"))
    return Models(
        raw_flights(use_utc(spark), sf_dir),
        AS_OF,
        lambda name, model: store.keep(name, model) if name == KEYED_FLIGHTS else model,
    )


def models_on_stored_states(spark: SparkSession, sf_dir: str, *names: str) -> Models:
    """Models of which some daily states are stored, as ``build`` leaves them."""
    store = ParquetStore(spark, scratch_path(spark, "states"))
    kept = {*names, "airline_numbers"}
    if not kept <= {*DAILY_STATES, "airline_numbers"}:
        raise ValueError(f"no daily states: {kept}")
    return Models(
        raw_flights(use_utc(spark), sf_dir),
        AS_OF,
        lambda name, model: store.keep(name, model) if name in kept else model,
    )


def _period(state: str, mart: Callable[..., DataFrame], *more: object, **options: object) -> Query:
    """A mart of longer periods over one stored state; ``more`` may name models."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        models = models_on_stored_states(spark, sf_dir, state)
        inputs = [models[m] if isinstance(m, str) and m in models else m for m in more]
        return mart(models[state], *inputs, **options)

    return query


def _star(question: Callable[..., DataFrame], *dimensions: str, **options: object) -> Query:
    """A question on the stored fact and joined dimensions."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        models = models_on_stored_flights(spark, sf_dir)
        tables = {"dim_holiday": holiday_dimension(spark)}
        inputs = [tables[d] if d in tables else models[d] for d in dimensions]
        return question(models["fct_flights"], *inputs, **options)

    return query


def _model(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lazy_models(spark, sf_dir)[name]

    return query


def _models_of_mart(name: str) -> Callable[[SparkSession, str], Models]:
    # The airlines' mart reads the flights twice: for its cells and for the names.
    return models_on_stored_flights if name == "mart_airline_punctuality" else lazy_models


def _mart(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return in_order(_models_of_mart(name)(spark, sf_dir)[name], name)

    return query


def _serve(mart: str, question: Callable[..., DataFrame], **options: object) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return question(_models_of_mart(mart)(spark, sf_dir)[mart], **options)

    return query


def _explore(question: Callable[..., DataFrame], *inputs: str, **options: object) -> Query:
    """``inputs`` are raw tables, or ``dim_airport``."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = raw_flights(use_utc(spark), sf_dir)
        if "dim_airport" in inputs:
            tables["dim_airport"] = airport_dimension(spark)
        return question(*[tables[name] for name in inputs], **options)

    return query


def _quality(kind: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality_report(models_on_stored_flights(spark, sf_dir), [kind])

    return query


def stored_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact, written in daily folders and read back."""
    return models_on_stored_flights(spark, sf_dir)["fct_flights"]


def airport_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airport dimension with each airport's flights, in both roles."""
    built = lazy_models(spark, sf_dir)
    fact, airports = built["fct_flights"], built["dim_airport"]
    roles = fact.groupBy("origin_airport_key", "dest_airport_key").agg(
        F.count("*").alias("flights")
    )
    ends = roles.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("origin_airport_key").alias("airport_key"),
                    F.col("flights").alias("as_origin"),
                    F.lit(0).cast("long").alias("as_destination"),
                ),
                F.struct(
                    F.col("dest_airport_key").alias("airport_key"),
                    F.lit(0).cast("long").alias("as_origin"),
                    F.col("flights").alias("as_destination"),
                ),
            )
        )
    )
    totals = ends.groupBy("airport_key").agg(
        F.sum("as_origin").alias("as_origin"), F.sum("as_destination").alias("as_destination")
    )
    return airports.join(totals, "airport_key", "left").na.fill(0, ["as_origin", "as_destination"])


def calendar_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension with each day's flights."""
    built = lazy_models(spark, sf_dir)
    per_day = (
        built["fct_flights"]
        .groupBy(F.col("flight_date_key").alias("date_key"))
        .agg(F.count("*").alias("flights"))
    )
    days = built["dim_date"].join(per_day, "date_key", "left").na.fill(0, ["flights"])
    return in_order(days, "dim_date")


def airline_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = models_on_stored_flights(spark, sf_dir)
    return serving.airline_routes(built["fct_flights"], built["dim_airline"], ["SK", "W6"], k=12)


def raw_arrivals_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw arrivals appended to a raw table in scratch and read back."""
    scheduled = F.col(bronze.SCHEDULED[RAW_ARRIVALS])
    rows = raw_flights(use_utc(spark), sf_dir)[RAW_ARRIVALS].withColumns(
        {
            "load_date": F.lit(AS_OF),
            "flight_day": F.date_format(scheduled, "yyyy-MM-dd"),
            "timed": scheduled.isNotNull(),
        }
    )
    folder = scratch_path(spark, "raw")
    bronze.append_raw(rows, f"{folder}/{RAW_ARRIVALS}")
    return bronze.read_raw(spark, folder, RAW_ARRIVALS).drop("payload")


def raw_arrivals_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw arrivals, landed as files in two goes and loaded by two runs of the stream."""
    docs = payload_documents(use_utc(spark), sf_dir, landing.ARRIVALS, by_day=True)
    docs = docs.select("document", "date", "airport", F.lit(landing.ARRIVALS).alias("direction"))
    root = scratch_path(spark, "stream")
    first = F.col("airport").isin("ARN", "GOT", "SFT")
    for some in (first, ~first):
        # Documents of an airport and day meet in packed files, one per line. Such a file
        # is read by one task, so a busy day has several.
        docs.filter(some).write.mode("append").partitionBy("date", "airport", "direction").option(
            "maxRecordsPerFile", LANDED_DOCUMENTS
        ).text(f"{root}/landing", compression="gzip")
        ingest.load_new(
            spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", one_per_line=True
        )
    rows = bronze.read_raw(spark, f"{root}/bronze", RAW_ARRIVALS)
    # Load ids are the times of the files, row ids follow from them.
    return rows.drop("payload", "load_date", "_dlt_load_id", "_dlt_id")


def drifting_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals as JSON text whose shape changes from load to load, by rule."""
    docs = payload_documents(use_utc(spark), sf_dir, landing.ARRIVALS)
    # Taken out once, in a projection of its own: it is used several times.
    docs = docs.select(F.get_json_object("document", "$.flights[0]").alias("flight"), "load_id", "airport")
    flight, load = F.col("flight"), F.col("load_id")
    as_number = F.regexp_replace(flight, '"terminal":"([0-9]+)"', '"terminal":$1')
    as_text = F.regexp_replace(flight, '"arrivalTime":\\{[^}]*\\}', '"arrivalTime":"late"')
    more = F.concat(F.lit('{"aircraft":{"type":"A320"},'), F.substring(flight, 2, 1 << 30))
    drifted = (
        F.when(load.endswith("1"), as_number)
        .when(load.endswith("2"), more)
        .when(F.get_json_object(flight, "$.flightId").endswith("7"), as_text)
        .otherwise(flight)
    )
    return docs.select(drifted.alias("flight"), "load_id", "airport")


def _drift(question: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return question(drifting_flights(spark, sf_dir))

    return query


def airline_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_flights(use_utc(spark), sf_dir)
    return history.punctuality_by_period(raw, history.name_periods(history.names_per_load(raw)))


def _weather(question: Callable[..., DataFrame], **options: object) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact = lazy_models(spark, sf_dir)["fct_flights"]
        return question(fact, observations(spark, sf_dir), **options)

    return query


def alliance_punctuality(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = models_on_stored_flights(spark, sf_dir)
    return surroundings.alliance_punctuality(
        built["fct_flights"], built["dim_airline"], memberships(spark, sf_dir)
    )


def _local(question: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return question(lazy_models(spark, sf_dir)["fct_flights"])

    return query


def flights_by_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.flights_by_load_date(raw_flights(use_utc(spark), sf_dir))


def _from_payload(direction: str) -> Query:
    """Payload text → parsed → one raw row per flight."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = payload_documents(use_utc(spark), sf_dir, direction)
        parsed = docs.select(
            landing.parse_payload(F.col("document"), direction).alias("p"), "airport", "load_id"
        ).select("p.*", "airport", "load_id")
        # The row id is a hash of the payload's text, which has no SQL twin.
        return landing.raw_rows(parsed, direction, F.col("load_id")).drop("_dlt_id")

    return query


def backfill_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the last three days at chosen airports."""
    docs = bronze.merge_sources(
        *[
            payload_documents(use_utc(spark), sf_dir, direction).withColumn(
                "direction", F.lit(direction)
            )
            for direction in (landing.ARRIVALS, landing.DEPARTURES)
        ]
    )
    window = landing.in_window(
        docs, landing.airport_list(" arn,Got , UME"), landing.backfill_dates(3, AS_OF)
    )
    return window.groupBy("date", "airport", "direction").agg(F.count("*").alias("documents"))


def queries() -> dict[str, Query]:
    a, d, airports = RAW_ARRIVALS, RAW_DEPARTURES, "dim_airport"
    return {
        # Raw layer
        "raw_arrivals_from_payload": _from_payload(landing.ARRIVALS),
        "raw_departures_from_payload": _from_payload(landing.DEPARTURES),
        "raw_arrivals_stored": raw_arrivals_stored,
        "backfill_window": backfill_window,
        "load_summary": _explore(bronze.load_summary, a, d),
        "airports_loaded": _explore(bronze.airports_loaded, a),
        # Models
        "stg_flights_arrivals": _model("stg_flights_arrivals"),
        "stg_flights_departures": _model("stg_flights_departures"),
        "int_flights": _model("int_flights"),
        "fct_flights": _model("fct_flights"),
        "fct_flights_stored": stored_flights,
        "dim_airline": _model("dim_airline"),
        "dim_airport_traffic": airport_traffic,
        "dim_date_traffic": calendar_traffic,
        "mart_airline_punctuality": _mart("mart_airline_punctuality"),
        "mart_airport_hourly_traffic": _mart("mart_airport_hourly_traffic"),
        "mart_airport_punctuality": _mart("mart_airport_punctuality"),
        "mart_baggage_performance": _mart("mart_baggage_performance"),
        "mart_route_popularity": _mart("mart_route_popularity"),
        # Exploration
        "explore_row_counts": _explore(explore.row_counts, a, d),
        "explore_sample_arrivals": _explore(
            explore.sample_rows, a, n=5,
            by=["flight_id", "arrival_time__scheduled_utc", "_dlt_load_id", "_dlt_id"],
        ),
        "explore_sample_departures": _explore(
            explore.sample_rows, d, n=5,
            by=["flight_id", "departure_time__scheduled_utc", "_dlt_load_id", "_dlt_id"],
        ),
        "explore_status_distribution": _explore(explore.status_distribution, a),
        "explore_flights_per_hour": _explore(explore.flights_per_hour, a),
        "explore_flights_per_period": _explore(explore.flights_per_period, a),
        "explore_delay_per_flight": _explore(explore.delay_per_flight, a),
        "explore_top_airlines": _explore(explore.top_airlines, a),
        "explore_airline_delays": _explore(explore.airline_delays, a),
        "explore_top_routes": _explore(explore.top_routes, a),
        "explore_top_routes_named": _explore(explore.top_routes_named, a, airports),
        "explore_top_routes_by_type": _explore(explore.top_routes_by_type, a, airports),
        "explore_domestic_share": _explore(explore.domestic_share, a, airports),
        "explore_arrival_share": _explore(explore.arrival_share, a, airports),
        "explore_movement_share": _explore(explore.movement_share, a, d, airports),
        "explore_weekday_distribution": _explore(explore.weekday_distribution, a),
        "explore_completeness": _explore(explore.completeness, a),
        # Dashboard questions
        "serve_peak_hours": _serve(
            "mart_airport_hourly_traffic", serving.peak_hours, airport="ARN", month=MONTH
        ),
        "serve_domestic_comparison": _serve(
            "mart_airport_punctuality", serving.domestic_comparison,
            airport="GOT", year=2026, week=4,
        ),
        "serve_airline_comparison": _serve(
            "mart_airline_punctuality", serving.airline_comparison,
            airlines=["SK", "DY"], month=MONTH,
        ),
        "serve_top_routes": _serve(
            "mart_route_popularity", serving.top_routes, airport="ARN", month=MONTH
        ),
        "serve_slowest_carousels": _serve(
            "mart_baggage_performance", serving.slowest_carousels, airport="ARN", weekday=7
        ),
        "serve_traffic_share": _serve("mart_airport_hourly_traffic", serving.traffic_share),
        "serve_weekly_trend": _serve(
            "mart_airport_punctuality", serving.trend, period="flight_week"
        ),
        "serve_monthly_trend": _serve(
            "mart_airport_punctuality", serving.trend, period="flight_month"
        ),
        "serve_worst_airports": _serve(
            "mart_airport_punctuality", serving.worst_delays, by=["airport_iata"], month=MONTH, k=5
        ),
        "serve_worst_airlines": _serve(
            "mart_airline_punctuality", serving.worst_delays,
            by=["airline_iata", "airline_name"], month=MONTH, k=5,
        ),
        "serve_airline_routes": airline_routes,
        "serve_route_trend": _serve("mart_route_popularity", serving.route_trend, airport="ARN"),
        # Longer periods, from stored daily states
        "period_airport_punctuality_quarter": _period(
            "tally_airport_delays", periods.airport_punctuality, period="quarter"
        ),
        "period_airport_punctuality_year": _period(
            "tally_airport_delays", periods.airport_punctuality, period="year"
        ),
        "period_airline_punctuality_year": _period(
            "tally_airline_delays", periods.airline_punctuality, "dim_airline", period="year"
        ),
        "period_baggage_month": _period("tally_baggage", periods.baggage_performance, period="month"),
        "period_hourly_airlines_month": _period(
            "state_hourly_airlines", periods.distinct_airlines,
            ["airport_iata", "flight_hour", "flight_type"], period="month",
        ),
        "period_airport_airlines_year": _period(
            "state_hourly_airlines", periods.distinct_airlines, ["airport_iata"], period="year"
        ),
        "period_route_airlines_year": _period(
            "state_route_airlines", periods.distinct_airlines,
            ["route_key", "flight_type"], period="year",
        ),
        # Star joins on the stored fact
        "star_week_punctuality": _star(
            star_joins.week_punctuality, "dim_date", "dim_airport", year=2026, week=4
        ),
        "star_weekend_baggage": _star(
            star_joins.weekend_baggage, "dim_date", "dim_airport", year=2026, month=2
        ),
        "star_holiday_traffic": _star(
            star_joins.holiday_traffic, "dim_holiday", "dim_date", "dim_airport", year=2026
        ),
        "star_named_routes": _star(
            star_joins.named_routes, "dim_date", "dim_airport", year=2026, quarter=1
        ),
        # Loading as a stream, and payloads that change
        "raw_arrivals_streamed": raw_arrivals_streamed,
        "drift_report_arrivals": _drift(lambda f: drift.drift_report(f, landing.ARRIVALS)),
        "drift_versions_arrivals": _drift(lambda f: drift.schema_versions(f).drop("fields")),
        "drift_typed_arrivals": _drift(
            lambda f: drift.typed_flights(f, landing.ARRIVALS).drop("payload", "_dlt_id")
        ),
        "airline_history": airline_history,
        "flights_by_load_date": flights_by_load_date,
        # Beside weather, alliances and the local clock
        "weather_punctuality": _weather(surroundings.weather_punctuality),
        "weather_strong_wind": _weather(surroundings.windy_hours, limit=20.0),
        "alliance_punctuality": alliance_punctuality,
        "local_hourly_traffic": _local(surroundings.local_hourly_traffic),
        "local_night_movements": _local(surroundings.night_movements),
        # Quality checks
        "quality_not_null": _quality("not_null"),
        "quality_unique": _quality("unique"),
        "quality_accepted_values": _quality("accepted_values"),
    }
