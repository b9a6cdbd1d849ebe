"""All models by name, each built from the ones before it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame

from flightmarts.constants import RAW_ARRIVALS, RAW_DEPARTURES
from flightmarts.plans import marts, tallies
from flightmarts.plans.dimensions import airline_dimension, airport_dimension, date_dimension
from flightmarts.plans.flights import UNIFIED_COLUMNS, fact, unify, with_keys
from flightmarts.plans.staging import stage_arrivals, stage_departures

# Unified flights with their keys: the one relation behind int_flights,
# fct_flights and dim_airline, which are column subsets of it.
KEYED_FLIGHTS = "flights_keyed"


class Models(Mapping[str, DataFrame]):
    """The models over two raw tables; a model is put together when asked for.

    Nothing runs by default. ``keep`` may store a model and hand back what it
    stored; models further down then read that instead of computing it again.
    ``as_of`` is the day the calendar's relative flags refer to (today).
    """

    def __init__(
        self,
        raw: dict[str, DataFrame],
        as_of: dt.date | str | None = None,
        keep: Callable[[str, DataFrame], DataFrame] = lambda name, model: model,
    ) -> None:
        self._raw, self._as_of, self._keep = raw, as_of, keep
        self._spark = raw[RAW_ARRIVALS].sparkSession
        self._built: dict[str, DataFrame] = {}
        self._recipes: dict[str, Callable[[], DataFrame]] = {
            "stg_flights_arrivals": lambda: stage_arrivals(self._raw[RAW_ARRIVALS]),
            "stg_flights_departures": lambda: stage_departures(self._raw[RAW_DEPARTURES]),
            KEYED_FLIGHTS: lambda: with_keys(
                unify(self["stg_flights_arrivals"], self["stg_flights_departures"])
            ),
            "int_flights": lambda: self[KEYED_FLIGHTS].select(*UNIFIED_COLUMNS),
            "fct_flights": lambda: fact(self[KEYED_FLIGHTS]),
            "dim_airline": lambda: airline_dimension(self[KEYED_FLIGHTS]),
            "dim_airport": lambda: airport_dimension(self._spark),
            "dim_date": lambda: date_dimension(self._spark, self._as_of),
            "mart_airline_punctuality": lambda: marts.airline_punctuality(
                self["fct_flights"], self["dim_airline"]
            ),
            "mart_airport_hourly_traffic": lambda: marts.airport_hourly_traffic(self["fct_flights"]),
            "mart_airport_punctuality": lambda: marts.airport_punctuality(self["fct_flights"]),
            "mart_baggage_performance": lambda: marts.baggage_performance(self["fct_flights"]),
            "mart_route_popularity": lambda: marts.route_popularity(self["fct_flights"]),
            "airline_numbers": lambda: tallies.new_airlines(self["fct_flights"]),
            "tally_airport_delays": lambda: tallies.airport_delays(self["fct_flights"]),
            "tally_airline_delays": lambda: tallies.airline_delays(self["fct_flights"]),
            "tally_baggage": lambda: tallies.baggage(self["fct_flights"]),
            "state_hourly_airlines": lambda: tallies.hourly_airlines(
                self["fct_flights"], self["airline_numbers"]
            ),
            "state_route_airlines": lambda: tallies.route_airlines(
                self["fct_flights"], self["airline_numbers"]
            ),
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._keep(name, self._recipes[name]())
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._recipes)

    def __len__(self) -> int:
        return len(self._recipes)

    def build_all(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in self}
