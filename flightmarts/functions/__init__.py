from flightmarts.functions.flags import (
    is_listed_airport,
    is_on_time,
    is_status,
    time_period,
)
from flightmarts.functions.keys import surrogate_key
from flightmarts.functions.numbers import percent, round2
from flightmarts.functions.times import (
    date_key,
    day_name,
    day_name_short,
    hour_of_day,
    iso_weekday,
    minutes_between,
    month_name,
    month_name_short,
)

__all__ = [
    "date_key",
    "day_name",
    "day_name_short",
    "hour_of_day",
    "is_listed_airport",
    "is_on_time",
    "is_status",
    "iso_weekday",
    "minutes_between",
    "month_name",
    "month_name_short",
    "percent",
    "round2",
    "surrogate_key",
    "time_period",
]
