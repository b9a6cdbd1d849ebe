"""Codes, names, labels and thresholds that results must agree on."""

# Airports covered, in their published order.
AIRPORTS = [
    ("ARN", "Stockholm Arlanda Airport"),
    ("BMA", "Bromma Stockholm Airport"),
    ("GOT", "Göteborg Landvetter Airport"),
    ("MMX", "Malmö Airport"),
    ("LLA", "Luleå Airport"),
    ("UME", "Umeå Airport"),
    ("OSD", "Åre Östersund Airport"),
    ("VBY", "Visby Airport"),
    ("RNB", "Ronneby Airport"),
    ("KRN", "Kiruna Airport"),
]
AIRPORT_CODES = [code for code, _ in AIRPORTS]

# Flight leg statuses.
FLIGHT_STATUSES = ["SCH", "FPL", "FLS", "SEQ", "ACT", "CAN", "LAN", "RER", "DIV", "DEL"]
SCHEDULED, CANCELLED, LANDED, DELETED = "SCH", "CAN", "LAN", "DEL"

ARRIVAL, DEPARTURE = "arrival", "departure"

# Time-of-day buckets as (first hour, last hour, label).
TIME_PERIODS = [
    (6, 11, "Morning (06:00-11:59)"),
    (12, 16, "Midday/Afternoon (12:00-16:59)"),
    (17, 21, "Evening (17:00-21:59)"),
]
NIGHT_PERIOD = "Night/Red-eye (22:00-05:59)"

# A flight this many minutes late is still on time for an airport,
# but already delayed for an airline.
ON_TIME_MINUTES = 15

# Fixed value: text standing for NULL inside a surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"

# Calendar range and names.
CALENDAR_FIRST_DAY = "2020-01-01"
CALENDAR_LAST_DAY = "2030-12-31"
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# Where the covered airports lie, and the first and last hour of the night there.
LOCAL_ZONE = "Europe/Stockholm"
NIGHT_HOURS = (22, 5)

# Raw table names.
RAW_ARRIVALS = "flights_arrivals_raw"
RAW_DEPARTURES = "flights_departures_raw"
