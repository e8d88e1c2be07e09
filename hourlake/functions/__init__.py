from hourlake.functions.keys import date_key, surrogate_key
from hourlake.functions.text import conform_name, name_part, trim_spaces
from hourlake.functions.time import (
    elapsed_hours,
    elapsed_seconds,
    event_date,
    event_hour,
    hours_before,
    iso_to_utc,
    micros,
    ntz,
)

__all__ = [
    "conform_name",
    "date_key",
    "elapsed_hours",
    "elapsed_seconds",
    "event_date",
    "event_hour",
    "hours_before",
    "iso_to_utc",
    "micros",
    "name_part",
    "ntz",
    "surrogate_key",
    "trim_spaces",
]
