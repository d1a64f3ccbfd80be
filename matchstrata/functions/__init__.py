"""Column functions shared by batch and streaming plans."""

from .dates import (
    date_form,
    day_name,
    load_stamp,
    month_number,
    parse_date,
    parse_dates_alike,
    year_number,
)
from .numbers import guarded_ratio, not_integral, to_long
from .text import (
    finished,
    first_filled,
    normalized,
    one_decimal,
    podium,
    signed,
    thousands,
)

__all__ = [
    "date_form", "day_name", "finished", "first_filled", "guarded_ratio", "load_stamp", "month_number",
    "normalized", "not_integral", "one_decimal", "parse_date", "parse_dates_alike", "podium", "signed",
    "thousands", "to_long", "year_number",
]
