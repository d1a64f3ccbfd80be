"""Date parsing, date parts and load stamps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from .text import _col


def parse_date(c: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to a naive timestamp at midnight; text of another shape is NULL."""
    return F.try_to_date(_col(c), pattern).cast("timestamp_ntz")


# Forms of dates by name, how a text of the form looks, how it is read.
DATE_FORMS = (
    ("iso_date", r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    ("iso_minutes", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$", "yyyy-MM-dd HH:mm"),
    ("iso_seconds", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
    ("iso_t_seconds", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
    ("day_first", r"^(?:1[3-9]|2\d|3[01])/\d{2}/\d{4}$", "dd/MM/yyyy"),
    ("month_first", r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy"),
)


def date_form(c: Column | str) -> Column:
    """Which of the known forms a text has, NULL for none. Of two days that may
    both be months the first is taken for the month."""
    c = _col(c)
    form = F.when(c.rlike(DATE_FORMS[0][1]), DATE_FORMS[0][0])
    for name, look, _ in DATE_FORMS[1:]:
        form = form.when(c.rlike(look), name)
    return form


def parse_dates_alike(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Date texts of each column to naive timestamps, in the form of its first filled value.

    First is by ``order``; a filled value of no known form is passed over, so it
    does not decide. Texts in another form become NULL, and so does a whole column
    without a known form. The forms are found by one aggregation over all columns
    and stay in the plan; nothing reaches the driver.
    """
    rank = F.struct(*order)
    found = df.agg(*[F.min_by(date_form(c), F.when(date_form(c).isNotNull(), rank)).alias(c) for c in columns])
    looks = {name: look for name, look, _ in DATE_FORMS}
    looks["day_first"] = looks["month_first"]  # once the first value has told them apart

    def read(column: str) -> Column:
        form, text = found.select(column).scalar(), F.col(f"`{column}`")
        value = F.lit(None).cast("timestamp_ntz")
        for name, _, pattern in DATE_FORMS:
            of_form = (form == name) & text.rlike(looks[name])
            value = F.when(of_form, F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")).otherwise(value)
        return value

    return df.withColumns({c: read(c) for c in columns})


def year_number(c: Column | str) -> Column:
    return F.year(_col(c)).cast("bigint")


def month_number(c: Column | str) -> Column:
    return F.month(_col(c)).cast("bigint")


# Day names, Monday first.
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def day_name(c: Column | str) -> Column:
    """Full English day name, whatever the session's time zone."""
    names = F.array(*[F.lit(d) for d in DAYS])
    return F.get(names, F.weekday(_col(c)))


def load_stamp(as_of: datetime) -> tuple[str, str]:
    """(ISO instant, ISO date) of a load, both in UTC.

    One instant per run, taken by the caller: a retried task and a rerun with
    the same ``as_of`` stamp the same text.
    """
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    as_of = as_of.astimezone(timezone.utc)
    return as_of.isoformat(), as_of.strftime("%Y-%m-%d")
