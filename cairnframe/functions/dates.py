"""Dates of sources and the sort value of an observation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean

#: What sorts before any observation.
EARLIEST = -(2**63)
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def parse_date(value: Column) -> Column:
    """yyyy-m-d with or without a time, d.m.yyyy or d-m-yyyy."""
    text = clean(value)
    four = text.rlike(r"^\d{4}-")
    return F.coalesce(
        F.when(four & text.rlike(r" "), F.try_to_date(text, "yyyy-M-d H:m:s")),
        F.when(four, F.try_to_date(text, "yyyy-M-d")),
        F.when(text.rlike(r"^\d{1,2}[.]\d{1,2}[.]\d{4}$"), F.try_to_date(text, "d.M.yyyy")),
        F.when(text.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.try_to_date(text, "d-M-yyyy")),
    )


def source_date(*values: Column) -> Column:
    """The first of several columns that holds a date."""
    return F.coalesce(*map(parse_date, values))


def source_year_end(value: Column) -> Column:
    """The last day of a four-digit year, as text."""
    text = clean(value)
    return F.when(text.rlike(r"^\d{4}$"), F.concat(text, F.lit("-12-31")))


def observed_micros(observed_at: Column, observed_date: Column) -> Column:
    """Microseconds of an observation in UTC; a text in `observed_at` decides even if it is no time."""
    at = F.replace(observed_at, F.lit(","), F.lit("."))
    at = F.when(observed_at.rlike(ISO_TIME) & ~observed_at.rlike(r"[T ]\d{2}(Z|[+-]|$)"), F.unix_micros(at.try_cast("timestamp"))).when(
        observed_at.rlike(ISO_TIME), F.unix_micros(F.regexp_replace(at, r"([T ]\d{2})", "$1:00").try_cast("timestamp"))
    )
    day = F.when(observed_date.rlike(ISO_DATE), F.unix_micros(observed_date.try_cast("date").cast("timestamp")))
    return F.coalesce(F.when(observed_at.isNotNull(), at).otherwise(day), F.lit(EARLIEST).cast("long"))


def date_part(value: Column, today: Column) -> Column:
    """The day of an ISO time, else `today`, both as text."""
    return F.when(value.rlike(ISO_TIME), F.coalesce(F.substring(value, 1, 10).try_cast("date").cast("string"), today)).otherwise(today)
