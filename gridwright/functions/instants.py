"""Instants written as text by many clients."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: date, 'T' or blank, time with optional fraction, optional offset; nothing else is an instant.
INSTANT = r"^\s*(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(\.\d{1,9})?\s*(Z|z|[+-]\d{2}:?\d{2})?\s*$"


def instant(text: Column) -> Column:
    """TIMESTAMP of an ISO-like text, or null if it names no real instant.

    A stamp without offset is UTC, whatever the session's zone; others are converted.
    Null, blank, impossible dates (30 February) and hours past 23 give null.
    """
    part = lambda k: F.regexp_extract(text, INSTANT, k)
    offset = F.when(F.upper(part(4)).isin("", "Z"), F.lit("+00:00")).otherwise(F.regexp_replace(part(4), r"^([+-]\d{2}):?(\d{2})$", "$1:$2"))
    hour_ok = F.substring(part(2), 1, 2) <= F.lit("23")
    offset_ok = F.substring(offset, 2, 2) <= F.lit("18")
    iso = F.concat(part(1), F.lit("T"), part(2), F.substring(part(3), 1, 7), offset)
    return F.when(text.rlike(INSTANT) & hour_ok & offset_ok, iso.try_cast("timestamp"))


def utc_day(stamp: Column) -> Column:
    """The UTC calendar day of a TIMESTAMP, independent of the session's zone."""
    micros = F.unix_micros(stamp)
    return F.date_from_unix_date(F.floor(micros / F.lit(86_400_000_000)).cast("int"))
