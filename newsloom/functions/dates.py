"""Dates as feeds and pages write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(raw: Column | str) -> Column:
    """struct(at timestamp, precision string) of a raw date.

    ISO 8601, then RFC 822, then the first YYYY-MM-DD in the text as UTC;
    else null and "unknown". Times without a zone are in the session's.
    """
    raw = F.trim(F.col(raw) if isinstance(raw, str) else raw)
    iso = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"), F.expr("1"))
    whole = F.when(iso.isNotNull(), F.try_to_timestamp(raw))
    day = F.regexp_replace(raw, r"^[A-Za-z]{3},\s*", "")
    zone = F.regexp_replace(day, r"\s(GMT|UTC|UT|Z)$", " +0000")
    mail = F.when(zone.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} [+-]\d{4}$"), F.try_to_timestamp(zone, F.lit("d MMM yyyy HH:mm:ss Z")))
    inside = F.regexp_extract(raw, r"(\d{4}-\d{2}-\d{2})", 1)
    loose = F.when(inside != "", F.try_to_timestamp(F.concat(inside, F.lit("T00:00:00Z"))))
    at = F.coalesce(whole, mail, loose)
    return F.struct(at.alias("at"), F.when(at.isNull(), "unknown").otherwise("exact").alias("precision"))


def within_days(at: Column | str, as_of: Column, days: int) -> Column:
    """Whether at is no older than ``days`` before as_of; null: no."""
    at = F.col(at) if isinstance(at, str) else at
    return F.coalesce(at >= as_of - F.make_dt_interval(F.lit(days)), F.lit(False))


def hours_apart(a: Column, b: Column) -> Column:
    """Hours between two instants, without sign."""
    return F.abs(F.unix_micros(a) - F.unix_micros(b)) / F.lit(3_600_000_000)
