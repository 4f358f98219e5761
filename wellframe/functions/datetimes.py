"""Date and time columns as the providers write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_date(date: Column) -> Column:
    """The calendar day of a landed date text, or null.

    Accepted: ``yyyy-MM-dd`` and ``yyyy/MM/dd`` (also followed by a time), ``MM/dd/yyyy``, and whole
    days counted from 1900-01-01. Month-only, empty and unreadable texts give null.
    """
    d = F.trim(date)
    size = F.length(d)
    fifth, third = F.substring(d, 5, 1), F.substring(d, 3, 1)
    year_first = F.translate(F.substring(d, 1, 10), "/", "-").try_cast("date")
    month_first = F.concat(F.substring(d, 7, 4), F.lit("-"), F.substring(d, 1, 2), F.lit("-"), F.substring(d, 4, 2)).try_cast("date")
    serial = F.date_add(F.lit("1900-01-01").cast("date"), d.try_cast("int"))
    return (
        F.when((size >= 10) & fifth.isin("-", "/"), year_first)
        .when((size >= 10) & (third == "/"), month_first)
        .when(size.between(4, 6) & d.rlike("^[0-9]+$"), serial)
    )


def epoch_seconds(date: Column, time: Column) -> Column:
    """UTC seconds of a landed reading, or null without a full date.

    The time inside ``date`` wins; otherwise ``time``; null, empty or unreadable times mean midnight.
    Fractions of a second and a trailing ``Z`` are cut off.
    """
    d = F.trim(date)
    clock = F.when((F.length(d) >= 16) & F.substring(d, 11, 1).isin("T", " "), F.substring(d, 12, 8)).otherwise(F.trim(time))
    part = lambda at: F.coalesce(F.substring(clock, at, 2).try_cast("int"), F.lit(0))
    return F.unix_date(full_date(date)).cast("long") * 86400 + part(1) * 3600 + part(4) * 60 + part(7)


def iso_utc(seconds: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` of UTC seconds, whatever the session's time zone."""
    day = F.date_from_unix_date(F.floor(seconds / 86400).cast("int")).cast("string")
    rest = F.pmod(seconds, F.lit(86400)).cast("int")
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    return F.concat(day, F.lit("T"), two(F.floor(rest / 3600)), F.lit(":"), two(F.floor(rest / 60) % 60), F.lit(":"), two(rest % 60), F.lit("Z"))
