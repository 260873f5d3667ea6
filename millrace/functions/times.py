"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_of_iso(col: Column) -> Column:
    """Year out of an ISO text."""
    return F.substring(col, 1, 4).try_cast("int")


def timestamp_of_iso(col: Column) -> Column:
    """Timestamp from the six fields of ``yyyy-MM-ddTHH:mm:ss``; null when a field is bad."""
    fields = [F.substring(col, at, n).try_cast("int") for at, n in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2))]
    return F.try_make_timestamp(*fields)


def _clock(hhmm: Column) -> tuple[Column, Column, Column]:
    """Padded text of an HHMM time, its hour and its minute."""
    padded = F.lpad(hhmm.cast("string"), 4, "0")
    return padded, F.substring(padded, 1, 2).try_cast("int"), F.substring(padded, 3, 2).try_cast("int")


def clock_text(hhmm: Column) -> Column:
    """``HH:mm`` from a time written as 5, 45, 545 or 1545; null past 23:59."""
    padded, hour, minute = _clock(hhmm)
    return F.when(
        hour.between(0, 23) & minute.between(0, 59),
        F.concat(F.substring(padded, 1, 2), F.lit(":"), F.substring(padded, 3, 2)),
    )


def at_clock(date: Column, hhmm: Column) -> Column:
    """Timestamp of a date at an HHMM time; null unless that is up to four digits and not past 23:59.

    Put together from numbers: parsing a text takes several times as long.
    """
    padded, hour, minute = _clock(hhmm)
    at = F.try_make_timestamp(F.year(date), F.month(date), F.day(date), hour, minute, F.lit(0))
    return F.when(F.lpad((hour * 100 + minute).cast("string"), 4, "0") == padded, at)


def to_utc(ts: Column, zone: Column) -> Column:
    return F.to_utc_timestamp(ts, zone)


def shift_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_interval(hours=F.lit(hours))


def shift_minutes(ts: Column, minutes: Column) -> Column:
    """Whole minutes added; fractions are cut."""
    return F.timestamp_add("MINUTE", minutes.cast("int"), ts)


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def hour_bucket(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def day_number(date: Column) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(F.to_date(date))


def monday_weekday(date: Column) -> Column:
    """Monday 1 … Sunday 7."""
    return F.weekday(date) + F.lit(1)


def year_quarter(date: Column) -> Column:
    """Text such as ``2015-Q1``; sorts by time."""
    return F.concat(F.year(date).cast("string"), F.lit("-Q"), F.quarter(date).cast("string"))


def us_text_to_iso(col: Column) -> Column:
    """``M/d/yyyy h:mm:ss a`` text as an ISO date text; null when it does not parse."""
    return F.date_format(F.try_to_timestamp(col, F.lit("M/d/yyyy h:mm:ss a")), "yyyy-MM-dd")


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def to_epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def bar_label(ts: Column, intraday: bool) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm" if intraday else "yyyy-MM-dd")


def hhmm_minutes(hhmm: Column) -> Column:
    """Minutes after midnight of an HHMM number."""
    n = hhmm.cast("int")
    return F.floor(n / F.lit(100)).cast("int") * 60 + n % 100


def elapsed_minutes(start: Column, end: Column, compat: bool = False) -> Column:
    """Minutes from one HHMM time to a later one, over midnight if it reads earlier.

    ``compat`` subtracts the HHMM numbers and splits the difference, which is
    wrong whenever the minutes borrow; it is kept for comparing old results.
    """
    if compat:
        a, b = start.cast("int"), end.cast("int")
        gap = F.when(b < a, b + 2400 - a).otherwise(b - a)
        return F.floor(gap / F.lit(100)).cast("int") * 60 + gap % 100
    a, b = hhmm_minutes(start), hhmm_minutes(end)
    return F.when(b < a, b + 1440 - a).otherwise(b - a)


def block_label(hhmm: Column) -> Column:
    """Hour block such as ``0900-1059``; the end hour is one more than the start hour."""
    hour = F.floor(hhmm.cast("int") / F.lit(100)).cast("int")
    pad = lambda h: F.lpad(h.cast("string"), 2, "0")
    return F.concat(pad(hour), F.lit("00-"), pad(hour + 1), F.lit("59"))


def quarter_hour_bucket(hhmm: Column) -> Column:
    """``hour_quarter`` such as ``9_2`` for 09:30 to 09:44."""
    n = hhmm.cast("int")
    hour, minute = F.floor(n / F.lit(100)), n % 100
    return F.concat_ws("_", hour.cast("string"), F.floor(minute / F.lit(15)).cast("string"))


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMM")


def weekday_name(date: Column) -> Column:
    return F.date_format(date, "E")
