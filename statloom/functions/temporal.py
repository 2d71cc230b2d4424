"""Dates and times: what a display format denotes, and stored numbers to Spark's types and back."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T

from ..formats import Family, Kind

DAY = 86_400_000_000
#: Below what dates and timestamps hold, whatever the epoch.
_MOST_DAYS, _MOST_MICROS = 2e9, 9.2e18 - 2e16
# SPSS names of formats for dates and times; fixed values.
_SPSS: dict[str, Kind] = {
    "DATE": "date",
    "ADATE": "date",
    "EDATE": "date",
    "JDATE": "date",
    "SDATE": "date",
    "DATETIME": "datetime",
    "YMDHMS": "datetime",
    "TIME": "time",
    "DTIME": "duration",
}
_SPSS_NAME = re.compile(r"[A-Z][A-Z0-9]*[A-Z]")
# A Stata clock format that shows nothing but the time of day; fixed pattern.
_CLOCK_ONLY = re.compile(r"[Hh]{1,2}(:[Mm]{2})?(:[Ss]{2}(\.s+)?)?(\s*[aApP]\.?[mM]\.?)?")

TYPES: dict[Kind, T.DataType] = {"date": T.DateType(), "datetime": T.TimestampNTZType(), "time": T.LongType(), "duration": T.DayTimeIntervalType()}


def classify(family: Family, display: str | None) -> Kind | None:
    """The kind of value that a display format shows, or None for plain numbers."""
    if not display:
        return None
    if family.key == "sav":
        name = _SPSS_NAME.match(display.upper())
        return _SPSS.get(name[0]) if name else None
    if display[:3] in ("%tc", "%tC"):
        return "time" if _CLOCK_ONLY.fullmatch(display, 3) else "datetime"
    return "date" if display.startswith(("%td", "%d")) else None


def kind_of(kind: T.DataType) -> Kind | None:
    """The kind of a Spark type, or None."""
    if isinstance(kind, T.DateType):
        return "date"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(kind, T.DayTimeIntervalType):
        return "duration"
    return "time" if kind.typeName() == "time" else None


def to_temporal(raw: Column, family: Family, kind: Kind) -> Column:
    """A stored number as date, timestamp without zone, microseconds of the day, or interval.

    Fractions below a microsecond (for Stata dates, below a day) go to the nearest, halves to the even
    one, as ``rint`` does; SPSS dates drop the time of day. A time of day beyond 24 hours wraps, and a
    negative one is null, as are NaN, infinities and numbers that Spark's type has no value for. Needs UTC as the session's time zone.
    """
    number = raw.cast("double")
    if kind == "date":
        days = number / 86400 if family.key == "sav" else F.rint(number)
        days = F.floor(F.when(F.abs(days) < _MOST_DAYS, days))
        return F.date_add(F.lit("1970-01-01").cast("date"), (days - family.epoch_days).cast("int"))
    micros = F.rint(number * family.unit)
    micros = F.when(F.abs(micros) < _MOST_MICROS, micros).cast("long")
    if kind == "datetime":
        return F.timestamp_micros(micros - family.epoch_days * DAY).cast("timestamp_ntz")
    if kind == "time":
        return F.when(micros >= 0, micros % DAY)
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)"))


def _interval_micros(value: Column) -> Column:
    seconds = F.extract(F.lit("SECOND"), value).cast("decimal(20,6)")
    whole = (F.extract(F.lit("DAY"), value) * 86400 + F.extract(F.lit("HOUR"), value) * 3600 + F.extract(F.lit("MINUTE"), value) * 60).cast("decimal(20,0)")
    return ((whole + seconds) * 1_000_000).cast("long")


def to_raw(value: Column, family: Family, kind: Kind) -> Column:
    """The number that a file stores for a temporal value; a time is given as microseconds of the day."""
    if kind == "date":
        days = F.unix_date(value) + family.epoch_days
        return days.cast("int") if family.key == "dta" else days * F.lit(86400.0)
    if kind == "datetime":
        micros = F.unix_micros(value.cast("timestamp")) + family.epoch_days * DAY
    else:
        micros = _interval_micros(value) if kind == "duration" else value.cast("long")
    return micros / F.lit(float(family.unit))
