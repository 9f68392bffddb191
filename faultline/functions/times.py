"""Time: parsing, calendar grains, and timestamps written inside text.

Everything is ``timestamp_ntz``, so no result depends on the session time zone.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P
from .text import first_match, lookup, rx, strip_ws

# Largest day serial of the spreadsheet calendar (9999-12-31).
_MAX_SERIAL = 2958465


_FORMAT_PARTS = {
    "yyyy": r"(\d{4})", "MMM": r"(\p{L}{3})", "MM": r"(\d{1,2})", "dd": r"(\d{1,2})", "HH": r"(\d{1,2})", "mm": r"(\d{2})", "ss": r"(\d{2})",
}


def parse_format(c: Column, fmt: str) -> Column:
    """Time from text of exactly this form; ``yyyy MMM MM dd HH mm ss`` are its fields, absent ones 1 or 0.

    Day and month may have one digit; month names are English abbreviations.
    Anything else, or a date that does not exist, gives NULL.
    """
    pieces = re.split(f"({'|'.join(_FORMAT_PARTS)})", fmt)
    names = [x for x in pieces if x in _FORMAT_PARTS]
    pattern = "^" + "".join(_FORMAT_PARTS.get(x, re.escape(x)) for x in pieces) + r"\z"
    text = strip_ws(c)

    def part(name: str, default: str, size: int = 2) -> Column:
        if name not in names:
            return F.lit(default)
        return F.lpad(F.regexp_extract(text, pattern, names.index(name) + 1), size, "0")

    months = {name: f"{i:02d}" for i, name in enumerate(P.MONTH_ABBREVIATIONS, start=1)}
    named = "MMM" in names
    month = lookup(F.lower(part("MMM", "", 3)), months) if named else part("MM", "01")
    date = F.concat_ws("-", part("yyyy", "1970", 4), F.coalesce(month, F.lit("00")), part("dd", "01"))
    iso = F.concat(date, F.lit("T"), F.concat_ws(":", part("HH", "00"), part("mm", "00"), part("ss", "00")))
    return F.when(text.rlike(pattern), iso.try_cast("timestamp_ntz"))


def parse_opened(c: Column, formats: Sequence[str] = ()) -> Column:
    """Opening time from text: day serials since 1899-12-30, ISO-like text, else the first of ``formats`` that fits.

    Whether ``01/02/2024`` is in January or February is the caller's choice of
    formats. The fraction of a serial is the time of day. Other text gives NULL.
    """
    days = c.try_cast("double")
    micros = F.round(days * F.lit(86400000000.0)).try_cast("bigint")
    origin = F.lit(P.SERIAL_DAY_ORIGIN).cast("timestamp_ntz")
    from_serial = F.when(F.abs(days) <= _MAX_SERIAL, F.timestamp_add("MICROSECOND", micros, origin))
    forms = [c.try_cast("timestamp_ntz"), *(parse_format(c, f) for f in formats)]
    return F.when(c.rlike(rx(P.SERIAL_DAYS)), from_serial).otherwise(F.coalesce(*forms))


def opened_time(df: DataFrame, opened: str = "opened", formats: Sequence[str] = ()) -> Column:
    """The opening time of a time column, or of text (see :func:`parse_opened`)."""
    c = F.col(opened)
    if dict(df.dtypes)[opened].startswith(("timestamp", "date")):
        return c.cast("timestamp_ntz")
    return parse_opened(c.cast("string"), formats)


def month(ts: Column) -> Column:
    return F.substring(ts.cast("date").cast("string"), 1, 7)


def week(ts: Column) -> Column:
    """Monday and Sunday of the week, ``yyyy-MM-dd/yyyy-MM-dd``."""
    day = ts.cast("date")
    monday = F.date_sub(day, F.weekday(day))
    return F.concat(monday.cast("string"), F.lit("/"), F.date_add(monday, 6).cast("string"))


def weekday(ts: Column) -> Column:
    """English day name, whatever the session's locale."""
    names = F.array(*[F.lit(d) for d in P.WEEKDAYS])
    return F.get(names, F.weekday(ts))


def daypart(hour: Column) -> Column:
    out = None
    for last, label in P.DAYPARTS:
        out = F.when(hour <= last, label) if out is None else out.when(hour <= last, label)
    return out


def add_time_grains(df: DataFrame, ts: str = "opened_dt") -> DataFrame:
    """Append ``month week dow hour daypart`` of the timestamp column ``ts``."""
    t = F.col(ts)
    hour = F.hour(t).cast("long")
    return df.withColumns(
        {
            "month": month(t),
            "week": week(t),
            "dow": weekday(t),
            "hour": hour,
            "daypart": daypart(hour),
        }
    )


def _day_name_time(raw: Column) -> Column:
    """``Mon Dec 22 19:22:11 GMT 2025`` as a timestamp, NULL when out of range."""

    def part(n: int) -> Column:
        return F.regexp_extract(
            raw, r"(?U)^\S+\s+(\S+)\s+(\d{1,2})\s+(\d{2}:\d{2}:\d{2})\s+GMT\s+(\d{4})\z", n
        )

    months = {name: f"{i:02d}" for i, name in enumerate(P.MONTH_ABBREVIATIONS, start=1)}
    iso = F.concat(
        part(4), F.lit("-"), lookup(F.lower(part(1)), months), F.lit("-"),
        F.lpad(part(2), 2, "0"), F.lit("T"), part(3),
    )
    return iso.try_cast("timestamp_ntz")


def _iso_seconds(ts: Column) -> Column:
    return F.translate(F.substring(ts.cast("string"), 1, 19), " ", "T")


def raw_times(c: Column, profile: str) -> dict[str, Column]:
    """Raw texts the time extractors read: ``_iso``, ``_named`` and, for v3, ``_fired``.

    Meant as a stage of its own, so each pattern is searched once per row.
    """
    iso, named = (
        (P.ISO_TIME_V2, P.DAY_NAME_TIME_V2) if profile == "v2" else (P.ISO_TIME_V3, P.DAY_NAME_TIME_V3)
    )
    raw = {"_iso": first_match(c, iso, 0), "_named": first_match(c, named, 0)}
    if profile == "v3":
        raw["_fired"] = first_match(c, P.FIRED_TIME, 1, ignore_case=True)
    return raw


def _parsed_iso(iso: Column) -> Column:
    return F.replace(iso, F.lit("Z"), F.lit("")).try_cast("timestamp_ntz")


def fired_time(iso: Column, named: Column) -> dict[str, Column]:
    """``fired_time`` and the raw ``fired_time_source``.

    An ISO time that parses is returned as written with no source. Otherwise the
    day-name form gives its ISO rendering (NULL when out of range) and its text.
    """
    usable = _parsed_iso(iso).isNotNull()
    return {
        "fired_time": F.when(usable, iso).otherwise(_iso_seconds(_day_name_time(named))),
        "fired_time_source": F.when(~usable, named),
    }


def _iso_utc(ts: Column) -> Column:
    """ISO text with a ``+00:00`` offset; microseconds only when not zero."""
    fraction = F.regexp_extract(ts.cast("string"), r"\.(\d+)\z", 1)
    return F.concat(
        _iso_seconds(ts),
        F.when(fraction != "", F.concat(F.lit("."), F.rpad(fraction, 6, "0"))).otherwise(""),
        F.lit("+00:00"),
    )


def extracted_timestamp(iso: Column, named: Column, fired: Column | None = None) -> Column:
    """``Fired Date Time`` as written when given, else ISO as UTC, else day-name form; ``''`` if none."""
    zoned = F.concat(_iso_seconds(_day_name_time(named)), F.lit("Z"))
    forms = [_iso_utc(_parsed_iso(iso)), zoned, F.lit("")]
    return F.coalesce(*([fired] if fired is not None else []), *forms)
