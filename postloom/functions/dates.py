"""Dates from text of many formats: an ordered chain of readers, of which the first that understands the text wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions import text

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_MONTH = "(" + "|".join(MONTHS) + ")[a-z]*\\.?"
_CLOCK = r"(?:[ ,]+(\d{1,2}):(\d{2})(?::(\d{2}))?)?(?:\.\d+)?\s*(?:gmt|utc|z)?"


def moment(year: Column, month: Column, day: Column, hour: Column | int = 0, minute: Column | int = 0, second: Column | int = 0) -> Column:
    """A time in UTC from numbers; months and days beyond their range run over into the next, as in a calendar that counts on."""
    number = lambda c: F.coalesce(F.nullif(c, F.lit("")).try_cast("int"), F.lit(0)) if isinstance(c, Column) else F.lit(c)
    day_ = F.date_add(F.add_months(F.make_date(number(year), F.lit(1), F.lit(1)), number(month) - 1), number(day) - 1)
    return F.timestamp_add("SECOND", number(hour) * 3600 + number(minute) * 60 + number(second), day_.cast("timestamp"))


def coerce_date(value: Column) -> Column:
    """The time that a text says, UTC where it names no zone; null if no reader understands it.

    Snapshot stamps (20260715-1230), plain dates, `2026-07-15 12:30 UTC`, US dates with slashes (two digits of a year are of this
    century), ISO times with a zone, and dates with month names, before or after the day, with or without week day and clock.
    """
    raw = text.clean(value)
    # a week day says nothing that the date doesn't
    said = F.regexp_replace(F.lower(raw), r"^(mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+", "")

    def read(pattern: str, *parts: int | None, month_at: int | None = None) -> Column:
        got = [F.regexp_extract(said, pattern, p) if p else 0 for p in parts]
        if month_at is not None:
            got[month_at] = F.array_position(F.array(*map(F.lit, MONTHS)), got[month_at]).cast("string")
        return F.when(said.rlike(pattern), moment(*got))

    year = F.regexp_extract(said, r"^\d{1,2}/\d{1,2}/(\d{2}|\d{4})$", 1)
    us = r"^(\d{1,2})/(\d{1,2})/(\d{2}|\d{4})$"
    century = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    iso = said.rlike(r"^\d{4}-\d{2}-\d{2}[t ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(z|[+-]\d{2}:?\d{2})?$")
    # a zone without a colon gets one, and none is UTC
    zoned = F.regexp_replace(F.regexp_replace(F.upper(raw), r"\s*([+-]\d{2}):?(\d{2})$", "$1:$2"), r"(\d{2}:\d{2})\s+Z$", "$1Z")
    return F.coalesce(
        read(r"^(\d{4})(\d{2})(\d{2})-(\d{2})(\d{2})$", 1, 2, 3, 4, 5),
        read(r"^(\d{4})-(\d{2})-(\d{2})$", 1, 2, 3),
        read(r"^(\d{4})-(\d{2})-(\d{2})\s+(\d{2}):(\d{2})\s+utc$", 1, 2, 3, 4, 5),
        F.when(said.rlike(us), moment(century, F.regexp_extract(said, us, 1), F.regexp_extract(said, us, 2))),
        F.when(iso, zoned.try_cast("timestamp")),
        read(rf"^{_MONTH}\s+(\d{{1,2}}),?\s+(\d{{4}}){_CLOCK}$", 3, 1, 2, 4, 5, 6, month_at=1),
        read(rf"^(\d{{1,2}})\s+{_MONTH},?\s+(\d{{4}}){_CLOCK}$", 3, 2, 1, 4, 5, 6, month_at=1),
    )


def shown_date(value: Column) -> Column:
    """yyyy-mm-dd of a text's date, else empty."""
    return F.coalesce(F.date_format(coerce_date(value), "yyyy-MM-dd"), F.lit(""))


def shown_range(low: Column, high: Column) -> Column:
    """`low to high` of two times, one of them if they show alike, empty without any."""
    a, b = (F.date_format(c, "yyyy-MM-dd HH:mm 'UTC'") for c in (low, high))
    return F.coalesce(F.when(a == b, a).otherwise(F.concat(a, F.lit(" to "), b)), F.lit(""))


def age_days(value: Column, now: Column) -> Column:
    """Whole UTC days from a text's date to now, at least 0."""
    return F.greatest(F.datediff(now, coerce_date(value)), F.lit(0))
