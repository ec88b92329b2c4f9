"""Date expressions."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from estatelens.functions.text import blank_to_null
from estatelens.vocab import MONTHS

# --- fixed values: range of the two-byte date type the tables are declared with ---
DATE_MIN = date(1970, 1, 1)
DATE_MAX = date(2149, 6, 6)
_LAST_MILLIS = 253402300799999  # 9999-12-31T23:59:59.999Z


def dutch_date(text: Column) -> Column:
    """First ``op D maand YYYY`` in the text.  Only the first hit counts, valid or not."""
    words = F.split(F.regexp_extract(text, r"(?U)op (\d{1,2}) (\w+) (\d{4})", 0), " ")
    months = F.create_map(*[F.lit(f"{v:02d}" if isinstance(v, int) else v)
                            for pair in MONTHS.items() for v in pair])
    month = F.try_element_at(months, F.lower(F.get(words, F.lit(2))))
    year = F.get(words, F.lit(3))
    iso = F.concat_ws("-", year, month, F.lpad(F.get(words, F.lit(1)), 2, "0"))
    return F.when(month.isNotNull() & (year != "0000"), F.try_to_date(iso, "yyyy-MM-dd"))


def dotnet_date(value: Column, local: bool = False) -> Column:
    """``/Date(ms+hhmm)/`` as a date in UTC; ``local=True`` applies the written offset."""
    pattern = r"/Date\((\d+)([+-]\d{4})?\)/"
    millis = F.regexp_extract(value, pattern, 1).try_cast("bigint")
    if local:
        offset = blank_to_null(F.regexp_extract(value, pattern, 2))
        minutes = (F.substring(offset, 2, 2).try_cast("int") * 60
                   + F.substring(offset, 4, 2).try_cast("int"))
        signed = F.when(offset.startswith("-"), -minutes).otherwise(minutes)
        millis = millis + F.coalesce(signed, F.lit(0)) * 60000
    days = F.floor(millis / 86400000).try_cast("int")
    return F.when(millis <= _LAST_MILLIS, F.date_add(F.lit(DATE_MIN), days))


def iso_date_clamp(value: Column) -> Column:
    """First ten characters as ``YYYY-MM-DD``; NULL when malformed or out of the table range."""
    head = F.substring(value, 1, 10)
    day = F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(head, "yyyy-MM-dd"))
    return F.when(day.between(F.lit(DATE_MIN), F.lit(DATE_MAX)), day)


def dmy_date(value: Column) -> Column:
    """``dd-mm-yyyy``; the register's ``00-00-0000`` and other junk become NULL."""
    shaped = value.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$") & ~value.endswith("-0000")
    return F.when(shaped, F.try_to_date(value, "d-M-yyyy"))


def case_year(number: Column) -> Column:
    """Year a case was opened from its number (``F.10/26/194`` is 2026); 0 when unreadable."""
    yy = F.get(F.split(number, "/"), F.lit(1)).try_cast("int")
    return F.coalesce(F.when(yy <= 30, yy + 2000).otherwise(yy + 1900), F.lit(0))


def period_start(period: str, now: datetime) -> datetime:
    """Lower bound of a search period.  A constant, so filters on it reach the scan."""
    if period == "Laatste week":
        return now - timedelta(days=7)
    if period == "Vandaag":
        return now
    first = now.replace(day=1)
    month_back = first - timedelta(days=1)
    return month_back.replace(day=min(now.day, 28))
