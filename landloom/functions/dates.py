"""Date texts of the register as column expressions: two calendars, several dialects, kept as ISO text.

A day of 31 in a short month is kept where the register's own form allows it (``to_iso``); ``real_day`` tells.
Null and unreadable values give null.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .moments import day_on
from .text import fold_width

ROC_OFFSET, FIRST_GREGORIAN = 1911, 1911


def _part(c: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit("")).try_cast("int")


def _ymd(c: Column, pattern: str) -> tuple[Column, Column, Column]:
    return tuple(_part(c, pattern, i) for i in (1, 2, 3))


def iso_text(y: Column, m: Column, d: Column) -> Column:
    return F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(), F.format_string("%04d-%02d-%02d", y, m, d))


def to_iso(c: Column) -> Column:
    """``y/m/d`` in either calendar as ISO text; days up to 31 are taken in every month."""
    y, m, d = _ymd(F.trim(c), r"^(\d{1,4})/(\d{1,2})/(\d{1,2})$")
    y = F.when(y < FIRST_GREGORIAN, y + ROC_OFFSET).otherwise(y)
    return F.when(m.between(1, 12) & d.between(1, 31), iso_text(y, m, d))


def calendar_of(c: Column) -> Column:
    """'roc' or 'gregorian' for a cell that ``to_iso`` reads."""
    y = _part(F.trim(c), r"^(\d{1,4})/\d{1,2}/\d{1,2}$", 1)
    return F.when(to_iso(c).isNotNull(), F.when(y < FIRST_GREGORIAN, "roc").otherwise("gregorian"))


def real_day(iso: Column) -> Column:
    """The date of an ISO text, null where no such day exists."""
    y, m, d = _ymd(iso, r"^(\d{4})-(\d{2})-(\d{2})")
    return F.try_to_date(F.when(m.between(1, 12) & d.between(1, 31), iso_text(y, m, d)), "yyyy-MM-dd")


@F.pandas_udf(T.StringType())
def _clock_day(value: pd.Series, clock: pd.Series) -> pd.Series:
    return pd.Series([None if v is None else day_on(v, z) for v, z in zip(value, clock)], dtype=object)


def clock_day(c: Column, clock: Column) -> Column:
    """The day a value in any form of the register names, as ISO text; ISO days stay as they are, a moment is read on ``clock``."""
    iso = c.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.coalesce(F.when(iso, c), _clock_day(F.when(~iso, c), clock))


def roc_compact(c: Column) -> Column:
    """``YYYMMDD`` or ``YYMMDD`` with full-width digits folded; ROC years 50 to 200 and real days only."""
    t = fold_width(F.trim(c))
    iso = F.concat_ws("-", F.substring(t, F.lit(1), F.length(t) - 4).try_cast("int") + ROC_OFFSET, F.substring(t, -4, 2), F.substring(t, -2, 2))
    return F.when(t.rlike(r"^(?:0?[5-9][0-9]|1[0-9][0-9]|200)[0-9]{4}$") & F.try_to_date(iso, "yyyy-MM-dd").isNotNull(), iso)


def padded(c: Column) -> Column:
    """Slash, ISO or date-time texts with padded month and day; an ROC year stays as it is."""
    y, m, d = _ymd(F.trim(c), r"^(\d{1,4})[/-](\d{1,2})[/-](\d{1,2})(?:[T ].*)?$")
    return F.when(y.isNotNull(), F.concat_ws("-", F.lpad(y.cast("string"), F.when(y > 999, 4).otherwise(3), "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")))


def shift(iso: Column, days: int) -> Column:
    return F.date_format(F.date_add(real_day(iso), days), "yyyy-MM-dd")


def display_day(c: Column, not_after: Column, first_year: int = 1995) -> Column:
    """ISO, slash or ROC-dotted date, if it is a real day from ``first_year`` on and not later than ``not_after``."""
    t = F.trim(c)
    y, m, d = _ymd(t, r"^(\d{4})[/-](\d{1,2})[/-](\d{1,2})")
    ry, rm, rd = _ymd(t, r"^(\d{2,3})\.(\d{1,2})\.(\d{1,2})$")
    day = real_day(F.coalesce(iso_text(y, m, d), iso_text(ry + ROC_OFFSET, rm, rd)))
    return F.when((F.year(day) >= first_year) & (day <= not_after), day)


def years_between(a: Column, b: Column) -> Column:
    """Years from a to b, half up to two places; null if b is before a."""
    return F.when(b >= a, F.floor(F.datediff(b, a) / F.lit(365.25) * 100 + 0.5) / 100)


def closes(want: Column, first: Column, second: Column) -> Column:
    """How a date is confirmed: by field 1, field 2, a day beside one of them, or not at all; absent dates confirm nothing."""
    near = lambda f: F.abs(F.datediff(real_day(f), real_day(want))) == 1
    return (
        F.when(first == want, "field1").when(second == want, "field2").when(near(first), "field1_off_by_one").when(near(second), "field2_off_by_one").otherwise(F.lit("none"))
    )
