"""Dates and ISO weeks. Weeks are strings such as 2026-W39; their text order is their time order."""

from __future__ import annotations

import datetime as dt
import re
import warnings

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.functions.text import bind, strip_accents

# fixed values: accent-free month names
MONTHS_CS = {
    "ledna": 1, "leden": 1, "unora": 2, "unor": 2, "brezna": 3, "brezen": 3, "dubna": 4, "duben": 4, "kvetna": 5,
    "kveten": 5, "cervna": 6, "cerven": 6, "cervence": 7, "cervenec": 7, "srpna": 8, "srpen": 8, "zari": 9,
    "rijna": 10, "rijen": 10, "listopadu": 11, "listopad": 11, "prosince": 12, "prosinec": 12,
}
MONTHS_PL = {
    "stycznia": 1, "lutego": 2, "marca": 3, "kwietnia": 4, "maja": 5, "czerwca": 6, "lipca": 7, "sierpnia": 8,
    "wrzesnia": 9, "pazdziernika": 10, "listopada": 11, "grudnia": 12,
}
MONTHS_EN = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8,
    "september": 9, "october": 10, "november": 11, "december": 12,
}
YEAR_FROM, YEAR_TO = 1990, 2100


def _month_number(name: Column, table: dict[str, int]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for p in table.items() for x in p]), name)


def _day(y: Column, m: Column, d: Column) -> Column:
    """A date, or null where the calendar has no such day."""
    text = F.format_string("%04d-%02d-%02d", y.cast("int"), m.cast("int"), d.cast("int"))
    known = y.isNotNull() & m.isNotNull() & d.isNotNull()
    return F.try_to_date(F.when(known, text), "yyyy-MM-dd")


def _group(text: Column, pattern: str, index: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, index), F.lit(""))


@F.pandas_udf(T.TimestampType())
def _fuzzy(values: pd.Series, today: pd.Series) -> pd.Series:
    """English prose around a date; only rows no built-in format understands arrive here non-null.

    Parts the text leaves out (such as the year) come from ``today``.
    """
    from dateutil import parser

    def one(text, day):
        if text is None:
            return None
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                found = parser.parse(text, fuzzy=True, dayfirst=re.match(r"\d{4}-", text) is None,
                                     default=dt.datetime(day.year, day.month, day.day))
        except (ValueError, OverflowError, TypeError):
            return None
        if not YEAR_FROM <= found.year <= YEAR_TO:
            return None
        if found.utcoffset() is not None:
            found = found.astimezone(dt.timezone.utc)
        return found.replace(tzinfo=None)

    return pd.Series([one(v, d) for v, d in zip(values, today)], dtype="datetime64[us]")


_NAMED = r"(\d{1,2})\.?\s+([a-z]+)\s+(\d{4})"
_DOTTED = r"\b(\d{1,2})\.\s?(\d{1,2})\.\s?(\d{4})\b"
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?\s?(Z|[+\-]\d{2}:?\d{2})?$"
_MAIL = r"^(?:[A-Za-z]{3,9},?\s+)?(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4})\s+(\d{2}:\d{2})(:\d{2})?\s*(GMT|UTC|UT|Z|[+\-]\d{4})?$"


def parse_date(value: Column, now: Column | None = None) -> Column:
    """Text in one of many spellings to a UTC timestamp; null when it holds no usable date."""
    now = F.current_timestamp() if now is None else now
    text = F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)\s+", " "))
    direct = F.coalesce(_iso_stamp(text), _mail_stamp(text))
    in_years = F.when(F.year(direct).between(YEAR_FROM, YEAR_TO), direct)
    rest = _fuzzy(F.when((text != "") & ~text.rlike(_DOTTED) & direct.isNull(), text), now)
    day = bind(F.lower(strip_accents(text)), _local_day)
    return F.when(day["found"], day["stamp"]).when(direct.isNotNull(), in_years).otherwise(rest)


def _iso_stamp(text: Column) -> Column:
    spelled = F.regexp_replace(F.regexp_replace(text, r"\s(?=[Z+\-])", ""), r"([+\-]\d{2})(\d{2})$", "$1:$2")
    return F.when(text.rlike(_ISO), spelled.try_cast("timestamp"))


def _mail_stamp(text: Column) -> Column:
    zone = F.regexp_replace(F.regexp_extract(text, _MAIL, 6), "^(GMT|UTC|UT|Z)?$", "+0000")
    seconds = F.regexp_extract(text, _MAIL, 5)
    spelled = F.concat_ws(" ", F.regexp_extract(text, _MAIL, 1), F.initcap(F.regexp_extract(text, _MAIL, 2)),
                          F.regexp_extract(text, _MAIL, 3),
                          F.concat(F.regexp_extract(text, _MAIL, 4),
                                   F.when(seconds == "", F.lit(":00")).otherwise(seconds)), zone)
    return F.try_to_timestamp(F.when(text.rlike(_MAIL), spelled), F.lit("d MMM yyyy HH:mm:ss Z"))


def _local_day(plain: Column) -> Column:
    """Days with a Czech or Polish month name or in dotted form; such a form decides even if no such day exists."""
    month = _month_number(F.regexp_extract(plain, _NAMED, 2), {**MONTHS_PL, **MONTHS_CS})
    named_day = _day(_group(plain, _NAMED, 3), month, _group(plain, _NAMED, 1)).cast("timestamp")
    dotted_day = _day(_group(plain, _DOTTED, 3), _group(plain, _DOTTED, 2), _group(plain, _DOTTED, 1)).cast("timestamp")
    named = plain.rlike(_NAMED) & month.isNotNull()
    dotted = plain.rlike(_DOTTED)
    return F.struct((named | dotted).alias("found"), F.when(named, named_day).when(dotted, dotted_day).alias("stamp"))


_DL_ISO = r"(\d{4})-(\d{1,2})-(\d{1,2})"
_DL_DOTTED = r"(\d{1,2})\.\s*(\d{1,2})\.\s*(\d{4})"
_DL_MONTH = r"\b([a-z]+)\s+(\d{4})"


def parse_deadline(value: Column) -> Column:
    """A deadline in prose to a date; a bare month means its last day. The first form found decides."""
    months = {**MONTHS_CS, **MONTHS_EN}

    def read(t: Column) -> Column:
        named = _day(_group(t, _NAMED, 3), _month_number(F.regexp_extract(t, _NAMED, 2), months), _group(t, _NAMED, 1))
        month = _month_number(F.regexp_extract(t, _DL_MONTH, 1), months)
        return (F.when(t.rlike(_DL_ISO), _day(_group(t, _DL_ISO, 1), _group(t, _DL_ISO, 2), _group(t, _DL_ISO, 3)))
                .when(t.rlike(_DL_DOTTED), _day(_group(t, _DL_DOTTED, 3), _group(t, _DL_DOTTED, 2),
                                                _group(t, _DL_DOTTED, 1)))
                .when(t.rlike(_NAMED), named)
                .when(t.rlike(_DL_MONTH), F.last_day(_day(_group(t, _DL_MONTH, 2), month, F.lit(1)))))

    return bind(F.lower(strip_accents(F.coalesce(value, F.lit("")))), read)


def week_of(stamp: Column) -> Column:
    year = F.extract(F.lit("YEAROFWEEK"), stamp)
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(stamp).cast("string"), 2, "0"))


def week_start(stamp: Column) -> Column:
    return F.date_trunc("week", stamp)


def week_monday(week: Column) -> Column:
    """Monday of an ISO week given as text."""
    year, number = F.substring(week, 1, 4).cast("int"), F.substring(week, 7, 2).cast("int")
    fourth = F.make_date(year, F.lit(1), F.lit(4))  # always inside week 1
    return F.date_add(F.date_trunc("week", fourth).cast("date"), (number - 1) * 7)


def plus_weeks(week: Column, n) -> Column:
    return week_of(F.date_add(week_monday(week), F.lit(n) * 7))


def week_bounds(week: str) -> tuple[dt.datetime, dt.datetime]:
    """First and last microsecond of a week, for literals on the driver."""
    year, number = week.split("-W")
    monday = dt.date.fromisocalendar(int(year), int(number), 1)
    start = dt.datetime.combine(monday, dt.time.min)
    return start, start + dt.timedelta(days=7) - dt.timedelta(microseconds=1)


def shift_week(week: str, n: int) -> str:
    start, _ = week_bounds(week)
    iso = (start + dt.timedelta(weeks=n)).isocalendar()
    return f"{iso[0]}-W{iso[1]:02d}"


def last_completed_week(now: dt.datetime) -> str:
    iso = (now - dt.timedelta(days=7)).isocalendar()
    return f"{iso[0]}-W{iso[1]:02d}"


def stamp_literal(value: dt.datetime) -> Column:
    """A UTC timestamp literal that does not depend on the driver's own time zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def deadline_window(ref: dt.datetime, months: int) -> tuple[dt.date, dt.date]:
    start = ref.date()
    return start, start + dt.timedelta(days=round(months * 30.5))


def to_utc(text: Column) -> Column:
    """A stamp with or without an offset; without one it is taken as UTC (the session zone)."""
    return text.try_cast("timestamp")
