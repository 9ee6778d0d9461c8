"""Wire dates, statement dates and period labels. Timestamps are UTC wall clock (NTZ)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Wire format of serialised dates and the spellings of bank exports; a month goes by its first three
# letters, a year of two digits from 50 on is of the last century.
WIRE_MILLIS = r"/Date\((\d+)([+-]\d{4})?\)/"
LAST_MILLIS = 8_640_000_000_000_000
ISO_TIMESTAMP = r"^\d{4}-\d{2}(-\d{2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?)?$"
ISO_DATE_PREFIX = r"^(\d{4}-\d{2}-\d{2})"
DAY_FIRST_PREFIX = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
YEAR_FIRST = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})(?!\d)"
WEEKDAY = r"^(?i)(mon|tue|wed|thu|fri|sat|sun)[a-z]*[,.]?\s+"
DAY_MONTH_YEAR = r"^(?i)(\d{1,2})[\s/-]+([a-z]{3,9})[.,]?[\s/-]+(\d{4}|\d{2})(?!\d)"
MONTH_DAY_YEAR = r"^(?i)([a-z]{3,9})[.]?[\s/-]+(\d{1,2})[\s,/-]+(\d{4}|\d{2})(?!\d)"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
FIRST_YEAR_OF_OLD_CENTURY = 50


def ts_literal(moment: dt.datetime | str) -> Column:
    """A naive UTC timestamp literal."""
    text = moment.isoformat(sep=" ") if isinstance(moment, dt.datetime) else moment
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def date_literal(day: dt.date | str) -> Column:
    return F.expr(f"DATE'{day}'")


def parse_wire_date(c: Column) -> Column:
    """``/Date(ms+zzzz)/`` (offset ignored, negative ms and ms beyond the last date rejected) or ISO text, else null."""
    # a failing try_cast is slow (it throws inside), so the common misses become null before it
    millis = F.nullif(F.regexp_extract(c, WIRE_MILLIS, 1), F.lit("")).try_cast("bigint")
    iso = F.when(c.rlike(ISO_TIMESTAMP), c.try_cast("timestamp"))
    return F.coalesce(F.timestamp_millis(F.when(millis <= LAST_MILLIS, millis)), iso).cast("timestamp_ntz")


def format_wire_date(ts: Column) -> Column:
    """Inverse of :func:`parse_wire_date` for an NTZ timestamp."""
    return F.concat(F.lit("/Date("), F.unix_millis(ts.cast("timestamp")).cast("string"), F.lit("+0000)/"))


def statement_date_text(c: Column) -> Column:
    """ISO text of a statement date, not yet checked against the calendar; null = unparseable.

    ISO prefix first, then day-month-year (always day first), then year first, then a named month in either order,
    with or without a weekday before it and a time after it.
    """
    iso = F.regexp_extract(c, ISO_DATE_PREFIX, 1)
    day, month, year = (F.regexp_extract(c, DAY_FIRST_PREFIX, i) for i in (1, 2, 3))
    return (
        F.when(iso != "", iso)
        .when(year != "", F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")))
        .otherwise(F.coalesce(*_other_spellings(c)))
    )


def _other_spellings(c: Column) -> list[Column]:
    """ISO text of each further spelling, null where the text is not of it."""
    def iso(text: Column, pattern: str, year: int, month: int, day: int, named: bool) -> Column:
        y, m, d = (F.regexp_extract(text, pattern, i) for i in (year, month, day))
        century = F.when(F.length(y) == 4, "").when(y >= str(FIRST_YEAR_OF_OLD_CENTURY), "19").otherwise("20")
        at = F.instr(F.lit(MONTHS), F.lower(F.substring(m, 1, 3))) if named else None
        number = F.when(at % 3 == 1, ((at + 2) / 3).cast("int").cast("string")) if named else m
        return F.when(y != "", F.concat(century, y, F.lit("-"), F.lpad(number, 2, "0"), F.lit("-"), F.lpad(d, 2, "0")))

    bare = F.regexp_replace(F.trim(c), WEEKDAY, "")
    return [iso(bare, YEAR_FIRST, 1, 2, 3, False), iso(bare, DAY_MONTH_YEAR, 3, 2, 1, True),
            iso(bare, MONTH_DAY_YEAR, 3, 1, 2, True)]


def calendar_date(iso_text: Column) -> Column:
    """ISO text to DATE; impossible days such as 31 February give null."""
    return F.try_to_date(iso_text, "yyyy-MM-dd")


def statement_date(c: Column) -> Column:
    return calendar_date(statement_date_text(c))


def period_label(c: Column) -> Column:
    return F.date_format(c, "MMM yyyy")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def micros_between(later: Column, earlier: Column) -> Column:
    """Exact microseconds between two NTZ timestamps."""
    return F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))


def millis_between(later: Column, earlier: Column) -> Column:
    """Milliseconds between two timestamps as a decimal with microsecond fraction."""
    return (micros_between(later, earlier).cast("decimal(20,0)") / F.lit(1000)).cast("decimal(20,3)")


def hours_between(later: Column, earlier: Column) -> Column:
    """Hours with one decimal, rounded half away from zero."""
    exact = micros_between(later, earlier).cast("decimal(20,0)") / F.lit(3_600_000_000).cast("decimal(12,0)")
    return F.round(exact, 1).cast("decimal(18,1)")


def hours_before(moment: Column, hours: int) -> Column:
    return moment - F.make_dt_interval(F.lit(0), F.lit(hours))
