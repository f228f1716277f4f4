"""Date parsing, epochs, parts, weeks and differences. Every clock is an explicit ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _c


def parse_date(col: str | Column, fmt: str, safe: bool = True) -> Column:
    return F.try_to_date(_c(col), fmt) if safe else F.to_date(_c(col), fmt)


def parse_timestamp(col: str | Column, fmt: str | None = None, safe: bool = True) -> Column:
    args = (_c(col),) if fmt is None else (_c(col), F.lit(fmt))
    return F.try_to_timestamp(*args) if safe else F.to_timestamp(_c(col), fmt)


def from_epoch(col: str | Column, unit: str = "seconds") -> Column:
    make = {"seconds": F.timestamp_seconds, "millis": F.timestamp_millis, "micros": F.timestamp_micros}[unit]
    return make(_c(col))


def to_epoch(col: str | Column, unit: str = "seconds") -> Column:
    make = {"seconds": F.unix_seconds, "millis": F.unix_millis, "micros": F.unix_micros}[unit]
    return make(_c(col).cast("timestamp"))


# Fixed value: microseconds from year 1 to the Unix epoch.
EPOCH_OFFSET_MICROS = 62135596800000000


def ticks_to_micros(col: str | Column) -> Column:
    """13 characters are epoch milliseconds, 16 are year-1 based; any other length gives NULL."""
    c = _c(col)
    return (
        F.when(F.length(c) == 13, c.try_cast("bigint") * 1000)
        .when(F.length(c) == 16, c.try_cast("bigint") * 10 - EPOCH_OFFSET_MICROS)
    )


def convert_timezone(col: str | Column, target: str, source: str = "UTC") -> Column:
    """Wall-clock time in ``source`` to wall-clock time in ``target``."""
    return F.convert_timezone(F.lit(source), F.lit(target), _c(col).cast("timestamp_ntz"))


def date_part(part: str, col: str | Column) -> Column:
    return F.extract(F.lit(part), _c(col)).cast("int")


def day_name(col: str | Column, short: bool = True) -> Column:
    return F.date_format(_c(col), "E" if short else "EEEE")


def month_name(col: str | Column, short: bool = True) -> Column:
    return F.date_format(_c(col), "MMM" if short else "MMMM")


def day_of_week(col: str | Column, iso: bool = True) -> Column:
    """Monday = 1 (iso) or Sunday = 1."""
    return (F.weekday(_c(col)) + 1) if iso else F.dayofweek(_c(col))


def week_start(col: str | Column) -> Column:
    """Sunday on or before the date."""
    return F.date_sub(_c(col), F.dayofweek(_c(col)) - 1)


def week_end(col: str | Column) -> Column:
    return F.date_add(week_start(col), 6)


def week_of_year(col: str | Column) -> Column:
    return F.ceil(F.dayofyear(_c(col)) / 7).cast("int")


def iso_week_start(col: str | Column) -> Column:
    return F.date_sub(_c(col), F.weekday(_c(col)))


def iso_week_end(col: str | Column) -> Column:
    return F.date_add(iso_week_start(col), 6)


def iso_week_of_year(col: str | Column) -> Column:
    return F.weekofyear(_c(col))


def shift(col: str | Column, n: int, unit: str = "day") -> Column:
    """The date n days, weeks, months or years away (negative: ago)."""
    c = _c(col)
    if unit == "day":
        return F.date_add(c, n)
    if unit == "week":
        return F.date_add(c, 7 * n)
    if unit in ("month", "quarter", "year"):
        return F.add_months(c, n * {"month": 1, "quarter": 3, "year": 12}[unit])
    raise ValueError(f"unsupported unit {unit!r}")


def as_date(as_of) -> Column:
    return F.lit(str(as_of)).cast("date")


def as_timestamp(as_of) -> Column:
    return F.lit(str(as_of)).cast("timestamp_ntz")


def boundaries(start: str | Column, end: str | Column, unit: str) -> Column:
    """Calendar boundaries of the unit crossed from start to end (not full units)."""
    a, b = _c(start), _c(end)
    if unit == "day":
        return F.datediff(b, a).cast("bigint")
    if unit == "week":
        return F.floor(F.datediff(iso_week_start(b), iso_week_start(a)) / 7).cast("bigint")
    if unit in ("month", "quarter", "year"):
        months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
        if unit == "month":
            return months.cast("bigint")
        if unit == "year":
            return (F.year(b) - F.year(a)).cast("bigint")
        return ((F.year(b) - F.year(a)) * 4 + F.quarter(b) - F.quarter(a)).cast("bigint")
    seconds = {"hour": 3600, "minute": 60, "second": 1}[unit]

    def whole(c: Column) -> Column:
        return F.floor(F.unix_seconds(c.cast("timestamp")) / seconds)

    return (whole(b) - whole(a)).cast("bigint")


def full_units(start: str | Column, end: str | Column, unit: str) -> Column:
    """Complete units between two timestamps, fractions cut off."""
    return F.timestamp_diff(unit.upper(), _c(start).cast("timestamp"), _c(end).cast("timestamp"))


def day_diff(a: str | Column, b: str | Column) -> Column:
    """a - b in calendar days."""
    return F.datediff(_c(a), _c(b)).cast("bigint")


def periods_since(col: str | Column, unit: str, as_of) -> Column:
    return boundaries(_c(col), as_timestamp(as_of), unit)


def round_to_day(col: str | Column) -> Column:
    """Nearest midnight; noon rounds up."""
    return F.date_trunc("day", _c(col) + F.expr("INTERVAL 12 HOURS"))


def quarter_end(col: str | Column) -> Column:
    return F.date_sub(F.add_months(F.trunc(_c(col), "quarter"), 3), 1)


def year_end(col: str | Column) -> Column:
    return F.date_sub(F.add_months(F.trunc(_c(col), "year"), 12), 1)
