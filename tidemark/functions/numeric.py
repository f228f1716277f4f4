"""Keys, null-tolerant arithmetic, buckets and unit conversion."""

from __future__ import annotations

from functools import reduce
from operator import add, sub

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def surrogate_key(*cols: str | Column, null_text: str = "") -> Column:
    """MD5 of the dash-joined text of the columns; NULL counts as ``null_text``, it never vanishes."""
    return F.md5(F.concat_ws("-", *[F.coalesce(_c(c).cast("string"), F.lit(null_text)) for c in cols]))


def safe_add(*cols: str | Column) -> Column:
    return reduce(add, [F.coalesce(_c(c), F.lit(0)) for c in cols])


def safe_subtract(*cols: str | Column) -> Column:
    return reduce(sub, [F.coalesce(_c(c), F.lit(0)) for c in cols])


def safe_divide(a: str | Column, b: str | Column) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return _c(a) / F.nullif(_c(b), F.lit(0))


def ratio_or_zero(a: str | Column, b: str | Column) -> Column:
    """Report rule for rates: 0 when the denominator is missing or zero."""
    return F.when(F.coalesce(_c(b), F.lit(0)) == 0, F.lit(0.0)).otherwise(
        _c(a).cast("double") / _c(b).cast("double")
    )


def width_bucket(col: str | Column, lo: float, hi: float, n: int) -> Column:
    """Equal-width bucket 1..n; below the range 0, at or above its end n+1."""
    return F.width_bucket(_c(col).cast("double"), F.lit(float(lo)), F.lit(float(hi)), F.lit(n).cast("bigint"))


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    a, b, c, d = (F.radians(_c(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    miles = F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
    return miles * F.lit(KM_PER_MILE) if unit == "km" else miles


def log_natural(col: str | Column) -> Column:
    return F.ln(_c(col))


def uniform(seed: int) -> Column:
    """Uniform number in [0, 1); the seed is required so that a rerun gives the same table."""
    return F.rand(seed)


def scale_units(value: str | Column, decimals: str | Column, exact: bool = False) -> Column:
    """Raw token amount to units: value * 10^-decimals; unknown decimals leave the raw value."""
    raw, dec = _c(value), F.coalesce(_c(decimals).cast("int"), F.lit(0))
    if exact:
        power = F.rpad(F.lit("1"), dec + 1, "0").cast("decimal(19,0)")
        return (raw.cast("decimal(38,0)") / power).cast("decimal(38,18)")
    return raw.cast("double") / F.pow(F.lit(10.0), dec.cast("double"))


def from_micros(col: str | Column, digits: int = 2) -> Column:
    return F.round(_c(col) / F.lit(1e6), digits)


def scan_cost(bytes_col: str | Column, price_per_gib: float) -> Column:
    return _c(bytes_col).cast("double") / F.lit(float(2**30)) * F.lit(price_per_gib)


def period_bucket(diff: str | Column, length: int) -> Column:
    """Whole periods of ``length`` units in a difference, as a number (so that 10 sorts after 9)."""
    return F.floor(_c(diff) / F.lit(length)).cast("bigint")


def lifetime_bucket(days: str | Column, thresholds: list[tuple[int, str]], beyond: str) -> Column:
    """Label of the first threshold the day count does not exceed."""
    expr = None
    for limit, label in sorted(thresholds):
        cond = _c(days) <= limit
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(beyond)


def step_function(col: str | Column, steps: list[tuple[float, int]], below: int = 0) -> Column:
    """Value of the highest step reached (points to level, points to rank)."""
    expr = F.lit(below)
    for limit, value in sorted(steps):
        expr = F.when(_c(col) >= limit, value).otherwise(expr)
    return expr
