"""URL parts by plain text rules, so that schemeless input works as well."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _c

# Schemes that are cut off before the host is read.
SCHEMES = ["android-app://", "http://", "https://"]


def _without_scheme(col: str | Column) -> Column:
    c = _c(col)
    for scheme in SCHEMES:
        c = F.replace(c, F.lit(scheme), F.lit(""))
    return c


def _part(c: Column, delimiter: str, n: int) -> Column:
    return F.split_part(c, F.lit(delimiter), F.lit(n))


def url_host(col: str | Column) -> Column:
    return _part(_part(_without_scheme(col), "/", 1), "?", 1)


def url_path(col: str | Column) -> Column:
    """Text after the first slash up to the query; '' when there is no slash."""
    rest = _without_scheme(col)
    slash = F.locate("/", rest)
    return _part(F.when(slash == 0, "").otherwise(F.substr(rest, slash + 1)), "?", 1)


def url_parameter(col: str | Column, name: str) -> Column:
    """Text after ``name=`` up to ``&``; NULL when absent. The name matches as a plain substring."""
    return F.nullif(_part(_part(_c(col), f"{name}=", 2), "&", 1), F.lit(""))


def url_authority(col: str | Column) -> Column:
    """Host between ``://`` and the next slash, NULL when the URL has no such part."""
    return F.nullif(F.regexp_extract(_c(col), "://([^/]+)/", 1), F.lit(""))
