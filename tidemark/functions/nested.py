"""Event parameters, JSON text and arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numeric import _c

PARAM_KINDS = ["string_value", "int_value", "float_value", "double_value"]

PARAM_VALUE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
    T.StructField("float_value", T.DoubleType()),
    T.StructField("double_value", T.DoubleType()),
])
PARAMS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", PARAM_VALUE)]))


def param(key: str, *, string=None, int_=None, float_=None, double=None) -> Column:
    """One ``(key, value)`` entry of a parameter array."""
    def lit(v, kind):
        return (F.lit(None) if v is None else v).cast(kind)

    return F.struct(
        F.lit(key).alias("key"),
        F.struct(
            lit(string, "string").alias("string_value"),
            lit(int_, "bigint").alias("int_value"),
            lit(float_, "double").alias("float_value"),
            lit(double, "double").alias("double_value"),
        ).alias("value"),
    )


def event_param(col: str | Column, key: str, kind: str = "string_value", unique: bool = False) -> Column:
    """Value stored under a key, NULL when absent. ``unique`` raises when the key occurs twice."""
    if kind not in PARAM_KINDS:
        raise ValueError(f"kind must be one of {PARAM_KINDS}")
    hits = F.filter(_c(col), lambda p: p["key"] == key)
    value = F.get(hits, F.lit(0))["value"][kind]
    if not unique:
        return value
    return F.when(F.size(hits) > 1, F.raise_error(F.lit(f"event parameter {key} occurs more than once"))).otherwise(value)


def params_like(col: str | Column, *patterns: str) -> Column:
    """Sub-array of the parameters whose key matches one of the LIKE patterns."""
    def hit(p):
        cond = p["key"].like(patterns[0])
        for pattern in patterns[1:]:
            cond = cond | p["key"].like(pattern)
        return cond

    return F.filter(_c(col), hit)


def explode_params(df: DataFrame, col: str, keep: list[str]) -> DataFrame:
    """One row per parameter with its text and its number (double, float or int, first present)."""
    rows = df.select(*keep, F.explode(col).alias("__p"))
    v = F.col("__p.value")
    return rows.select(
        *keep,
        F.col("__p.key").alias("param_key"),
        v["string_value"].alias("param_text"),
        F.coalesce(v["double_value"], v["float_value"], v["int_value"].cast("double")).alias("param_number"),
    )


def json_scalar(col: str | Column, path: str) -> Column:
    return F.get_json_object(_c(col), path)


def json_first(cols: list[str], path: str) -> Column:
    """First non-null value of one path over several columns that share a record."""
    return F.coalesce(*[F.get_json_object(c, path) for c in cols])


def json_fields(df: DataFrame, col: str, fields: dict[str, str]) -> DataFrame:
    """Several top-level fields of one JSON column, parsed once. ``fields`` maps name to Spark type."""
    schema = ", ".join(f"`{n}` {t}" for n, t in fields.items())
    return df.withColumn("__j", F.from_json(col, schema)).select(
        *[c for c in df.columns if c not in fields], *[F.col(f"__j.`{n}`").alias(n) for n in fields]
    )


def json_array(col: str | Column, path: str) -> Column:
    return F.from_json(F.get_json_object(_c(col), path), T.ArrayType(T.StringType()))


def array_at(arr: Column, n: int) -> Column:
    """0-based element, NULL when the array is shorter."""
    return F.get(arr, F.lit(n))


def unwrap_list(col: str | Column) -> Column:
    """``{list: [{element: x}, ...]}`` as written by some Parquet writers, to a plain array."""
    return F.transform(_c(col)["list"], lambda e: e["element"])


def array_first_nulls_first(col: str | Column) -> Column:
    """Smallest element, where a NULL element counts as the smallest."""
    c = _c(col)
    return F.when(F.exists(c, lambda x: x.isNull()), F.lit(None)).otherwise(F.array_min(c))


def array_last(col: str | Column) -> Column:
    """Greatest element: the defined stand-in for 'last' of an unordered array."""
    return F.array_max(_c(col))


def load_metadata(sources: list[str], loaded_at: str) -> Column:
    return F.array(F.struct(
        F.lit(loaded_at).cast("timestamp").alias("load_timestamp"), F.lit("|".join(sources)).alias("sources")
    ))
