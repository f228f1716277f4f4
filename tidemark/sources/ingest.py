"""Report files and record dumps to all-string tables, and nested records to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import _c


def normalize_names(names: list[str]) -> list[str]:
    """Lower case, blanks and dots to underscores."""
    return [n.strip().lower().replace(" ", "_").replace(".", "_") for n in names]


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalize_names(df.columns))


def ingest_csv_reports(spark: SparkSession, glob: str, date_regex: str, date_format: str = "yyyyMMdd", sep: str = ",", encoding: str = "UTF-8",
                       columns: list[str] | None = None, distinct: bool = False, loaded: DataFrame | None = None, date_col: str = "snapshot_date") -> DataFrame:
    """All-string rows of report files with the date taken from the file path.

    Gzip is opened by the reader. ``loaded`` holds the dates already in the target: their files are skipped.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("sep", sep).option("encoding", encoding)
    if encoding.upper().startswith("UTF-16"):
        reader = reader.option("multiLine", True)
    df = reader.csv(glob)
    found = F.regexp_extract(F.col("_metadata.file_path"), date_regex, 1)
    df = df.withColumn("__date", F.to_date(found, date_format))
    if columns:
        df = df.select(*columns, "__date")
    if distinct:
        df = df.distinct()
    if loaded is not None:
        df = df.join(loaded.select(F.col(date_col).alias("__date")).distinct(), "__date", "left_anti")
    out = normalize_names([c for c in df.columns if c != "__date"])
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip([c for c in df.columns if c != "__date"], out)], F.col("__date").alias(date_col))


def ingest_json_columns(spark: SparkSession, glob: str, columns: list[str], multi_line: bool = False) -> DataFrame:
    """Declared columns of a JSON dump as strings; columns that are absent come out NULL."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("multiLine", multi_line).json(glob).select(*columns)


def explode_zip(df: DataFrame, cols: list[str], keep_empty: bool = True) -> DataFrame:
    """Bracketed lists in text (``[a,b]``) exploded in step; rows with empty lists stay as they are."""
    others = [c for c in df.columns if c not in cols]
    lists = [F.split(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"[\[\]\s]", ""), ",").alias(c) for c in cols]
    empty = F.coalesce(F.regexp_replace(F.col(cols[0]), r"[\[\]\s]", ""), F.lit("")) == ""
    full = df.withColumn("__empty", empty)
    zipped = F.when(~F.col("__empty"), F.arrays_zip(*lists))
    rows = full.withColumn("__z", (F.explode_outer if keep_empty else F.explode)(zipped))
    return rows.select(*others, *[F.when(F.col("__empty"), F.col(c)).otherwise(F.col("__z")[c]).alias(c) for c in cols])


def flatten_attributes(df: DataFrame, col: str, keys: list[str], identities: str | None = None, identity_schema: str | None = None) -> DataFrame:
    """``[{"Name": k, "Value": v}, ...]`` text to columns; the first record of a nested JSON list is promoted.

    The text is parsed once into a map.
    """
    pairs = F.from_json(F.col(col), "array<struct<Name:string,Value:string>>")
    attrs = F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["Name"], p["Value"])))
    out = df.withColumn("__m", attrs)
    fields = [F.try_element_at("__m", F.lit(k)).alias(k) for k in keys]
    out = out.select(*df.columns, *fields, "__m")
    if identities:
        first = F.try_element_at(F.from_json(F.try_element_at("__m", F.lit(identities)), f"array<struct<{identity_schema}>>"), F.lit(1))
        out = out.withColumn("__i", first).select(*[c for c in out.columns if c != "__m"], "__i.*")
        return out
    return out.drop("__m")


def explode_map(df: DataFrame, col: str, key_name: str, value_name: str) -> DataFrame:
    """One row per map entry; a row with an empty map stays once."""
    return df.select(*[c for c in df.columns if c != col], F.explode_outer(col).alias(key_name, value_name))


def flatten_struct(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    fields = df.schema[col].dataType.fieldNames()
    return df.select(*[c for c in df.columns if c != col], *[F.col(f"{col}.`{f}`").alias(prefix + f) for f in fields])


def pairs_to_structs(col: str | Column, first: str, second: str, types: tuple[str, str]) -> Column:
    """List of two-element lists to a list of named, typed records."""
    return F.transform(_c(col), lambda p: F.struct(F.get(p, F.lit(0)).cast(types[0]).alias(first), F.get(p, F.lit(1)).cast(types[1]).alias(second)))


def explode_metric_map(df: DataFrame, col: str) -> DataFrame:
    """JSON object of counters to (metric_key, metric_value) rows; dots in keys become underscores."""
    rows = df.select(*[c for c in df.columns if c != col], F.explode(F.from_json(F.col(col), "map<string,bigint>")).alias("metric_key", "metric_value"))
    return rows.withColumn("metric_key", F.replace("metric_key", F.lit("."), F.lit("_")))


def explode_list(df: DataFrame, list_col: str, parent_cols: list[str], fields: list[str]) -> DataFrame:
    """One row per nested element with the parent's columns repeated."""
    return df.select(*parent_cols, F.explode(list_col).alias("__e")).select(*parent_cols, *[F.col(f"__e.`{f}`").alias(f) for f in fields])


def extract_fields(df: DataFrame, html: str, specs: dict[str, str], keep: list[str], numeric: list[str] = ()) -> DataFrame:
    """Named fields of page markup by pattern (first group), tags and entities removed.

    ``numeric`` fields lose currency and percent signs and thousands separators.
    """
    cols = {}
    for name, pattern in specs.items():
        raw = F.nullif(F.regexp_extract(F.col(html), pattern, 1), F.lit(""))
        if name in numeric:
            cols[name] = F.regexp_replace(raw, r"[$€£%,\s]", "").try_cast("double")
        else:
            cols[name] = plain_text(raw)
    return df.select(*keep, *[c.alias(n) for n, c in cols.items()])


# The entities that are decoded.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def plain_text(col: str | Column) -> Column:
    out = F.regexp_replace(_c(col), "<[^>]*>", "")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(out)


def price_series(df: DataFrame, html: str, pattern: str, keep: list[str]) -> DataFrame:
    """Every match of a pattern as (position, text) rows, such as the points of a chart."""
    return df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))).alias("position", "item"))


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Constant dimension kept in code. It goes over as one Arrow batch, so the plan holds a local relation of known size."""
    import pandas as pd

    names = T.StructType.fromDDL(schema).fieldNames()
    return spark.createDataFrame(pd.DataFrame(rows, columns=names), schema)
