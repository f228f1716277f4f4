"""Grouped aggregation, pivots, exact percentiles and value lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import _c
from ..functions.text import slugify_name
from ..session import written
from .windows import _cols, _with_hot, hot_keys


def money(col: str | Column, scale: int = 2) -> Column:
    """Exact decimal view of an amount, so that sums do not depend on the order of the rows.

    28 digits hold any amount a double can tell apart at this scale, and leave room for sums and for products with a
    rate within the 38 digits of a decimal.
    """
    return _c(col).cast(f"decimal(28,{scale})")


def conditional_sums(df: DataFrame, keys, col: str, values: list[str], measure: str | Column | None = None,
                     prefix: str = "", suffix: str = "") -> DataFrame:
    """One sum (or count) per value of ``col`` as columns, missing kinds as 0."""
    m = F.lit(1) if measure is None else _c(measure)
    return df.groupBy(*_cols(keys)).agg(*[
        F.coalesce(F.sum(F.when(F.col(col) == v, m)), F.lit(0)).alias(f"{prefix}{v}{suffix}") for v in values
    ])


def collect_distinct(df: DataFrame, keys, cols: list[str]) -> DataFrame:
    """Sorted arrays of the distinct non-null values per key; duplicates are gone before the key shuffle."""
    keys = _cols(keys)
    slim = df.select(*keys, *cols).distinct() if len(cols) == 1 else df
    return slim.groupBy(*keys).agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in cols])


def collect_structs(df: DataFrame, keys, cols: list[str], name: str = "items") -> DataFrame:
    """Sorted array of the distinct attribute records per key."""
    keys = _cols(keys)
    return df.select(*keys, *cols).distinct().groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name))


def string_agg_ordered(df: DataFrame, keys, value: str, order: str, sep: str, name: str) -> DataFrame:
    """Text of a group joined in the given order."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return df.groupBy(*_cols(keys)).agg(F.array_join(F.transform(pairs, lambda p: p["v"]), sep).alias(name))


GRID = 256  # approximate quantiles that a bracketing pass looks at
RANK_ROWS = 100_000  # rows of an interval that are sorted in one task


def percentiles(df: DataFrame, col: str, qs: dict[str, float], by=()) -> DataFrame:
    """Exact continuous percentiles ``name -> q`` per group; the two neighbours of each target rank are interpolated.

    Groups of up to ``HOT_ROWS`` rows are aggregated exactly by Spark. For a hot group every target rank is bracketed:
    a pass counts the rows below, at and between two values, and takes approximate quantiles of those between; the two
    around the rank are the next bracket. Counts are exact and partial, so only the bracket is approximate, and after a
    few passes it holds so few rows that they are sorted. All percentiles share the passes; only the brackets are written.
    """
    by = _cols(by)
    values = df.filter(F.col(col).isNotNull()).select(*by, F.col(col).cast("double").alias("__v"))
    keyed = values if by else values.withColumn("__all", F.lit(0))
    keys = by or ["__all"]
    hot = hot_keys(keyed, keys)
    names = list(qs)
    exact = F.percentile("__v", F.array(*[F.lit(float(q)) for q in qs.values()])).alias("__p")
    small = [F.get("__p", F.lit(i)).alias(n) for i, n in enumerate(names)]
    if not hot.take(1):
        return values.groupBy(*by).agg(exact).select(*by, *small)
    large = _with_hot(keyed, hot, keys, "inner").drop("__hot")
    ranked = _bracketed(large, keys, qs).select(*by, *names)
    if not by:
        return ranked
    rest = _with_hot(keyed, hot, keys, "left").filter("__hot IS NULL")
    return rest.groupBy(*by).agg(exact).select(*by, *small).unionByName(ranked)


def _bracketed(values: DataFrame, keys: list[str], qs: dict[str, float]) -> DataFrame:
    """Percentiles of groups that are too large to sort: see ``percentiles``.

    The state is one row per group with a bracket per target rank: open bounds ``lo`` and ``hi`` (NULL: none), the
    number of rows up to ``lo`` and of those ``left`` between, and the value ``x`` once it is known to be a bound.
    """
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    other = lambda df: df.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in df.columns if c not in keys])
    quantiles = lambda c: F.percentile_approx(c, [i / GRID for i in range(GRID + 1)], 8 * GRID)
    v, n = F.col("__v"), len(qs)
    ranks = range(2 * n)  # the lower and upper neighbour of each percentile

    def around(g: Column, share: Column) -> tuple[Column, Column]:
        at = F.floor(share * GRID).cast("int")
        return F.get(g, F.greatest(at - 1, F.lit(0))), F.get(g, F.least(at + 2, F.lit(GRID)))

    state = values.groupBy(*keys).agg(F.count("*").alias("n"), quantiles(v).alias("g"))
    for i, q in enumerate(qs.values()):
        place = F.lit(float(q)) * (F.col("n") - 1)
        state = state.withColumns({f"r{2 * i}": F.floor(place) + 1, f"r{2 * i + 1}": F.ceil(place) + 1, f"f{i}": place - F.floor(place)})
    for i in ranks:
        low, high = around(F.col("g"), F.col(f"r{i}") / F.col("n"))
        state = state.withColumns({f"lo{i}": low, f"hi{i}": high, f"x{i}": F.lit(None).cast("double"), f"upto{i}": F.lit(0).cast("bigint"), f"left{i}": F.lit(2**62)})
    state = written(state.drop("g", "n"), "brackets")

    for _ in range(60):  # a pass leaves a few hundredths of an interval; 60 passes are beyond any table
        wide = [F.max(F.when(F.col(f"x{i}").isNull() & (F.col(f"left{i}") > RANK_ROWS), 1)).alias(f"x{i}") for i in ranks]
        told = state.agg(*wide).first()
        unsettled = [i for i in ranks if told[f"x{i}"]]
        if not unsettled:
            break
        counts = []
        for i in unsettled:
            lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
            inside = (lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi))
            for name, condition in (("b", lo.isNotNull() & (v < lo)), ("l", v == lo), ("m", inside), ("h", (v == hi) & (lo.isNull() | (lo < hi)))):
                counts.append(F.count(F.when(condition, 1)).alias(f"{name}{i}"))
            counts.append(quantiles(F.when(inside, v)).alias(f"g{i}"))
        seen = values.join(other(state), same).groupBy(*keys).agg(*counts)
        both = state.join(other(seen), same)
        changed = {}
        for i in unsettled:
            rank, below, low, inside, high, lo, hi, x = (F.col(f"{c}{i}") for c in ("r", "b", "l", "m", "h", "lo", "hi", "x"))
            value = F.coalesce(x, F.when((rank > below) & (rank <= below + low), lo), F.when((rank > below + low + inside) & (rank <= below + low + inside + high), hi))
            keep = value.isNotNull() | ((inside <= RANK_ROWS) & (rank > below + low) & (rank <= below + low + inside))
            under, over = rank <= below, rank > below + low + inside + high  # the quantiles were off: open that side again
            next_lo, next_hi = around(F.col(f"g{i}"), (rank - below - low) / inside)
            changed |= {
                f"x{i}": value, f"upto{i}": below + low, f"left{i}": F.when(under | over, F.lit(2**62)).otherwise(inside),
                f"lo{i}": F.when(keep | over, lo).when(~under, next_lo), f"hi{i}": F.when(keep | under, hi).when(~over, next_hi),
            }
        state = written(both.select(*keys, *[changed.get(c, F.col(c)).alias(c) for c in state.columns if c not in keys]), "brackets")
    else:
        raise RuntimeError("a percentile could not be bracketed")

    aggs = [F.max(f"f{i}").alias(f"f{i}") for i in range(n)]
    for i in ranks:
        lo, hi, x = F.col(f"lo{i}"), F.col(f"hi{i}"), F.col(f"x{i}")
        inside = x.isNull() & (lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi))
        aggs += [F.array_sort(F.collect_list(F.when(inside, v))).alias(f"s{i}"), F.max(x).alias(f"x{i}"), F.max(F.col(f"r{i}") - F.col(f"upto{i}")).alias(f"k{i}")]
    settled = values.join(other(state), same).groupBy(*keys).agg(*aggs)
    at = lambda i: F.coalesce(F.col(f"x{i}"), F.get(f"s{i}", (F.col(f"k{i}") - 1).cast("int")))
    return settled.select(*keys, *[(at(2 * i) + (at(2 * i + 1) - at(2 * i)) * F.col(f"f{i}")).alias(name) for i, name in enumerate(qs)])


def percentile_cont(df: DataFrame, col: str, q: float, by=(), name: str = "percentile") -> DataFrame:
    """One exact continuous percentile per group."""
    return percentiles(df, col, {name: q}, by)


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Values by frequency, most common first, ties by value."""
    counts = df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(col))
    return counts.limit(n) if n else counts


def nth_most_common(df: DataFrame, col: str, n: int) -> DataFrame:
    """The value at frequency rank n, if there are that many; tasks forward only their n best rows."""
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(col)).offset(n - 1).limit(1)


def column_values(df: DataFrame, col: str, limit: int | None = None, where: str | None = None, default=None) -> list:
    """Distinct values on the driver, most frequent first, for building pivot columns.

    The list becomes columns of a plan, so its size is the caller's choice; a ``limit`` that is given and exceeded raises.
    """
    src = df.filter(where) if where else df
    rows = value_counts(src, col, limit + 1 if limit else None).collect()
    if limit and len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} distinct values")
    return [r[0] for r in rows] or ([] if default is None else default)


# Comparison operators a pivot accepts.
COMPARISONS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
}


def pivot(df: DataFrame, keys, column: str, values: list, agg: str = "sum", cmp: str = "=", then_value: str | Column | int = 1,
          else_value: Column | int | None = 0, prefix: str = "", suffix: str = "", distinct: bool = False,
          slug: bool = False) -> DataFrame:
    """Rows to columns: one aggregate of ``CASE WHEN column <cmp> value THEN .. ELSE .. END`` per value."""
    then = _c(then_value) if isinstance(then_value, (str, Column)) else F.lit(then_value)
    other = else_value if isinstance(else_value, Column) else F.lit(else_value)
    fn = {"sum": F.sum_distinct if distinct else F.sum, "count": F.count_distinct if distinct else F.count,
          "max": F.max, "min": F.min, "avg": F.avg}[agg]
    out = []
    for v in values:
        name = slugify_name(str(v)) if slug else str(v)
        out.append(fn(F.when(COMPARISONS[cmp](F.col(column), F.lit(v)), then).otherwise(other)).alias(f"{prefix}{name}{suffix}"))
    return df.groupBy(*_cols(keys)).agg(*out)


def pivot_native(df: DataFrame, keys, column: str, values: list, agg: Column) -> DataFrame:
    """Spark's pivot over a listed set of values; missing combinations stay NULL."""
    return df.groupBy(*_cols(keys)).pivot(column, values).agg(agg)


def unpivot(df: DataFrame, cast_to: str = "string", exclude: list[str] = (), remove: list[str] = (),
            field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """Columns to rows; ``exclude`` columns are repeated on each row, ``remove`` columns vanish, NULLs stay."""
    skip = {c.lower() for c in [*exclude, *remove]}
    turn = [c for c in df.columns if c.lower() not in skip]
    keep = [c for c in df.columns if c.lower() in {e.lower() for e in exclude}]
    cast = df.select(*keep, *[F.col(c).cast(cast_to).alias(c) for c in turn])
    return cast.unpivot(keep, turn, field_name, value_name)


def metrics_wide(df: DataFrame, keys, name_col: str, value_col: str, names: list[str], order: str) -> DataFrame:
    """Metric records to one column per metric; the earliest non-null value wins, ``{}`` reads as ''."""
    value = F.when(F.col(value_col) == "{}", "").otherwise(F.col(value_col))
    rows = df.withColumn("__v", value)
    return rows.groupBy(*_cols(keys)).agg(*[
        F.min_by(F.col("__v"), F.when((F.col(name_col) == n) & F.col("__v").isNotNull(), F.col(order))).alias(n) for n in names
    ])


def single_value(df: DataFrame, default=None):
    """First cell of a result, or the default when it is empty."""
    row = df.limit(1).first()
    return default if row is None else row[0]


def as_dict(df: DataFrame, limit: int | None = None) -> dict[str, list]:
    """Column name to value list of a result that the driver is to hold; a ``limit`` that is given and exceeded raises."""
    rows = (df.limit(limit + 1) if limit else df).collect()
    if limit and len(rows) > limit:
        raise ValueError(f"result has more than {limit} rows")
    return {c: [r[c] for r in rows] for c in df.columns}
