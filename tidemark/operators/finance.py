"""Cost, revenue, cohorts, allocation, billing and campaign reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio_or_zero, safe_divide
from .joins import full_join_zero_fill, range_join
from .windows import _cols


AMOUNT = "decimal(28,4)"  # 24 digits before the point, and room for sums within the 38 of a decimal


def purchases(events: DataFrame, kind: str, purchase: str, keep: list[str], product: Column, micros: Column, app: Column) -> DataFrame:
    """Purchase events with product name, amount in units and an app label."""
    return events.filter(F.col(kind) == purchase).select(*keep, product.alias("product"), (micros / F.lit(1e6)).alias("amount"), app.alias("app"))


def conform_facts(frames: dict[str, DataFrame], dims: list[str], measures: list[str], source: str = "feed") -> DataFrame:
    """Facts of several feeds summed on shared dimensions; a feed without a dimension or measure leaves it empty."""
    parts = []
    for name, df in frames.items():
        have = set(df.columns)
        parts.append(df.select(
            F.lit(name).alias(source),
            *[(F.col(d).cast("string") if d in have else F.lit(None).cast("string")).alias(d) for d in dims],
            *[(F.col(m) if m in have else F.lit(None)).cast(AMOUNT).alias(m) for m in measures],
        ))
    long = reduce(DataFrame.unionByName, parts)
    return long.groupBy(source, *dims).agg(*[F.sum(m).alias(m) for m in measures])


def with_ecpm(df: DataFrame, revenue: str, impressions: str) -> DataFrame:
    return df.withColumn("ecpm", ratio_or_zero(F.col(revenue) * 1000, impressions))


def cost_revenue(costs: DataFrame, revenues: DataFrame, dims: list[str]) -> DataFrame:
    """Cost and revenue on shared dimensions, zero filled, with profit."""
    c = costs.groupBy(*dims).agg(F.sum("cost").alias("cost"))
    r = revenues.groupBy(*dims).agg(F.sum("revenue").alias("revenue"))
    return full_join_zero_fill(c, r, dims, ["cost", "revenue"]).withColumn("profit", F.col("revenue") - F.col("cost"))


def roas(revenue: DataFrame, cost: DataFrame, installs: DataFrame, keys: list[str], channel: str, channels: list[str]) -> DataFrame:
    """Revenue by channel as columns next to cost and installs, with return on spend.

    The three inputs are stacked and aggregated once, instead of two full outer joins.
    """
    zero = F.lit(0).cast(AMOUNT)

    def part(df, **cols):
        names = [*[f"rev_{c}" for c in channels], "cost", "installs"]
        return df.select(*keys, *[cols.get(n, zero).cast(AMOUNT).alias(n) for n in names])

    rev = part(revenue, **{f"rev_{c}": F.when(F.col(channel) == c, F.col("revenue")).otherwise(0) for c in channels})
    both = rev.unionByName(part(cost, cost=F.col("cost"))).unionByName(part(installs, installs=F.col("installs")))
    out = both.groupBy(*keys).agg(*[F.sum(n).cast("double").alias(n) for n in [*[f"rev_{c}" for c in channels], "cost", "installs"]])
    total = reduce(lambda a, b: a + b, [F.col(f"rev_{c}") for c in channels])
    return out.withColumn("total_revenue", total).withColumn("roas", safe_divide("total_revenue", "cost"))


def cohort_ltv(by_age: DataFrame, cost: DataFrame, installs: DataFrame, releases: DataFrame, cohort: str, dim: str, age: str) -> DataFrame:
    """Revenue and retention per cohort day, dimension and age, with the cohort's cost, installs, ROAS and release.

    ``by_age`` holds ``revenue`` and ``retained`` per cohort, dimension and age. Costs and installs are stacked and
    summed to one row per cohort, so one full join is left. A cohort with cost or installs alone has age 0.
    """
    keys = [cohort, dim]
    none = F.lit(None)
    stacked = cost.select(*keys, F.col("cost").cast("double").alias("cost"), none.cast("bigint").alias("installs")).union(
        installs.select(*keys, none.cast("double"), F.col("installs").cast("bigint")))
    spent = stacked.groupBy(*keys).agg(F.sum("cost").alias("cost"), F.sum("installs").alias("installs"))
    out = by_age.join(spent, keys, "full_outer")
    out = out.withColumns({age: F.coalesce(age, F.lit(0)), "revenue": F.coalesce("revenue", F.lit(0.0)), "cost": F.coalesce("cost", F.lit(0.0)),
                           "installs": F.coalesce("installs", F.lit(0))})
    out = out.withColumn("roas", safe_divide("revenue", "cost"))
    last = releases.withColumn("__to", F.date_sub("to_date", 1)).drop("to_date")
    cohorts = by_age.select(cohort).union(cost.select(cohort)).union(installs.select(cohort))
    return range_join(out, last, cohort, "from_date", "__to", "left", dates=cohorts).drop("from_date", "__to")


def _rounded(c: Column, digits: int) -> Column:
    return F.round(c, digits).cast(f"decimal(28,{digits})")


def _units(c: Column) -> Column:
    """A count (below 10^15) as a decimal, which leaves a quotient of amounts room for thirteen decimals before it is rounded."""
    return c.cast("decimal(15,0)")


def _share(cost: Column, weight: Column, total: Column, digits: int) -> Column:
    """``cost * weight / total``, halves away from zero, from the remainder of a whole division: nothing is rounded twice.

    The cost has four decimals and may reach 10^17, the counts 10^15.
    """
    whole = lambda c: c.cast("decimal(38,0)")
    amount = (F.abs(cost) * 10_000).cast("decimal(22,0)") * _units(weight)
    unit = whole(_units(total) * 10 ** (4 - digits))
    twice = whole(amount * 2 + unit)
    parts = whole((twice - F.pmod(twice, unit * 2)) / whole(unit * 2))
    value = (parts / F.lit(10**digits).cast("decimal(5,0)")).cast(f"decimal(28,{digits})")
    return F.when(cost < 0, -value).otherwise(value).cast(f"decimal(28,{digits})")


def allocate(weights: DataFrame, costs: dict[str, DataFrame], period: str, weight: str, digits: int = 3) -> DataFrame:
    """Costs of a period shared among its segments by weight, rounded; costs per unit of weight as well.

    All in decimals, so that halves round up whatever the binary fraction. The window runs over the aggregated
    segments of one period.
    """
    total = _units(F.sum(weight).over(Window.partitionBy(period)))
    out = weights
    for name, c in costs.items():
        out = out.join(c.select(period, F.col("cost").cast(AMOUNT).alias(f"__{name}")), period, "left")
    out = out.withColumn("__total", total)
    share = {f"cost_{n}": _share(F.coalesce(F.col(f"__{n}"), F.lit(0).cast(AMOUNT)), F.col(weight), F.col("__total"), digits) for n in costs}
    out = out.withColumns(share).drop("__total", *[f"__{n}" for n in costs])
    whole = reduce(lambda a, b: a + b, [F.col(c) for c in share])
    return out.withColumns({"total_cost": whole.cast(f"decimal(28,{digits})"), "cost_per_unit": _rounded(whole / _units(F.col(weight)), digits)})


def new_user_profit(allocated: DataFrame, revenue: DataFrame, keys: list[str], period: str, weight: str, digits: int = 3) -> DataFrame:
    """Revenue per new user of each segment and of the whole period next to the allocated cost."""
    amount = _rounded(F.coalesce(F.col("revenue").cast(AMOUNT), F.lit(0)), digits)
    joined = allocated.join(revenue, keys, "left").withColumn("revenue", amount)
    w = Window.partitionBy(period)
    return joined.withColumns({
        "rev_per_user_segment": _rounded(F.col("revenue") / _units(F.col(weight)), digits),
        "rev_per_user": _rounded(F.sum("revenue").over(w).cast(f"decimal(28,{digits})") / _units(F.sum(weight).over(w)), digits),
    })


def campaign_report(facts: DataFrame, dims: list[str], kind: str, kinds: list[str], user: str, rates: dict[str, tuple[str, str]],
                    measures: dict[str, Column] | None = None, count: str | Column = 1) -> DataFrame:
    """Funnel counts, distinct users, extra measures and percentage rates per campaign, channel, country or event.

    Users are counted distinct from an aggregation that first removes duplicates within the group.
    """
    n = F.lit(count) if isinstance(count, int) else F.col(count) if isinstance(count, str) else count
    measures = measures or {}
    per_user = facts.groupBy(*dims, user).agg(
        *[F.coalesce(F.sum(F.when(F.col(kind) == k, n)), F.lit(0)).alias(k) for k in kinds], *[c.alias(m) for m, c in measures.items()])
    out = per_user.groupBy(*dims).agg(*[F.sum(k).alias(k) for k in kinds], F.count(user).alias("dau"), *[F.sum(m).alias(m) for m in measures])
    return out.withColumns({name: ratio_or_zero(a, b) * 100 for name, (a, b) in rates.items()})


def billing_rollup(frames: dict[str, DataFrame], snapshot: str, period: str, line_type: str, usage: str, dims: list[str], cost: str) -> DataFrame:
    """Usage cost per account from the last snapshot of every month, all accounts stacked."""
    from ..sources.scans import latest_snapshot_per_period

    parts = [
        latest_snapshot_per_period(df, snapshot, "month").filter(F.col(line_type) == usage)
        .groupBy(F.lit(name).alias("account"), F.trunc(period, "month").alias("month"), *dims).agg(F.sum(cost).alias("cost"))
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def ads_fact(stats: DataFrame, status: DataFrame, key: str, dims: list[str], spend_micros: str, clicks: str, videos: DataFrame, video: str) -> DataFrame:
    """Ad statistics at the current status of the ad: best counters, spend in units, video rows enriched.

    Ads without a video keep one row with an empty video, as one left join gives both kinds.
    """
    per = stats.groupBy(key, *dims).agg(F.max(clicks).alias("clicks"), F.round(F.max(spend_micros) / 1e6, 2).alias("spend"), F.sum("impressions").alias("impressions"))
    return per.join(status, key, "left").join(videos.select(key, video).distinct(), key, "left")


def engagement(posts: DataFrame, post: str, parts: dict[str, DataFrame]) -> DataFrame:
    """Reactions, clicks, comments, shares per post (0 when none) and their sum.

    All parts are stacked and aggregated once per post.
    """
    long = reduce(DataFrame.unionByName, [
        df.select(F.col(post), *[(F.col("n") if n == name else F.lit(0)).cast("bigint").alias(n) for n in parts]) for name, df in parts.items()
    ])
    sums = long.groupBy(post).agg(*[F.sum(n).alias(n) for n in parts])
    out = posts.join(sums, post, "left").fillna(0, list(parts))
    return out.withColumn("engagement", reduce(lambda a, b: a + b, [F.col(n) for n in parts]))


def conform_profiles(frames: dict[str, DataFrame], source: str = "channel") -> DataFrame:
    """Follower statistics of several channels in one wide table, missing columns empty."""
    parts = [df.select(F.lit(name).alias(source), "*") for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def side_by_side(a: DataFrame, b: DataFrame, keys: list[str], names: tuple[str, str], measures: list[str]) -> DataFrame:
    """The same measures from two sources with their difference."""
    left = a.select(*keys, *[F.col(m).alias(f"{m}_{names[0]}") for m in measures])
    right = b.select(*keys, *[F.col(m).alias(f"{m}_{names[1]}") for m in measures])
    cols = [f"{m}_{n}" for m in measures for n in names]
    out = full_join_zero_fill(left, right, _cols(keys), cols)
    return out.withColumns({f"{m}_diff": F.col(f"{m}_{names[0]}") - F.col(f"{m}_{names[1]}") for m in measures})
