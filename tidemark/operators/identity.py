"""Users, their devices, linked accounts, versions and contacts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import surrogate_key
from .windows import partition_agg, split_window


def identity_union(users: list[DataFrame], directory: DataFrame, user: str, wallets_csv: str, attrs: list[str]) -> DataFrame:
    """Users of several systems with all their wallets, names and mails as distinct arrays.

    Each frame gives the user id and a comma list of wallets; the directory gives attributes per user.
    """
    rows = reduce(DataFrame.unionByName, [u.select(user, wallets_csv) for u in users])
    wallets = rows.select(user, F.explode_outer(F.split(wallets_csv, ",")).alias("w")).select(user, F.nullif(F.lower(F.trim("w")), F.lit("")).alias("wallet")).distinct()
    owned = wallets.groupBy(user).agg(F.array_sort(F.collect_set("wallet")).alias("wallets"))
    known = directory.select(user, *attrs).distinct().groupBy(user).agg(*[F.array_sort(F.collect_set(a)).alias(a) for a in attrs])
    return owned.join(known, user, "left")


def coalesce_sources(base: DataFrame, sources: list[DataFrame], key: str, attr: str, default: str | None = None) -> DataFrame:
    """Attribute from the first source that knows the key. One union and one aggregation replace N joins."""
    ranked = reduce(DataFrame.unionByName, [s.select(key, attr, F.lit(i).alias("__p")) for i, s in enumerate(sources)])
    best = ranked.filter(F.col(attr).isNotNull()).groupBy(key).agg(F.min_by(attr, F.struct("__p", attr)).alias(attr))
    return base.join(best, key, "left").withColumn(attr, F.coalesce(attr, F.lit(default)))


def device_map(events: DataFrame, user: str, device: str, ts: str, model: str) -> DataFrame:
    """One row per user and device model: its device ids, first and last seen, and a stable key.

    Users are attached to device ids first (an anonymous event belongs to the users of its device), on the
    distinct pairs only.
    """
    links = events.filter(F.col(user).isNotNull()).select(device, user).distinct()
    seen = events.groupBy(device, model).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count("*").alias("events"))
    out = seen.join(links, device).groupBy(user, model).agg(
        F.array_sort(F.collect_set(device)).alias("device_ids"), F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"), F.sum("events").alias("events"))
    return out.withColumn("device_key", surrogate_key(user, model))


def lifespan(events: DataFrame, account: str, linked: str, ts: str, far_end: Column) -> DataFrame:
    """First and last time of each linked id; the newest id of an account is active until ``far_end``."""
    spans = events.groupBy(account, linked).agg(F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"))
    newest = spans.groupBy(account).agg(F.max(F.struct("start_ts", linked)).alias("__n"))
    active = F.col("__n")[linked] == F.col(linked)
    return spans.join(newest, account).select(
        account, linked, "start_ts", F.when(active, far_end).otherwise(F.col("end_ts")).alias("end_ts"),
        F.when(active, 1).otherwise(0).alias("is_active"))


def attrs_at_latest(df: DataFrame, key: str, ts: str, attrs: list[str]) -> DataFrame:
    """Distinct attribute rows at each key's last time, ties kept."""
    latest = partition_agg(df.select(key, ts, *attrs), key, {"__max": F.max(ts)})
    return latest.filter(F.col(ts) == F.col("__max")).drop("__max").distinct()


def version_history(logins: DataFrame, user: str, version: str, ts: str, users: DataFrame, mail: str, internal_domain: str,
                    bucket: Column | None = None) -> DataFrame:
    """First login per user and version, the next version's start, day 0 and a flag for internal mails."""
    starts = logins.groupBy(user, version).agg(F.min(ts).alias("version_start"))
    chain = split_window(starts, user, ["version_start", version], bucket, {"next_version_start": ("lead", "version_start")})
    day0 = logins.groupBy(user).agg(F.to_date(F.min(ts)).alias("day0_date"))
    inside = F.coalesce(F.lower(F.split_part(F.col(mail), F.lit("@"), F.lit(2))) == internal_domain.lower(), F.lit(False))
    return chain.join(day0, user).join(users.select(user, mail), user, "left").withColumn("is_internal", inside).drop(mail)


def version_sort_key(version: Column) -> Column:
    """Numbers of a dotted version, so that 1.10 sorts after 1.9."""
    return F.transform(F.regexp_extract_all(version, F.lit("([0-9]+)"), F.lit(1)), lambda p: p.cast("bigint"))


def release_calendar(events: DataFrame, version: str, date: str, today: Column) -> DataFrame:
    """From/to dates per version by first sighting; half-open, the newest one ends today.

    The window runs over one row per version.
    """
    first = events.groupBy(version).agg(F.min(F.to_date(date)).alias("from_date"))
    w = Window.orderBy(version_sort_key(F.col(version)))
    return first.withColumn("to_date", F.coalesce(F.lead("from_date").over(w), today))


def close_releases(stored: DataFrame, fresh: DataFrame, version: str) -> DataFrame:
    """Stored calendar brought up to date: the open end of the last stored version moves, new versions follow.

    First sightings already stored win over later recomputed ones.
    """
    both = stored.withColumn("__old", F.lit(1)).unionByName(fresh.withColumn("__old", F.lit(0)))
    starts = both.groupBy(version).agg(F.min("from_date").alias("from_date"))
    ends = both.groupBy(version).agg(F.max("to_date").alias("to_date"))
    w = Window.orderBy(version_sort_key(F.col(version)))
    return starts.join(ends, version).withColumn("to_date", F.coalesce(F.lead("from_date").over(w), "to_date"))
