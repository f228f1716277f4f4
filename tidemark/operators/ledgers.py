"""Balances, transfers and reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.wide import LIMBS, wide_sign, wide_size, wide_sum, wide_text
from ..session import written
from . import windows
from .calendars import densify
from .joins import null_safe_join
from .sets import ledger
from .windows import latest_per_key, rank_in_group, running_sum


def balances(transfers: DataFrame, sender: str, receiver: str, value: str, by: list[str] = ()) -> DataFrame:
    """Net holding per party (and token): one scan, one partial aggregation."""
    legs = ledger(transfers, sender, receiver, value, keep=list(by))
    return legs.groupBy("party", *by).agg(F.sum("amount").alias("balance"))


def big_balances(transfers: DataFrame, sender: str, receiver: str, value: str, by: list[str] = (), limbs: int = LIMBS) -> DataFrame:
    """Net holding per party (and token) of whole amounts of any length, given and returned as text; amounts that are no number count as none."""
    read = transfers.select(*by, sender, receiver, wide_size(value, limbs).alias("__limbs"), wide_sign(value).alias("__sign"))
    legs = F.array(F.struct(F.col(sender).alias("party"), (-F.col("__sign")).alias("__way")), F.struct(F.col(receiver).alias("party"), F.col("__sign").alias("__way")))
    sums = read.select(*by, "__limbs", F.inline(legs)).groupBy("party", *by).agg(wide_sum("__limbs", limbs, F.col("__way")).alias("balance"))
    return sums.withColumn("balance", wide_text("balance"))


def balances_wide(transfers: DataFrame, sender: str, receiver: str, value: str, token: str, tokens: list[str]) -> DataFrame:
    """Net holding per party with one column per listed token."""
    legs = ledger(transfers, sender, receiver, value, keep=[token])
    return legs.groupBy(F.lower("party").alias("party")).agg(
        *[F.sum(F.when(F.col(token) == name, F.col("amount")).otherwise(0)).alias(name) for name in tokens])


def balances_asof(transfers: DataFrame, sender: str, receiver: str, value: str, token: str, tokens: list[str], ts: str, until: Column) -> DataFrame:
    """Running token balances per party up to a time, reduced to the last state.

    The last running sum is the total, so the state needs an aggregation only; ``balance_history`` gives every
    step.
    """
    legs = ledger(transfers.filter(F.col(ts) < until), sender, receiver, value, keep=[token, ts])
    return legs.groupBy("party").agg(
        F.max(ts).alias("last_ts"), *[F.sum(F.when(F.col(token) == name, F.col("amount")).otherwise(0)).alias(name) for name in tokens])


def balance_history(transfers: DataFrame, sender: str, receiver: str, value: str, by: list[str], ts: str, bucket: Column | None = None) -> DataFrame:
    """Balance after each time at which a party moved anything."""
    legs = ledger(transfers, sender, receiver, value, keep=[*by, ts])
    steps = written(legs.groupBy("party", *by, ts).agg(F.sum("amount").alias("change")), "steps")  # read by every branch of the window
    return running_sum(steps, ["party", *by], ts, {"balance": "change"}, bucket=bucket)


def daily_balances(transfers: DataFrame, sender: str, receiver: str, value: str, by: list[str], day: str, step: str = "INTERVAL 1 DAY",
                   bucket: Column | None = None) -> DataFrame:
    """Balance of every party for every period of the span, periods without movement carried on."""
    legs = ledger(transfers, sender, receiver, value, keep=[*by, day])
    moves = legs.groupBy("party", *by, day).agg(F.sum("amount").alias("change"))
    dense = densify(moves, ["party", *by], day, step=step).withColumn("change", F.coalesce("change", F.lit(0)))
    return running_sum(dense, ["party", *by], day, {"balance": "change"}, bucket=bucket)


def watched_daily_balances(transfers: DataFrame, sender: str, receiver: str, value: str, wallets: DataFrame, by: list[str], day: str, start: str, until: str) -> DataFrame:
    """Balance of every watched wallet (and token) on every day from ``start`` to ``until``.

    ``wallets`` has a column ``party``. What moved before the start is the opening balance. Entries are cut to the
    watched wallets and summed per day before the days are filled in; a hot wallet's running sum is split by day.
    """
    legs = ledger(transfers.filter(F.col(day) <= F.lit(until).cast("date")), sender, receiver, value, keep=[*by, day])
    mine = legs.join(wallets.select("party").distinct(), "party", "left_semi")
    keys = ["party", *by]
    moves = mine.groupBy(*keys, F.greatest(F.col(day), F.lit(start).cast("date")).alias(day)).agg(F.sum("amount").alias("change"))
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(until).cast("date")))
    dense = moves.select(*keys).distinct().withColumn(day, days).join(moves, [*keys, day], "left").withColumn("change", F.coalesce("change", F.lit(0)))
    return running_sum(dense, keys, day, {"balance": "change"}, bucket=F.trunc(day, "month"))


def value_balances(held: DataFrame, daily: DataFrame, intraday: DataFrame, symbol: str, day: str, price: str, as_of_ts: str, amount: str = "balance") -> DataFrame:
    """Balances times the close of their day, or the newest intraday price where the day has no close."""
    newest = latest_per_key(intraday.select(symbol, as_of_ts, F.col(price).alias("__spot")), symbol, [as_of_ts]).drop(as_of_ts)
    priced = held.join(daily.select(symbol, day, F.col(price).alias("__close")), [symbol, day], "left").join(newest, symbol, "left")
    used = F.coalesce("__close", "__spot")
    return priced.withColumns({"price": used, "value_usd": F.col(amount) * used}).drop("__close", "__spot")


def holder_transactions(transfers: DataFrame, sender: str, receiver: str, value: str, tokens: DataFrame, token: str, nft: DataFrame) -> DataFrame:
    """Every entry of the parties that hold a positive balance, with token data and the kind of token.

    A transfer has two entries; each is kept for the holder it belongs to, so no row has to be tested twice.
    """
    legs = ledger(transfers, sender, receiver, value, keep=[c for c in transfers.columns if c not in (sender, receiver, value)])
    held = legs.groupBy("party").agg(F.sum("amount").alias("holding")).filter("holding > 0")
    kinds = nft.select(token).distinct().withColumn("token_kind", F.lit("NFT"))
    return legs.join(held, "party").join(tokens, token, "left").join(kinds, token, "left").withColumn("token_kind", F.coalesce("token_kind", F.lit("TOKEN")))


def holder_totals(entries: DataFrame) -> DataFrame:
    """Per holder: number of entries and of tokens touched, sums by direction and kind."""
    return entries.groupBy("party").agg(
        F.count("*").alias("transactions"),
        F.count_if(F.col("token_kind") == "NFT").alias("nft_transactions"),
        F.sum(F.when(F.col("direction") == "in", F.col("amount"))).alias("received"),
        F.sum(F.when(F.col("direction") == "out", -F.col("amount"))).alias("sent"),
    )


def watched_transfers(transfers: DataFrame, sender: str, receiver: str, value: str, wallets: DataFrame, wallet: str, label: str, tokens: DataFrame,
                      token: str, ts: str, since: Column) -> DataFrame:
    """In and out entries of watched wallets, labelled and scaled, since a time. Dimension joins replace CASE chains."""
    legs = ledger(transfers.filter(F.col(ts) >= since), sender, receiver, value, keep=[c for c in transfers.columns if c not in (sender, receiver, value)])
    names = wallets.select(F.lower(wallet).alias("__w"), F.col(label).alias("wallet_label"))
    return legs.join(names, F.lower("party") == F.col("__w")).drop("__w").join(tokens, token, "left")


def classify_transfers(transfers: DataFrame, sender: str, receiver: str, rules: DataFrame, keys: list[str], order: str,
                       bucket: Column | None = None) -> DataFrame:
    """Tag each transfer by a rule table (side, address, tag) and rank it within its transaction.

    A transfer that satisfies several rules gives one row per tag. Rules are joined on the address of either
    side. Transactions are first counted by their key alone: if none can have more rows than one task may sort, the
    ranks need no search for hot transactions among the tagged rows, which would tag all of them two more times.
    """
    at_once = rules.groupBy("side", "address").agg(F.count("*").alias("n")).groupBy("side").agg(F.max("n").alias("n"))
    tags = at_once.agg(F.sum("n")).first()[0] or 0  # of one transfer, at most
    most = transfers.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    small = tags * most <= windows.HOT_ROWS
    sides = F.array(F.struct(F.lit("from").alias("side"), F.col(sender).alias("address")), F.struct(F.lit("to").alias("side"), F.col(receiver).alias("address")))
    ends = transfers.withColumn("__e", F.explode(sides)).select(*transfers.columns, "__e.side", "__e.address")
    tagged = ends.join(rules, ["side", "address"]).drop("side", "address")
    return rank_in_group(tagged, keys, order, "rank_in_tx", None if small else bucket)


def transactions_touching(df: DataFrame, ends: list[str], address: Column | list, tx: str) -> DataFrame:
    """All rows of the transactions in which a given address takes part."""
    values = address if isinstance(address, list) else [address]
    hit = reduce(lambda a, b: a | b, [F.col(c).isin(*values) for c in ends])
    return df.join(df.filter(hit).select(tx).distinct(), tx, "left_semi")


def asset_counts(logs: list[tuple[DataFrame, str, Column]], key: str, names: dict[str, list[tuple[str, int]]]) -> DataFrame:
    """Signed event counts per key: ``asset -> [(log name, weight), ...]``; a missing term counts as 0.

    The logs become one long table and are aggregated once.
    """
    long = reduce(DataFrame.unionByName, [df.select(key, F.lit(name).alias("log"), amount.cast("bigint").alias("n")) for df, name, amount in logs])
    totals = {a: reduce(lambda x, y: x + y, [F.when(F.col("log") == log, F.col("n") * weight).otherwise(0) for log, weight in terms]) for a, terms in names.items()}
    return long.groupBy(key).agg(*[F.sum(c).alias(a) for a, c in totals.items()])


def reconcile(a: DataFrame, b: DataFrame, key: str, a_cols: list[str], b_cols: list[str]) -> DataFrame:
    """Two sources side by side on the key, with flags for the side that lacks the record.

    Written as a left join plus the unmatched rest of b: adaptive execution can split a hot key there, which it
    cannot in a full outer join.
    """
    left = a.select(key, *a_cols)
    right = b.select(key, *b_cols)
    matched = left.join(right.withColumn("__in_b", F.lit(True)), key, "left").select(
        key, *a_cols, *b_cols, F.lit(None).cast("string").alias("missing_left"), F.when(F.col("__in_b").isNull(), "missing").alias("missing_right"))
    rest = right.join(left.select(key).distinct(), key, "left_anti").select(
        key, *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in a_cols], *b_cols,
        F.lit("missing").alias("missing_left"), F.lit(None).cast("string").alias("missing_right"))
    return matched.unionByName(rest)


def recovered_rows(orders: DataFrame, reconciled: DataFrame, status: str, charged: str, mapping: dict[str, Column], flag: str = "missing_right") -> DataFrame:
    """The own orders plus the charged report rows they lack, conformed to the order columns (NULL where unknown)."""
    lost = reconciled.filter((F.col(flag) == "missing") & (F.col(status) == charged))
    cols = [(mapping[c] if c in mapping else F.lit(None)).cast(orders.schema[c].dataType).alias(c) for c in orders.columns]
    return orders.withColumn("recovered", F.lit(False)).unionByName(lost.select(*cols).withColumn("recovered", F.lit(True)))


def refund_overrides(report: DataFrame, order: str, status: str, refund: str, keep: list[str], date: str) -> DataFrame:
    """One row per order and product: a refund line overrides the status, the first charge dates the order."""
    seen = report.withColumn("__r", (F.col(status) == refund).cast("int"))
    flags = seen.groupBy(order).agg(F.max("__r").alias("__refunded"))
    final = F.when(F.col("__refunded") == 1, refund).otherwise(F.col(status)).alias(status)
    return report.join(flags, order).select(order, final, *keep, date).groupBy(order, status, *keep).agg(F.min(date).alias(date))


def backfill_by_product(df: DataFrame, product: str, known: dict[str, Column]) -> DataFrame:
    """Fill missing attributes from rows of the same product; the smallest value serves when several exist."""
    lookup = df.groupBy(product).agg(*[F.min(c).alias(f"__{n}") for n, c in known.items()])
    return null_safe_join(df, lookup, product, "left").withColumns({n: F.coalesce(n, f"__{n}") for n in known}).drop(*[f"__{n}" for n in known])
