"""Ledger queries. Transfers run from customers to suppliers: one per order line, with the return flag as token."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledgers as L
from ..operators.aggregates import money
from ..session import written
from .registry import query

TRANSFERS = """tr AS (SELECT l_orderkey AS tx, l_linenumber AS log_index, 'C' || o_custkey AS from_address, 'S' || l_suppkey AS to_address, l_returnflag AS token, l_shipdate AS ts,
    cast(l_shipdate AS DATE) AS day, l_partkey AS part, cast(l_extendedprice AS DECIMAL(14,2)) * (1 - cast(l_discount AS DECIMAL(14,2))) AS value FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
  legs AS (SELECT tx, log_index, token, ts, day, part, from_address AS party, to_address AS other, -value AS amount, 'out' AS direction FROM tr
           UNION ALL SELECT tx, log_index, token, ts, day, part, to_address, from_address, value, 'in' FROM tr)"""


def transfers(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_returnflag", "l_shipdate", "l_extendedprice", "l_discount")
    return lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("log_index"), F.concat(F.lit("C"), "o_custkey").alias("from_address"),
        F.concat(F.lit("S"), "l_suppkey").alias("to_address"), F.col("l_returnflag").alias("token"), F.col("l_shipdate").alias("ts"),
        F.to_date("l_shipdate").alias("day"), F.col("l_partkey").alias("part"),
        (money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("value"))


def as_double(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


ENDS = ("from_address", "to_address", "value")


@query(f"""WITH {TRANSFERS} SELECT party, other AS counterparty, direction, count(*) AS n, cast(sum(amount) AS DOUBLE) AS amount FROM legs GROUP BY 1, 2, 3""")
def ledger_double_entry(t):
    from ..operators.sets import ledger

    legs = ledger(transfers(t), *ENDS)
    return legs.groupBy("party", "counterparty", "direction").agg(F.count("*").alias("n"), F.sum("amount").cast("double").alias("amount"))


@query(f"""WITH {TRANSFERS} SELECT party, cast(sum(amount) AS DOUBLE) AS balance FROM legs GROUP BY 1""")
def ledger_balance(t):
    return as_double(L.balances(transfers(t), *ENDS), "balance")


BIG = "cast(cast(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) || repeat(lpad(cast(l_partkey AS VARCHAR), 10, '0'), 5) || lpad(cast(l_orderkey AS VARCHAR), 10, '0')"
# Three limbs of 30 digits per leg; carries go up by floor, and a negative total is turned round first.
BIG_TWIN = f"""{TRANSFERS}, big AS (SELECT 'C' || o_custkey AS a, 'S' || l_suppkey AS b, lpad({BIG}, 90, '0') AS v FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
  three AS (SELECT party, s * cast(substr(v, 1, 30) AS HUGEINT) AS h, s * cast(substr(v, 31, 30) AS HUGEINT) AS m, s * cast(substr(v, 61, 30) AS HUGEINT) AS l FROM (SELECT a AS party, v, -1 AS s FROM big UNION ALL SELECT b, v, 1 FROM big)),
  net AS (SELECT party, cast(sum(h) AS HUGEINT) AS h, cast(sum(m) AS HUGEINT) AS m, cast(sum(l) AS HUGEINT) AS l, 1000000000000000000000000000000::HUGEINT AS e FROM three GROUP BY 1),
  up AS (SELECT *, ((l % e) + e) % e AS l0 FROM net), up2 AS (SELECT *, m + (l - l0) // e AS m1 FROM up), up3 AS (SELECT *, ((m1 % e) + e) % e AS m0 FROM up2), sign AS (SELECT party, e, CASE WHEN h + (m1 - m0) // e < 0 THEN -1 ELSE 1 END AS s, h, m, l FROM up3),
  pos AS (SELECT party, e, s, s * h AS h, s * m AS m, s * l AS l FROM sign), p1 AS (SELECT *, ((l % e) + e) % e AS l0 FROM pos), p2 AS (SELECT *, m + (l - l0) // e AS m1 FROM p1), p3 AS (SELECT *, ((m1 % e) + e) % e AS m0 FROM p2),
  text AS (SELECT party, s, cast(h + (m1 - m0) // e AS VARCHAR) || lpad(cast(m0 AS VARCHAR), 30, '0') || lpad(cast(l0 AS VARCHAR), 30, '0') AS t FROM p3)"""


@query(f"""WITH {BIG_TWIN} SELECT party, CASE WHEN s < 0 THEN '-' ELSE '' END || CASE WHEN ltrim(t, '0') = '' THEN '0' ELSE ltrim(t, '0') END AS balance FROM text""")
def ledger_balance_big(t):
    """Balances of amounts of more than sixty digits, most of them negative for customers."""
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey", "l_extendedprice").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    amount = F.concat(cents, F.repeat(F.lpad(F.col("l_partkey").cast("string"), 10, "0"), 5), F.lpad(F.col("l_orderkey").cast("string"), 10, "0"))
    moves = lines.select(F.concat(F.lit("C"), "o_custkey").alias("a"), F.concat(F.lit("S"), "l_suppkey").alias("b"), amount.alias("v"))
    return L.big_balances(moves, "a", "b", "v")


@query(f"""WITH {TRANSFERS} SELECT lower(party) AS party, cast(sum(CASE WHEN token = 'A' THEN amount ELSE 0 END) AS DOUBLE) AS "A", cast(sum(CASE WHEN token = 'N' THEN amount ELSE 0 END) AS DOUBLE) AS "N",
           cast(sum(CASE WHEN token = 'R' THEN amount ELSE 0 END) AS DOUBLE) AS "R" FROM legs GROUP BY 1""")
def ledger_balance_by_token(t):
    return as_double(L.balances_wide(transfers(t), *ENDS, "token", ["A", "N", "R"]), "A", "N", "R")


@query(f"""WITH {TRANSFERS} SELECT party, max(ts) AS last_ts, cast(sum(CASE WHEN token = 'A' THEN amount ELSE 0 END) AS DOUBLE) AS "A", cast(sum(CASE WHEN token = 'N' THEN amount ELSE 0 END) AS DOUBLE) AS "N",
           cast(sum(CASE WHEN token = 'R' THEN amount ELSE 0 END) AS DOUBLE) AS "R" FROM legs WHERE ts < DATE '1998-01-01' GROUP BY 1""")
def ledger_balance_asof(t):
    out = L.balances_asof(transfers(t), *ENDS, "token", ["A", "N", "R"], "ts", F.lit("1998-01-01").cast("date"))
    return as_double(out, "A", "N", "R")


@query(f"""WITH {TRANSFERS}, s AS (SELECT party, token, ts, sum(amount) AS change FROM legs GROUP BY 1, 2, 3)
           SELECT party, token, ts, cast(change AS DOUBLE) AS change, cast(sum(change) OVER (PARTITION BY party, token ORDER BY ts) AS DOUBLE) AS balance FROM s""")
def ledger_balance_history(t):
    out = L.balance_history(transfers(t), *ENDS, ["token"], "ts", bucket=F.to_date("ts"))
    return as_double(out, "change", "balance")


START, UNTIL = "1996-01-01", "1998-12-31"  # first day and run date of the daily ledger

# Closes are missing on even days: those quotes stand under another symbol, so every line is read.
QUOTES = """q AS (SELECT CASE WHEN day(l_shipdate) % 2 = 1 THEN l_returnflag ELSE l_returnflag || 'x' END AS token, cast(l_shipdate AS DATE) AS day, cast(cast(max(l_quantity) AS INTEGER) % 7 AS DOUBLE) AS price FROM lineitem GROUP BY 1, 2),
           i AS (SELECT l_returnflag AS token, arg_max(l_tax, (l_shipdate, l_orderkey, l_linenumber, l_tax)) AS spot FROM lineitem GROUP BY 1)"""


def quotes(t, by):
    from ..operators.windows import latest_per_key

    li = t.lineitem.select(F.col("l_returnflag").alias("token"), "l_shipdate", "l_quantity", "l_tax", "l_orderkey", "l_linenumber")
    token = F.when(F.dayofmonth("l_shipdate") % 2 == 1, F.col("token")).otherwise(F.concat("token", F.lit("x"))).alias("token")
    closes = li.groupBy(token, by.alias("day")).agg((F.max("l_quantity").cast("int") % 7).cast("double").alias("price"))
    spot = latest_per_key(li.withColumn("price", F.col("l_tax")), "token", ["l_shipdate", "l_orderkey", "l_linenumber", "l_tax"])
    return closes, spot


@query(f"""WITH {TRANSFERS}, {QUOTES}, w AS (SELECT 'S' || s_suppkey AS party FROM supplier WHERE s_acctbal > 8500),
           m AS (SELECT party, token, greatest(day, DATE '{START}') AS day, sum(amount) AS change FROM legs JOIN w USING (party) WHERE day <= DATE '{UNTIL}' GROUP BY 1, 2, 3),
           g AS (SELECT party, token, day FROM (SELECT DISTINCT party, token FROM m) CROSS JOIN (SELECT cast(unnest(generate_series(DATE '{START}', DATE '{UNTIL}', INTERVAL 1 DAY)) AS DATE) AS day)),
           b AS (SELECT party, token, day, coalesce(change, 0) AS change, sum(coalesce(change, 0)) OVER (PARTITION BY party, token ORDER BY day) AS balance FROM g LEFT JOIN m USING (party, token, day))
           SELECT party, token, day, cast(change AS DOUBLE) AS change, cast(balance AS DOUBLE) AS balance, coalesce(price, spot) AS price, cast(balance AS DOUBLE) * coalesce(price, spot) AS value_usd
           FROM b LEFT JOIN q USING (token, day) LEFT JOIN i USING (token)""")
def ledger_daily_dense(t):
    """Balance and value of every watched wallet and token on every day from the start to the run date."""
    watched = t.supplier.filter("s_acctbal > 8500").select(F.concat(F.lit("S"), "s_suppkey").alias("party"))
    held = L.watched_daily_balances(transfers(t), *ENDS, watched, ["token"], "day", START, UNTIL)
    closes, spot = quotes(t, F.to_date("l_shipdate"))
    return L.value_balances(as_double(held, "change", "balance"), closes, spot, "token", "day", "price", "l_shipdate")


@query(f"""WITH {TRANSFERS}, b AS (SELECT party, token AS symbol, cast(date_trunc('month', ts) AS DATE) AS day, sum(amount) AS balance FROM legs GROUP BY 1, 2, 3),
           q AS (SELECT l_returnflag AS symbol, cast(date_trunc('month', l_shipdate) AS DATE) AS day, cast(cast(max(l_quantity) AS INTEGER) % 7 AS DOUBLE) AS price FROM (SELECT * REPLACE (CASE WHEN day(l_shipdate) % 2 = 1 THEN l_returnflag ELSE l_returnflag || 'x' END AS l_returnflag) FROM lineitem) GROUP BY 1, 2),
           i AS (SELECT l_returnflag AS symbol, arg_max(l_tax, (l_shipdate, l_orderkey, l_linenumber, l_tax)) AS spot FROM lineitem GROUP BY 1)
           SELECT party, symbol, day, cast(balance AS DOUBLE) AS balance, coalesce(price, spot) AS price, cast(balance AS DOUBLE) * coalesce(price, spot) AS value_usd FROM b LEFT JOIN q USING (symbol, day) LEFT JOIN i USING (symbol)""")
def balance_valuation(t):
    month = F.trunc("ts", "month").alias("day")
    held = L.balances(transfers(t).select("from_address", "to_address", "value", F.col("token").alias("symbol"), month), *ENDS, by=["symbol", "day"])
    closes, spot = quotes(t, F.trunc("l_shipdate", "month"))
    return L.value_balances(as_double(held, "balance"), closes.withColumnRenamed("token", "symbol"), spot.withColumnRenamed("token", "symbol"), "symbol", "day", "price", "l_shipdate")


@query(f"""WITH {TRANSFERS}, h AS (SELECT party, sum(amount) AS holding FROM legs GROUP BY 1 HAVING sum(amount) > 0)
           SELECT party, tx, log_index, part, direction, cast(amount AS DOUBLE) AS amount, cast(holding AS DOUBLE) AS holding, p_name, CASE WHEN p_size > 40 THEN 'NFT' ELSE 'TOKEN' END AS token_kind
           FROM legs JOIN h USING (party) LEFT JOIN part ON p_partkey = part""")
def counterparty_transactions(t):
    tokens = t.part.select(F.col("p_partkey").alias("part"), "p_name")
    nft = t.part.filter("p_size > 40").select(F.col("p_partkey").alias("part"))
    out = L.holder_transactions(transfers(t), *ENDS, tokens, "part", nft)
    return as_double(out.select("party", "tx", "log_index", "part", "direction", "amount", "holding", "p_name", "token_kind"), "amount", "holding")


@query(f"""WITH {TRANSFERS}, h AS (SELECT party FROM legs GROUP BY 1 HAVING sum(amount) > 0)
           SELECT party, count(*) AS transactions, cast(count(*) FILTER (p_size > 40) AS BIGINT) AS nft_transactions, cast(sum(amount) FILTER (direction = 'in') AS DOUBLE) AS received,
                  cast(sum(-amount) FILTER (direction = 'out') AS DOUBLE) AS sent FROM legs JOIN h USING (party) JOIN part ON p_partkey = part GROUP BY 1""")
def holder_totals(t):
    nft = t.part.filter("p_size > 40").select(F.col("p_partkey").alias("part"))
    entries = L.holder_transactions(transfers(t), *ENDS, t.part.select(F.col("p_partkey").alias("part"), "p_name"), "part", nft)
    return as_double(L.holder_totals(entries), "received", "sent")


@query(f"""WITH {TRANSFERS}, w AS (SELECT 'S' || s_suppkey AS party, s_name AS wallet_label FROM supplier WHERE s_acctbal > 8000 UNION ALL SELECT 'C' || c_custkey, c_name FROM customer WHERE c_acctbal > 9800)
           SELECT tx, log_index, party, other AS counterparty, direction, wallet_label, p_name AS symbol, cast(amount AS DOUBLE) / pow(10.0, p_size % 5) AS units FROM legs JOIN w USING (party) LEFT JOIN part ON p_partkey = part WHERE ts >= TIMESTAMP '1999-01-01'""")
def wallet_transfers_labelled(t):
    from ..functions.numeric import scale_units

    wallets = t.supplier.filter("s_acctbal > 8000").select(F.concat(F.lit("s"), "s_suppkey").alias("w"), F.col("s_name").alias("label")).union(
        t.customer.filter("c_acctbal > 9800").select(F.concat(F.lit("C"), "c_custkey"), "c_name"))
    tokens = t.part.select(F.col("p_partkey").alias("part"), F.col("p_name").alias("symbol"), (F.col("p_size") % 5).alias("decimals"))
    out = L.watched_transfers(transfers(t), *ENDS, wallets, "w", "label", tokens, "part", "ts", F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))
    return out.select("tx", "log_index", "party", "counterparty", "direction", "wallet_label", "symbol", scale_units("amount", "decimals").alias("units"))


RULES = """r AS (SELECT 'to' AS side, 'S' || s_suppkey AS address, 'deposit' AS tag FROM supplier WHERE s_nationkey < 12 UNION ALL SELECT 'from', 'C' || c_custkey, 'reward' FROM customer WHERE c_mktsegment = 'BUILDING'
           UNION ALL SELECT 'to', 'S' || s_suppkey, 'withdraw' FROM supplier WHERE s_nationkey BETWEEN 10 AND 14)"""


def rule_table(t):
    s, c = F.concat(F.lit("S"), "s_suppkey"), F.concat(F.lit("C"), "c_custkey")
    deposit = t.supplier.filter("s_nationkey < 12").select(F.lit("to").alias("side"), s.alias("address"), F.lit("deposit").alias("tag"))
    reward = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.lit("from"), c, F.lit("reward"))
    return deposit.union(reward).union(t.supplier.filter("s_nationkey BETWEEN 10 AND 14").select(F.lit("to"), s, F.lit("withdraw")))


@query(f"""WITH {TRANSFERS}, {RULES}, m AS (SELECT tr.*, tag FROM tr JOIN r ON (side = 'to' AND address = to_address) OR (side = 'from' AND address = from_address))
           SELECT tx, log_index, part, tag, cast(value AS DOUBLE) AS value, rank() OVER (PARTITION BY tx ORDER BY log_index) AS rank_in_tx FROM m""")
def staking_classification(t):
    out = L.classify_transfers(transfers(t), "from_address", "to_address", rule_table(t), ["tx"], "log_index", F.floor(F.col("log_index") / 1000))
    return as_double(out.select("tx", "log_index", "part", "tag", "value", "rank_in_tx"), "value")


@query(f"""WITH {TRANSFERS}, {RULES} SELECT day, tag, cast(count(*) AS BIGINT) AS n, cast(sum(value) AS DOUBLE) AS value FROM tr JOIN r ON (side = 'to' AND address = to_address) OR (side = 'from' AND address = from_address) GROUP BY 1, 2""")
def staking_daily(t):
    out = L.classify_transfers(transfers(t), "from_address", "to_address", rule_table(t), ["tx"], "log_index", F.floor(F.col("log_index") / 1000))
    return out.groupBy("day", "tag").agg(F.count("*").alias("n"), F.sum("value").cast("double").alias("value"))


@query(f"""WITH {TRANSFERS} SELECT tx, log_index, part, to_address FROM tr WHERE tx IN (SELECT tx FROM tr WHERE to_address = 'S7' OR from_address = 'S7')""")
def tx_closure(t):
    return L.transactions_touching(transfers(t), ["from_address", "to_address"], ["S7"], "tx").select("tx", "log_index", "part", "to_address")


@query("""WITH u AS (SELECT user_id AS k FROM events UNION SELECT o_custkey FROM orders),
               e AS (SELECT user_id AS k, count(*) FILTER (event_type = 'signup') AS claimed, count(*) FILTER (event_type = 'purchase') AS opened, count(*) FILTER (event_type = 'error') AS burned FROM events GROUP BY 1),
               o AS (SELECT o_custkey AS k, count(*) AS minted FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), h AS (SELECT o_custkey AS k, count(*) AS held FROM orders GROUP BY 1)
          SELECT k, cast(coalesce(claimed, 0) - coalesce(opened, 0) - coalesce(minted, 0) + coalesce(burned, 0) AS BIGINT) AS boxes, cast(5 * coalesce(opened, 0) - 2 * coalesce(burned, 0) AS BIGINT) AS parts, cast(coalesce(held, 0) AS BIGINT) AS on_chain
          FROM u LEFT JOIN e USING (k) LEFT JOIN o USING (k) LEFT JOIN h USING (k)""")
def non_native_asset_counts(t):
    e = t.events.withColumnRenamed("user_id", "k")
    o = t.orders.withColumnRenamed("o_custkey", "k")
    kind = F.col("event_type")
    logs = [(e, "claimed", (kind == "signup").cast("int")), (e, "opened", (kind == "purchase").cast("int")), (e, "burned", (kind == "error").cast("int")),
            (o, "minted", (F.col("o_orderstatus") == "F").cast("int")), (o, "held", F.lit(1))]
    return L.asset_counts(logs, "k", {"boxes": [("claimed", 1), ("opened", -1), ("minted", -1), ("burned", 1)], "parts": [("opened", 5), ("burned", -2)], "on_chain": [("held", 1)]})


@query("""SELECT doc_id, source, quality, CASE WHEN d.doc_id IS NULL THEN 'missing' END AS missing_left, CASE WHEN l.doc_id IS NULL THEN 'missing' END AS missing_right
          FROM (SELECT * REPLACE (CASE WHEN lang = 'fr' THEN -1 - doc_id ELSE doc_id END AS doc_id) FROM documents) d FULL JOIN labels l USING (doc_id)""")
def reconcile(t):
    """Documents in French stand under ids that no label has."""
    docs = t.documents.select("source", F.when(F.col("lang") == "fr", -1 - F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"))
    return L.reconcile(docs, t.labels, "doc_id", ["source"], ["quality"])


REPORT = """WITH rep AS (SELECT CASE WHEN l_linenumber < 3 THEN l_orderkey ELSE -l_orderkey END AS order_id, CASE WHEN l_returnflag = 'R' THEN 'Refund' ELSE 'Charged' END AS status, l_suppkey AS product, cast(l_shipdate AS DATE) AS charged, cast(l_quantity AS INTEGER) AS price FROM lineitem),
               ref AS (SELECT DISTINCT order_id FROM rep WHERE status = 'Refund'),
               pre AS (SELECT order_id, CASE WHEN f.order_id IS NULL THEN status ELSE 'Refund' END AS status, product, price, min(charged) AS charged FROM rep LEFT JOIN ref f USING (order_id) GROUP BY 1, 2, 3, 4),
               game AS (SELECT CASE WHEN o_orderstatus = 'O' THEN -1000000000000 - o_orderkey ELSE o_orderkey END AS order_id, o_custkey AS user_id, cast(floor(o_totalprice) AS BIGINT) AS game_price FROM orders),
               j AS (SELECT order_id, user_id, status, product, price, game_price, charged, CASE WHEN p.order_id IS NULL THEN 'missing' END AS missing_left, CASE WHEN g.order_id IS NULL THEN 'missing' END AS missing_right FROM pre p FULL JOIN game g USING (order_id)),
               b AS (SELECT product, min(game_price) AS fill FROM j WHERE price IS NOT NULL AND game_price IS NOT NULL GROUP BY 1)"""


def store_report(t):
    """Store lines as a report, refunds first: one row per order and product. Later lines are orders the game does not know."""
    rep = t.lineitem.select(
        F.when(F.col("l_linenumber") < 3, F.col("l_orderkey")).otherwise(-F.col("l_orderkey")).alias("order_id"), F.when(F.col("l_returnflag") == "R", "Refund").otherwise("Charged").alias("status"), F.col("l_suppkey").alias("product"),
        F.to_date("l_shipdate").alias("charged"), F.col("l_quantity").cast("int").alias("price"))
    return L.refund_overrides(rep, "order_id", "status", "Refund", ["product", "price"], "charged")


def game_orders(t):
    """Own orders; open ones have ids the store does not know."""
    return t.orders.select(F.when(F.col("o_orderstatus") == "O", -1000000000000 - F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("order_id"), F.col("o_custkey").alias("user_id"), F.floor("o_totalprice").cast("bigint").alias("game_price"))


@query(REPORT + """
          SELECT order_id, user_id, status, j.product, price, charged, missing_left, missing_right, coalesce(game_price, fill) AS game_price FROM j LEFT JOIN b ON b.product IS NOT DISTINCT FROM j.product""")
def reconcile_two_sources(t):
    """Store report against the game's own orders, missing prices filled from the same product."""
    both = written(L.reconcile(written(store_report(t), "report"), game_orders(t), "order_id", ["status", "product", "price", "charged"], ["user_id", "game_price"]), "reconciled")
    return L.backfill_by_product(both, "product", {"game_price": F.when(F.col("price").isNotNull(), F.col("game_price"))})


@query(REPORT + """
          SELECT order_id, user_id, game_price, false AS recovered FROM game UNION ALL SELECT order_id, NULL, cast(price AS BIGINT), true FROM j WHERE missing_right = 'missing' AND status = 'Charged'""")
def reconcile_recovered(t):
    """Own orders plus charged store rows they lack."""
    game = game_orders(t)
    both = L.reconcile(written(store_report(t), "report"), game, "order_id", ["status", "product", "price", "charged"], ["user_id", "game_price"])
    return L.recovered_rows(game, both, "status", "Charged", {"order_id": F.col("order_id"), "game_price": F.col("price")})
