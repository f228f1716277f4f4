"""Campaign, advertising and social queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import finance as B
from ..operators.aggregates import money
from .registry import query

KINDS = ["view", "click", "signup", "purchase", "error"]
RATES = {"ctr": ("click", "view"), "ccr": ("purchase", "click")}


def facts(t):
    bucket = F.floor(F.get_json_object("props", "$.k").cast("bigint") / 10)
    return t.events.select(F.to_date("ts").alias("day"), bucket.alias("campaign"), "event_type", "user_id", "value")


def report_sql(dims: str) -> str:
    return f"""WITH e AS (SELECT cast(ts AS DATE) AS day, cast(json_extract_string(props, '$.k') AS BIGINT) // 10 AS campaign, * FROM events),
      g AS (SELECT {dims}, {", ".join(f"cast(count(*) FILTER (event_type = '{k}') AS BIGINT) AS {k}" for k in KINDS)}, count(DISTINCT user_id) AS dau, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS revenue FROM e GROUP BY ALL)
      SELECT *, CASE WHEN "view" = 0 THEN 0.0 ELSE click / cast("view" AS DOUBLE) END * 100 AS ctr, CASE WHEN click = 0 THEN 0.0 ELSE purchase / cast(click AS DOUBLE) END * 100 AS ccr FROM g"""


def report(t, dims):
    out = B.campaign_report(facts(t), dims, "event_type", KINDS, "user_id", RATES, {"revenue": F.sum(money("value"))})
    return out.withColumn("revenue", F.col("revenue").cast("double"))


@query(report_sql("day, campaign"))
def campaign_report(t):
    return report(t, ["day", "campaign"])


@query(report_sql("campaign"))
def channel_report(t):
    return report(t, ["campaign"])


@query("""SELECT cast(ts AS DATE) AS day, user_id % 25 AS country, count(*) FILTER (event_type = 'view') AS views, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS revenue FROM events GROUP BY 1, 2""")
def campaign_fact(t):
    return t.events.groupBy(F.to_date("ts").alias("day"), (F.col("user_id") % 25).alias("country")).agg(
        F.count_if(F.col("event_type") == "view").alias("views"), F.sum(money("value")).cast("double").alias("revenue"))


@query("""WITH p AS (SELECT l_partkey AS ad, l_returnflag AS age_group, max(cast(l_quantity AS BIGINT)) AS clicks, cast(round(cast(max(cast(round(l_extendedprice * 1000) AS BIGINT)) / 1e6 AS DECIMAL(38,9)), 2) AS DOUBLE) AS spend, cast(sum(l_linenumber) AS BIGINT) AS impressions FROM lineitem GROUP BY 1, 2)
          SELECT ad, age_group, clicks, spend, impressions, p_name AS status, s_name AS video FROM p LEFT JOIN part ON p_partkey = ad LEFT JOIN supplier ON s_suppkey = ad""")
def ads_fact(t):
    stats = t.lineitem.select(F.col("l_partkey").alias("ad"), F.col("l_returnflag").alias("age_group"), F.col("l_quantity").cast("bigint").alias("clicks"),
                              F.round(F.col("l_extendedprice") * 1000).cast("bigint").alias("micros"), F.col("l_linenumber").alias("impressions"))
    status = t.part.select(F.col("p_partkey").alias("ad"), F.col("p_name").alias("status"))
    return B.ads_fact(stats, status, "ad", ["age_group"], "micros", "clicks", t.supplier.select(F.col("s_suppkey").alias("ad"), F.col("s_name").alias("video")), "video")


@query("""SELECT c_custkey AS post, c_name, coalesce(reactions, 0) AS reactions, coalesce(clicks, 0) AS clicks, coalesce(comments, 0) AS comments, coalesce(reactions, 0) + coalesce(clicks, 0) + coalesce(comments, 0) AS engagement FROM customer
          LEFT JOIN (SELECT user_id, count(*) FILTER (event_type = 'view') AS reactions, count(*) FILTER (event_type = 'click') AS clicks FROM events GROUP BY 1) ON user_id = c_custkey
          LEFT JOIN (SELECT o_custkey, count(*) AS comments FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def social_engagement(t):
    def events(kind):
        return t.events.filter(F.col("event_type") == kind).groupBy(F.col("user_id").alias("post")).agg(F.count("*").alias("n"))

    posts = t.customer.select(F.col("c_custkey").alias("post"), "c_name")
    comments = t.orders.groupBy(F.col("o_custkey").alias("post")).agg(F.count("*").alias("n"))
    return B.engagement(posts, "post", {"reactions": events("view"), "clicks": events("click"), "comments": comments})


@query("""SELECT 'shop' AS channel, c_nationkey AS account, count(*) AS followers, cast(sum(cast(c_acctbal AS DECIMAL(14,2))) AS DOUBLE) AS reach, NULL AS posts FROM customer GROUP BY 2
          UNION ALL SELECT 'factory', s_nationkey, count(*), NULL, NULL FROM supplier GROUP BY 2
          UNION ALL SELECT 'game', NULL, NULL, NULL, count(*) FROM events""")
def profile_stats_conform(t):
    return B.conform_profiles({
        "shop": t.customer.groupBy(F.col("c_nationkey").alias("account")).agg(F.count("*").alias("followers"), F.sum(money("c_acctbal")).cast("double").alias("reach")),
        "factory": t.supplier.groupBy(F.col("s_nationkey").alias("account")).agg(F.count("*").alias("followers")),
        "game": t.events.agg(F.count("*").alias("posts")),
    })


@query("""SELECT role, count(DISTINCT conv_id) AS threads, count(*) AS messages, cast(max(length(text)) AS INTEGER) AS longest FROM conversations GROUP BY 1""")
def post_stats(t):
    per = t.conversations.groupBy("role", "conv_id").agg(F.count("*").alias("n"), F.max(F.length("text")).alias("l"))
    return per.groupBy("role").agg(F.count("*").alias("threads"), F.sum("n").alias("messages"), F.max("l").alias("longest"))
