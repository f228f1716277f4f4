"""URL filters: host and path rules first, then the reputation of the host by empirical Bayes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import table

# Rules of the contract (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
LEVELS = ("suffix", "domain", "host")
# A host is blocked if its share of bad pages exceeds MOST_BAD with posterior probability SURE.
MOST_BAD, SURE = 0.5, 0.9
# Suffixes below which anybody registers names, beside the plain last label (fixed values).
TWO_PART = ["co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in"]


def split_url(url: str = "url") -> tuple[Column, Column]:
    """``(host, path)``: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased, and from
    there up to ``?``, ``#`` or the end. A null url, or one without ``://``, has both empty.
    """
    u = F.col(url).cast("string")
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits, null if none: equal host or subdomain, path starts with the rule's.

    Rules of equal length are taken in code point order.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in ordered]
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for (h, p, v), fit in reversed(list(zip(ordered, fits))):
        rule, verdict = F.when(fit, F.lit(h + p)).otherwise(rule), F.when(fit, F.lit(v)).otherwise(verdict)
    return rule, verdict


def levels(host: Column) -> dict[str, Column]:
    """Suffix (last label, or a listed pair of labels), registered domain (one label more) and host itself."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    last = lambda k: F.concat_ws(".", F.slice(labels, F.greatest(n - k + 1, F.lit(1)), F.lit(k)))
    two = last(2).isin(TWO_PART)
    return {"suffix": F.when(two, last(2)).otherwise(last(1)), "domain": F.when(two, last(3)).otherwise(last(2)), "host": host}


def _strength(groups: DataFrame) -> float:
    """Strength of the beta prior, by moments: how little the groups' shares of bad pages differ beyond chance.

    ``groups`` has ``n``, ``bad`` and the parent's mean ``m``. Only sums over all groups are needed. Weights are
    n - 1, so a group seen once tells nothing about the spread. Between 2 pages (a single page never decides) and
    1000 (no spread at all).
    """
    r = groups.filter("n > 1").agg(
        F.sum("n").alias("n"), F.sum(F.expr("bad * (n - bad) / (n - 1)")).alias("inside"), F.sum(F.expr("n * m * (1 - m)")).alias("total"), F.count("*").alias("k")
    ).first()
    if not r["k"] or not r["total"]:
        return 10.0
    # Within a group two pages differ with probability 2 q (1 - q); against 2 m (1 - m) over the parent this gives the correlation.
    inside = min(max(r["inside"] / r["total"], 0.0), 1.0)
    correlation = min(max(1 - inside, 1e-3), 1 - 1e-3)
    return max(2.0, (1 - correlation) / correlation)


def beta_tail(a: np.ndarray, b: np.ndarray, x: float) -> np.ndarray:
    """P(Beta(a, b) > x) by the continued fraction of the incomplete beta function."""
    lg = np.vectorize(math.lgamma, otypes=[float])
    flip = x >= (a + 1) / (a + b + 2)
    p, q, y = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    front = np.exp(lg(p + q) - lg(p) - lg(q) + p * np.log(y) + q * np.log(1 - y)) / p
    tiny = 1e-300
    c, d = np.ones_like(p), 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        for step in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + step * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1) < 1e-12):
            break
    lower = front * h
    return np.where(flip, lower, 1 - lower)


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """``(host, n, bad, alpha, beta)`` per host of ``outcomes`` (``host``, ``bad`` 0, 1 or null): the beta posterior of its share of bad pages.

    The share of bad pages of a suffix is shrunk to that of all pages, a registered domain's to its suffix, a host's
    to its domain; how strongly is estimated per level from the spread between its groups. A null outcome is an
    unlabelled page: it adds no count, but its host gets a row, which is the domain's prior if nothing else is known.
    Pages are summed per host before anything is joined, so a host with a third of all pages is one row, and every
    further step is over hosts.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad"))
    hosts = table(hosts.withColumns({k: c for k, c in levels(F.col("host")).items() if k != "host"}), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((total["bad"] or 0.0) + 0.5) / ((total["n"] or 0.0) + 1.0)
    groups = parents = None
    for depth, level in enumerate(LEVELS):
        keys = list(LEVELS[: depth + 1])
        groups = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        groups = table(groups.withColumn("m", F.lit(mean)) if parents is None else groups.join(parents, keys[:-1]), "reputation")
        s = _strength(groups)
        groups = groups.withColumns({"alpha": F.col("bad") + F.col("m") * s, "beta": F.col("n") - F.col("bad") + (1 - F.col("m")) * s})
        parents = groups.select(*keys, (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("m"))
    return groups.select("host", "n", "bad", "alpha", "beta")


def _chance_bad(frames: Iterator[pd.DataFrame], most_bad: float) -> Iterator[pd.DataFrame]:
    for f in frames:
        if len(f):
            yield f[["host", "n", "bad"]].assign(chance=beta_tail(f["alpha"].to_numpy(float), f["beta"].to_numpy(float), most_bad))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]] = RULES, most_bad: float = MOST_BAD, sure: float = SURE) -> DataFrame:
    """``(page_id, host, path, rule, chance, verdict)`` per row of ``pages`` (``page_id``, ``url``).

    A rule that fits decides; the longest one wins. Otherwise a host is blocked if the posterior probability
    (``chance``) that more than ``most_bad`` of its pages are bad reaches ``sure``. ``outcomes`` holds labelled pages:
    ``page_id`` and ``bad`` (0 or 1); a page labelled twice is bad if any label says so; labels of unknown pages and
    null labels count nowhere. Without labels every host has the same prior and nothing is blocked by reputation.

    A null url, or one without ``://``, has an empty host and path; such pages share the empty host's reputation.
    Repeated rows are judged alike (each counts as a page); extra columns are not read; no pages give no rows.
    """
    host, path = split_url("url")
    seen = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    labelled = outcomes.filter("page_id IS NOT NULL").groupBy(F.col("page_id").alias("__id")).agg(F.max("bad").alias("bad"))
    known = seen.join(labelled, F.col("page_id") == F.col("__id"), "left").select("host", "bad")
    chance = host_reputation(known).mapInPandas(lambda f: _chance_bad(f, most_bad), "host string, n double, bad double, chance double").select("host", "chance")
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("chance") >= sure, F.lit("block")).otherwise(F.lit("allow"))
    judged = seen.join(chance, "host", "left")
    return judged.select("page_id", "host", "path", rule.alias("rule"), "chance", F.coalesce(ruled, learned).alias("verdict"))
