"""A training corpus from ``documents``: quality rules, near-dedup, decontamination, mixing, sharding.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read again as
the next stage's ``docs``. All but the last return the columns of ``documents``; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, quality_rules, sharding, simhash
from tidemark.llm.shared import table
from tidemark.session import configure


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified cutoff go."""
    return quality_rules.accepted(docs, _read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: shingles of three words, links at three differing bits or fewer."""
    configure(spark)
    return simhash.one_per_group(docs, shingle=3, most=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth or more go."""
    return decontaminate.clean(docs, _read(spark, sf_dir, "benchmark"), window=13)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of 150 % of their words takes them: not at all, once or twice."""
    configure(spark)
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, dealt to 40 shards of near-equal bytes."""
    configure(spark)
    return sharding.sharded(docs, shards=40)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", source_mix), ("sharding", shards)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL cannot express the fingerprints (XXH64), the shuffle or the tree; the stages are tested against brute force.
ORACLE_SQL = None
