"""Keyed lookups and write-back, as joins and aggregates.

No side is forced to be broadcast: Spark does so when the measured size of the lookup
table is below its threshold, and otherwise shuffles both sides and splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(facts: DataFrame, lookup: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Every fact with the looked-up ``values``, null where the key is unknown.

    Of rows with the same key in ``lookup`` the one with the smallest values counts, so
    facts are never multiplied; one with nulls counts only if there is none without. A
    streaming ``facts`` is joined batch by batch.
    """
    nulls = sum((F.col(v).isNull().cast("int") for v in values), F.lit(0))
    held = lookup.groupBy(key).agg(F.min(F.struct(nulls.alias("_nulls"), *values)).alias("_held"))
    held = held.select(key, *[F.col(f"_held.{v}").alias(v) for v in values])
    return facts.join(held, key, "left")


def hit_rate(facts: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """``(calls, hits)``: lookups made, and lookups that found their key.

    Calls are counted per key first, and a key that is held twice counts once, so the join
    sees one row per key.
    """
    calls = facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    held = lookup.select(key).distinct().withColumn("_hit", F.lit(True))
    return calls.join(held, key, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("calls"),
        F.coalesce(F.sum(F.when(F.col("_hit"), F.col("n"))), F.lit(0)).alias("hits"),
    )


def backfill(requested: DataFrame, held: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``held`` plus the requested keys it lacks, fetched from ``source`` in one join.

    Keys that the source lacks, or has with a null value, stay absent.
    """
    missing = requested.select(key).distinct().join(held.select(key), key, "left_anti")
    fetched = source.join(missing, key, "left_semi").select(*held.columns)
    values = [c for c in held.columns if c != key]
    if values:
        fetched = fetched.dropna(how="all", subset=values)
    return held.unionByName(fetched)


def latest_dirty(
    changes: DataFrame, key: str, value: str, seq: str, dirty: str = "is_updated"
) -> DataFrame:
    """The last value per key among the rows flagged dirty: ``(key, value, seq)``."""
    return (
        changes.where(F.col(dirty))
        .groupBy(key)
        .agg(F.max_by(value, seq).alias(value), F.max(seq).alias(seq))
    )


def upsert(
    base: DataFrame, changes: DataFrame, key: str, value: str, seq: str, dirty: str = "is_updated"
) -> DataFrame:
    """``base(key, value)`` after writing back the dirty ``changes``; the last one wins.

    ``base`` has one row per key, and every change has a ``seq``.
    """
    no_seq = F.lit(None).cast(changes.schema[seq].dataType).alias(seq)
    start = base.select(key, F.col(value).alias("_base"), F.lit(None).alias(value), no_seq)
    written = changes.where(F.col(dirty)).select(key, F.lit(None).alias("_base"), value, seq)
    merged = start.unionByName(written).groupBy(key).agg(
        F.max(seq).alias(seq),
        F.max_by(value, seq).alias(value),
        F.first("_base", ignorenulls=True).alias("_base"),
    )
    changed = F.when(F.col(seq).isNotNull(), F.col(value)).otherwise(F.col("_base"))
    return merged.select(key, changed.alias(value))


def recent_keys(accesses: DataFrame, key: str, seq: str, n: int) -> DataFrame:
    """The ``n`` keys used last, the most recent first."""
    last = accesses.groupBy(key).agg(F.max(seq).alias("last_seq"))
    return last.orderBy(F.desc("last_seq"), F.asc(key)).limit(n)
