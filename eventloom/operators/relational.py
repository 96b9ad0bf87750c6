"""Group count and top-k, as columns and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_table(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run ``query``; ``{name}`` in it stands for the table passed as ``name``."""
    return spark.sql(query, **tables)


def group_count(df: DataFrame, key: str, counted: str, out: str = "num") -> DataFrame:
    """Non-null ``counted`` values per key, most frequent first, ties by key."""
    counts = df.groupBy(key).agg(F.count(counted).alias(out))
    return counts.orderBy(F.desc(out), F.asc(key))


def top_k(df: DataFrame, key: str, counted: str, k: int, out: str = "num") -> DataFrame:
    return group_count(df, key, counted, out).limit(k)
