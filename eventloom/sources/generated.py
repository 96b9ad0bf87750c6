"""The replayable keyword source: row ``n`` carries keyword ``n mod len``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _keyword_at(n: Column, keywords: Sequence[str]) -> Column:
    words = F.array(*[F.lit(word) for word in keywords])
    return F.element_at(words, (F.pmod(n, F.lit(len(keywords))) + 1).cast("int"))


def keyword_rows(df: DataFrame, n: str, keywords: Sequence[str]) -> DataFrame:
    """``(one int, keyword string, n bigint)`` for every row number in column ``n``."""
    number = F.col(n).cast("bigint")
    return df.select(
        F.lit(1).alias("one"),
        _keyword_at(number, keywords).alias("keyword"),
        number.alias("n"),
    )


def keyword_stream(
    spark: SparkSession,
    keywords: Sequence[str],
    rows_per_batch: int = 1,
    millis_per_batch: int = 2000,
    start_millis: int = 0,
) -> DataFrame:
    """The same rows as an endless stream with a time column ``ts``.

    The position is an offset in the query's checkpoint: a restart repeats no number
    and leaves none out.
    """
    ticks = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("advanceMillisPerBatch", millis_per_batch)
        .option("startTimestamp", start_millis)
        .load()
    )
    return ticks.select(
        F.col("timestamp").alias("ts"),
        F.lit(1).alias("one"),
        _keyword_at(F.col("value"), keywords).alias("keyword"),
        F.col("value").alias("n"),
    )
