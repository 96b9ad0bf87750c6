"""Tumbling event-time windows. Every function takes a table or a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventloom.operators.ordered import running_total


def with_event_time(
    df: DataFrame,
    ts: str,
    delay: str = "0 seconds",
    out: str | None = None,
    ingest_time: bool = False,
) -> DataFrame:
    """Make ``out`` (default ``ts``) the event time, with a watermark ``delay`` behind it.

    ``ingest_time`` takes the arrival time instead. A text that is no time gives null,
    see :func:`without_time`. One rule for both: a time without zone is taken as UTC,
    whatever the session's zone, and one with an offset is moved to UTC. On a table the
    result is zone-less and there is no watermark. On a stream it has a zone, and rows that
    come later than ``delay`` are dropped.
    """
    out = out or ts
    time = F.col(ts)
    if ingest_time:
        time = F.current_timestamp()
    elif not df.isStreaming and df.schema[ts].dataType.typeName() == "string":
        plain = F.concat(time, F.lit("Z")).try_cast("timestamp").isNotNull()
        moved = F.to_utc_timestamp(time.try_cast("timestamp"), F.current_timezone())
        time = F.when(plain, time.try_cast("timestamp_ntz")).otherwise(moved.cast("timestamp_ntz"))
    elif not df.isStreaming:
        time = time.try_cast("timestamp_ntz")
    elif df.schema[ts].dataType.typeName() != "timestamp":
        in_utc = F.concat(time.cast("string"), F.lit("Z")).try_cast("timestamp")
        time = F.coalesce(in_utc, time.try_cast("timestamp"))
    timed = df.withColumn(out, time)
    return timed.withWatermark(out, delay) if df.isStreaming else timed


def without_time(df: DataFrame, ts: str) -> DataFrame:
    """Rows that no window takes, because they have no time."""
    return df.where(F.col(ts).isNull())


def tumbling(ts: str, width: str) -> Column:
    return F.window(F.col(ts), width)


def windowed_sum(
    df: DataFrame, key: str, ts: str, width: str, value: str, out: str = "total"
) -> DataFrame:
    """``(window_start, key, out)``: sum of ``value`` per key and window."""
    sums = df.groupBy(tumbling(ts, width).alias("window"), key).agg(F.sum(value).alias(out))
    return sums.select(F.col("window.start").alias("window_start"), key, out)


def window_max_by(
    df: DataFrame,
    key: str,
    ts: str,
    width: str,
    value: str,
    order: list[str],
    keep: list[str] | None = None,
) -> DataFrame:
    """Per key and window the row with the largest ``value``, on a tie the first in ``order``.

    Any type that can be ordered; NaN is above all numbers, as in Spark's order. Rows with a
    null ``value`` are left out.
    """
    kept = list(dict.fromkeys(c for c in [value, *order, *(keep or [])] if c != key))
    rows = df.where(F.col(value).isNotNull() & F.col(ts).isNotNull())
    if not df.isStreaming:
        # Each task keeps its best row of a group before the shuffle; one sort, no struct to aggregate.
        placed = rows.withColumn("_start", tumbling(ts, width)["start"])
        best = Window.partitionBy("_start", key).orderBy(F.desc(value), *order)
        first = placed.withColumn("_place", F.row_number().over(best)).where("_place = 1")
        return first.select(F.col("_start").alias("window_start"), key, *kept)
    # Equal values first, so that the second step has no ties.
    first = (
        rows.groupBy(tumbling(ts, width).alias("window"), key, F.col(value).alias("_value"))
        .agg(F.min_by(F.struct(*kept), F.struct(*order)).alias("first"))
    )
    best = first.groupBy("window", key).agg(F.max_by("first", "_value").alias("best"))
    return best.select(
        F.col("window.start").alias("window_start"), key, *[F.col(f"best.{c}") for c in kept]
    )


def window_counts(df: DataFrame, key: str, ts: str, width: str, out: str = "n") -> DataFrame:
    """``(window_start, key, out)``: rows per key and window."""
    counts = df.groupBy(tumbling(ts, width).alias("window"), key).agg(F.count(F.lit(1)).alias(out))
    return counts.select(F.col("window.start").alias("window_start"), key, out)


def cumulate_windows(
    per_window: DataFrame,
    key: str,
    value: str = "n",
    out: str = "total",
    seed: DataFrame | None = None,
) -> DataFrame:
    """Running sum of ``value`` over the windows of each key (tables only).

    ``seed(key, seed)`` gives totals to start from, as after a restore; other keys
    start at 0. Input is one row per key and window. Windows are cut by range like other
    ordered work, so that a key with many windows is not one task.
    """
    running = running_total(per_window, [key], ["window_start"], value, out)
    if seed is None:
        return running
    seeded = running.join(seed.select(key, "seed"), key, "left")
    return seeded.withColumn(out, F.col(out) + F.coalesce("seed", F.lit(0))).drop("seed")


def running_total_per_window(
    df: DataFrame,
    key: str,
    ts: str,
    width: str,
    value: str | None = None,
    out: str = "total",
    order: list[str] | None = None,
) -> DataFrame:
    """The largest running total per key within each window.

    Without ``order`` values must not be negative: totals then only grow, so the largest is the
    last, and events are added up per window first. A negative value fails the job, as the
    order of events in the window would count. With ``order``, the columns that order events of
    one time, any value is taken: there is a running total at each event.
    """
    if order is not None:
        steps = df if value is not None else df.withColumn("_one", F.lit(1).cast("bigint"))
        kept = list(dict.fromkeys([key, ts, *order, value or "_one"]))
        totals = running_total(steps.where(F.col(ts).isNotNull()).select(*kept), [key], [ts, *order], value or "_one", "_total")
        largest = totals.groupBy(tumbling(ts, width).alias("window"), key).agg(F.max("_total").alias(out))
        return largest.select(F.col("window.start").alias("window_start"), key, out)
    if value is None:
        per_window = window_counts(df, key, ts, width)
    else:
        refused = F.raise_error("negative value in running_total_per_window")
        checked = F.when(F.col(value) < 0, refused.cast(df.schema[value].dataType)).otherwise(F.col(value))
        per_window = windowed_sum(df.withColumn(value, checked), key, ts, width, value, out="n")
    return cumulate_windows(per_window, key, "n", out).drop("n")


def cumulative_window_count(
    df: DataFrame, key: str, ts: str, width: str, seed: DataFrame | None = None
) -> DataFrame:
    """``(window_start, key, n, total)``: events in the window and ever since the start."""
    return cumulate_windows(window_counts(df, key, ts, width), key, "n", "total", seed)
