"""Keyed state that outlives a micro-batch and a restart."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (
    StatefulProcessor,
    StatefulProcessorHandle,
)

from eventloom.functions.strings import key_label
from eventloom.operators.ordered import collect_segments, number_segments
from eventloom.operators.windows import tumbling


def running_totals_stream(df: DataFrame, key: str, value: str, out: str = "total") -> DataFrame:
    """Total per key since the start; write in update mode, one row per key and batch.

    Only built-in aggregation: rows are added up before the shuffle.
    """
    return df.groupBy(key).agg(F.sum(value).alias(out))


class _WindowTotal(StatefulProcessor):
    """Adds the counts of closed windows to the key's total."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._total = handle.getValueState("total", "total bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        total = self._total.get()[0] if self._total.exists() else 0
        # One row per closed window, never one per event.
        for row in sorted(rows, key=lambda r: r.window_start):
            total += row.n
            yield Row(
                window_start=row.window_start, key=row.key, label=row.label, n=row.n, total=total
            )
        self._total.update((total,))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._total.update((initialState.seed,))


def cumulative_window_count_stream(
    df: DataFrame, key: str, ts: str, width: str, seed: DataFrame | None = None
) -> DataFrame:
    """``(window_start, key, label, n, total)`` when a window closes; ``label`` is ``(key)``.

    ``df`` needs a watermark on ``ts``. Events are counted per key and window by a
    built-in aggregate; the state processor sees only the counts. ``seed(key, seed)``
    gives the totals to start from in the first batch of a new query.
    """
    counts = df.groupBy(tumbling(ts, width).alias("window"), key).agg(F.count(F.lit(1)).alias("n"))
    closed = counts.select(
        F.col("window.start").alias("window_start"),
        F.col(key).alias("key"),
        key_label(F.col(key)).alias("label"),
        "n",
    )
    start = seed.select(F.col(key).alias("key"), "seed").groupBy("key") if seed is not None else None
    out = T.StructType([*closed.schema.fields, T.StructField("total", T.LongType())])
    return (
        closed.groupBy("key")
        .transformWithState(
            statefulProcessor=_WindowTotal(),
            outputStructType=out,
            outputMode="append",
            timeMode="None",
            initialState=start,
        )
        .withColumnRenamed("key", key)
    )


class _ClockWindow(StatefulProcessor):
    """Counts per window of arrival time; a timer gives a window out when the clock passes its end."""

    def __init__(self, width_ms: int) -> None:
        self._width = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getMapState("open", "start bigint", "n bigint")
        self._total = handle.getValueState("total", "total bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self._width
        n = sum(row.n for row in rows)
        if self._open.containsKey((start,)):
            n += self._open.getValue((start,))[0]
        else:
            self._handle.registerTimer(start + self._width)
        self._open.updateValue((start,), (n,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self._width
        n = self._open.getValue((start,))[0]
        self._open.removeKey((start,))
        total = n + (self._total.get()[0] if self._total.exists() else 0)
        self._total.update((total,))
        at = datetime.datetime.fromtimestamp(start / 1000, datetime.timezone.utc).replace(tzinfo=None)
        yield Row(window_start=at, key=key[0], n=n, total=total)


def _counted_in_tasks(df: DataFrame, key: str) -> DataFrame:
    """``(key, n)``: the rows of each key in an Arrow batch of a task, counted before any shuffle."""

    def run(batches):
        for batch in batches:
            yield from pa.table(batch).group_by("key").aggregate([([], "count_all")]).rename_columns(["key", "n"]).to_batches()

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key")).mapInArrow(run, f"key {kind}, n bigint")


def clock_window_count_stream(df: DataFrame, key: str, width: datetime.timedelta) -> DataFrame:
    """``(window_start, key, n, total)`` of windows of arrival time that close by the clock.

    No later row is needed to close a window: a timer does it in the first batch after its end,
    so a quiet stream gives its last windows as well. ``window_start`` is in UTC. ``total`` is the
    key's count since the start. Rows are counted in the tasks that read them, so that the
    state sees one row a key and Arrow batch, also of a hot key.
    """
    width_ms = width // datetime.timedelta(milliseconds=1)
    counted = _counted_in_tasks(df, key)
    kind = df.schema[key].dataType.simpleString()
    return (
        counted.groupBy("key")
        .transformWithState(
            statefulProcessor=_ClockWindow(width_ms),
            outputStructType=f"window_start timestamp_ntz, key {kind}, n bigint, total bigint",
            outputMode="append",
            timeMode="ProcessingTime",
        )
        .withColumnRenamed("key", key)
    )


class _UntilDelimiter(StatefulProcessor):
    """Keeps values until a delimiter comes, then gives them out together."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._items = handle.getListState("items", "item string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        waiting: list[tuple[str]] = []
        # A struct comes as a dict in field order.
        for row in sorted(rows, key=lambda r: tuple(r.place.values())):
            if not row.is_mark:
                waiting.append((row.item,))
                continue
            kept = [item for (item,) in self._items.get()] if self._items.exists() else []
            items = kept + [item for (item,) in waiting]
            self._items.clear()
            waiting = []
            if items:
                yield Row(key=row.key, n=len(items), items=" ".join(items) + " ")
        if waiting:
            self._items.appendList(waiting)


def delimiter_segments_stream(
    df: DataFrame, key: str, order: list[str], value: str, is_delimiter: Column
) -> DataFrame:
    """``(key, n, items)`` each time a key's delimiter arrives; open tails wait in state.

    Batches follow one another as they arrive, ``order`` sorts within a batch. All rows
    of one key in one batch meet one task, so bound the batch at the source
    (``files_per_trigger``); for keys that outgrow this use :class:`CarriedSegments`.
    """
    key_type = df.schema[key].dataType
    marked = df.select(
        F.col(key).alias("key"),
        F.struct(*order).alias("place"),
        F.coalesce(F.col(value).cast("string"), F.lit("null")).alias("item"),
        F.coalesce(is_delimiter, F.lit(False)).alias("is_mark"),
    )
    out = T.StructType(
        [
            T.StructField("key", key_type),
            T.StructField("n", T.IntegerType()),
            T.StructField("items", T.StringType()),
        ]
    )
    return marked.groupBy("key").transformWithState(
        statefulProcessor=_UntilDelimiter(),
        outputStructType=out,
        outputMode="append",
        timeMode="None",
    )


class CarriedSegments:
    """The same result for hot keys: a ``write`` for :func:`eventloom.streaming.each_batch`.

    A batch is cut by the table operator, which spreads a key over many tasks. Rows of open
    tails are carried to the next batch in a table. Both outputs go to a folder per batch
    id, so a batch that is run again replaces what it wrote and carries nothing twice.
    """

    def __init__(
        self,
        path: str,
        keys: list[str],
        order: list[str],
        value: str,
        is_delimiter: Column,
    ) -> None:
        self.path, self.keys, self.order = path, keys, order
        self.value, self.is_delimiter = value, is_delimiter

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        columns = list(dict.fromkeys([*self.keys, *self.order, self.value]))
        rows = batch.select(
            F.lit(batch_id).cast("bigint").alias("_batch"),
            *columns,
            F.coalesce(self.is_delimiter, F.lit(False)).alias("_delim"),
        )
        if batch_id > 0:
            carried = batch.sparkSession.read.schema(rows.schema).parquet(
                f"{self.path}/open/batch_id={batch_id - 1}"
            )
            rows = carried.unionByName(rows)
        order = ["_batch", *self.order]
        numbered = number_segments(rows, self.keys, order, F.col("_delim"))
        closed = collect_segments(numbered, self.keys, order, self.value).drop("segment")
        closed.write.mode("overwrite").parquet(f"{self.path}/closed/batch_id={batch_id}")
        still_open = numbered.where(~F.col("closed")).select(*rows.columns)
        still_open.write.mode("overwrite").parquet(f"{self.path}/open/batch_id={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All closed segments so far."""
        return spark.read.parquet(f"{self.path}/closed")
