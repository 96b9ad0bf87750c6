"""Where streams end. Each sink takes a checkpoint folder, from which a restart goes on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventloom.operators.lookup import latest_dirty, upsert
from eventloom.session import scratch_path


def _trigger(writer, every: str | None):
    # Without an interval: everything that is there now, in bounded batches, then stop.
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def console_sink(
    df: DataFrame, checkpoint: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Print every batch. For looking at small streams: rows pass through the driver."""
    writer = df.writeStream.format("console").option("truncate", "false").outputMode(mode)
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()


def file_sink(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None, fmt: str = "parquet"
) -> StreamingQuery:
    """Append to files, each row exactly once also across restarts."""
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path)
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()


def each_batch(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "20 seconds",
    mode: str = "append",
) -> StreamingQuery:
    """Hand every micro-batch to ``write(batch, batch_id)``.

    After a failure a batch can be handed over again with the same id, so ``write`` has to
    replace by id, as :func:`batch_folder` and :func:`change_log` do.
    """
    writer = df.writeStream.foreachBatch(write).outputMode(mode)
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()


def each_record(
    df: DataFrame, writer: object, checkpoint: str, every: str | None = "20 seconds"
) -> StreamingQuery:
    """Hand single rows to ``writer`` in the executors.

    ``writer`` has ``open(partition_id, batch_id)``, ``process(row)`` and ``close(error)``.
    A repeated batch comes with the same two numbers. For tables and files prefer
    :func:`each_batch`: rows then stay in the JVM.
    """
    stream = df.writeStream.foreach(writer).option("checkpointLocation", checkpoint)
    return _trigger(stream, every).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were dropped by the stateful steps of ``query`` so far.

    A join drops a late row once, on its side. A batch drops by the watermark that the batch before it
    worked with, so a row is kept for one batch longer than the delay says. Counted over the progress reports that the
    session keeps (``spark.sql.streaming.numRecentProgressUpdates``); a report with data in it
    is made for every batch.
    """
    batches = {progress["batchId"]: progress for progress in query.recentProgress}
    return sum(int(op["numRowsDroppedByWatermark"]) for p in batches.values() for op in p["stateOperators"])


def dropped_counts(query: StreamingQuery) -> dict[str, int]:
    """Sums of the counts that :func:`eventloom.operators.watch.counting` put into a stream."""
    sums: dict[str, int] = {}
    for progress in {p["batchId"]: p for p in query.recentProgress}.values():
        for row in (progress["observedMetrics"] or {}).values():
            for name, n in (row.asDict() if hasattr(row, "asDict") else dict(row)).items():
                sums[name] = sums.get(name, 0) + int(n)
    return sums


def run_to_end(df: DataFrame, name: str, refuse_late: bool = False) -> DataFrame:
    """Run a stream over all that its source holds now; the appended rows as a table.

    ``refuse_late`` fails if rows came behind the watermark, as the result would lack them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    query = file_sink(df, path, scratch_path(spark, f"{name}-checkpoint"))
    query.awaitTermination()
    if refuse_late and (late := late_rows(query)):
        raise RuntimeError(f"{late} rows came later than the stream's delay covers")
    return spark.read.schema(df.schema).parquet(path)


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A ``write`` that keeps each batch in a folder of its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def change_log(path: str, key: str, value: str, seq: str) -> Callable[[DataFrame, int], None]:
    """A ``write`` for dirty rows: the last change per key and batch goes to a log.

    A batch costs what it changes, whatever the size of the table it changes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest = latest_dirty(batch, key, value, seq)
        latest.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_upserted(base: DataFrame, log: str, key: str, value: str, seq: str) -> DataFrame:
    """``base`` with all logged changes written back."""
    spark: SparkSession = base.sparkSession
    changes = spark.read.parquet(log).withColumn("is_updated", F.lit(True))
    return upsert(base, changes, key, value, seq)
