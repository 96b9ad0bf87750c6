"""Line sources: a file, a folder, a folder as a stream, a host and port."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.session import stage_table


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value string``."""
    return spark.read.text(path)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place: ``value, file_path, line`` (from 0 in each file), and ``file``, a file's number by path.

    ``file`` and ``line`` order lines as ``file_path`` and ``line`` do and are shorter to shuffle and sort by.

    A file is read in blocks, by as many tasks as it has blocks. A line's place is its place in the
    block plus the lines of the file's earlier blocks; only one row a block is added up in order.
    Lines are staged once with the number the scan gave them, as a second scan could cut
    files into other blocks. The blocks are staged too: their measured size, not that of the
    lines, then chooses the join, so lines are not shuffled and sorted for it.
    """
    meta = F.col("_metadata")
    scanned = spark.read.text(path).select(
        "value",
        meta.file_path.alias("file_path"),
        meta.file_block_start.alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    lines = stage_table(scanned, "lines")
    blocks = lines.groupBy("file_path", "_start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.select(
        "file_path",
        "_start",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        (F.dense_rank().over(Window.orderBy("file_path")) - 1).alias("file"),
    )
    placed = lines.join(stage_table(begins, "blocks"), ["file_path", "_start"])
    return placed.select("value", "file_path", (F.col("_id") + F.col("_shift")).alias("line"), "file")


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the files directly in ``folder`` (no sub-folders), with their file.

    Columns ``value string, file_path string``.
    """
    return (
        spark.read.option("recursiveFileLookup", "false")
        .text(folder)
        .select("value", F.col("_metadata.file_path").alias("file_path"))
    )


def stream_lines(
    spark: SparkSession,
    folder: str,
    files_per_trigger: int | None = None,
    bytes_per_trigger: str | None = None,
    name_glob: str | None = None,
) -> DataFrame:
    """Lines of ``folder`` as a stream; old files first, new files as they arrive.

    ``files_per_trigger`` or ``bytes_per_trigger`` bounds one micro-batch, the pause
    between batches is the query's trigger. Which files were read is part of the
    query's checkpoint, so a restart goes on where it stopped.
    """
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    if name_glob is not None:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(folder)


def socket_lines(spark: SparkSession, host: str = "localhost", port: int | None = None) -> DataFrame:
    """Lines from a listening host and port. Cannot be replayed after a failure;
    prefer :func:`stream_lines`. The port falls back to the setting
    ``eventloom.socket.port`` and then to 50190.
    """
    if port is None:
        port = int(spark.conf.get("eventloom.socket.port", "50190"))
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
