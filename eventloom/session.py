"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Run-time re-planning: small shuffles are merged, hot join partitions are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Python state processors talk to the JVM through a Unix socket, not a loopback port.
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "eventloom",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's defaults; ``conf`` wins over them.

    ``master`` and the sizing settings (shuffle partitions, memory) are left to the
    cluster unless given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where unset, one below the warehouse, which is shared too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder the cluster names in ``spark.checkpoint.dir``."""
    return f"{_shared_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application put under the shared folder; call it at the very end."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{_shared_root(spark)}/{spark.sparkContext.applicationId}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(folder, True)


@contextmanager
def short_plan_texts(spark: SparkSession, characters: int = 10_000) -> Iterator[None]:
    """Bounds the text of plans of queries that run meanwhile.

    The driver makes, keeps and logs that text at each step of a query's re-planning, with every large
    literal written out. Plans and results stay as they are.
    """
    name = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, str(characters))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage, pins values such as partition numbers that a recomputation could
    change, and lets later passes read only the columns (and with ``partition_by`` only
    the rows) they need.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
