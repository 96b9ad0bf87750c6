"""A table of keys that changes are written back to, at a cost that follows the changes.

Layout below ``path``: ``base`` (bucketed by key, one generation a folder), ``log`` (the last change
of each key, one folder a batch), ``manifest`` (one small file a version: which generation of
each bucket counts, and up to which batch the log is in it).

* Writing a batch adds its changes to the log and touches nothing else.
* ``compact`` reads the files of those buckets that have changes, by their names, and writes
  the buckets as a new generation; then a new manifest makes them count, all at once.
* Reading joins the base with the open part of the log. Both are cut by the same buckets, so the
  base is not shuffled. After ``generations`` generations all buckets are rewritten, so that reading
  does not grow with the number of batches.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.lookup import latest_dirty


class KeyedTable:
    """``(key, value)`` with one row a key; of changes the one with the largest ``seq`` counts.

    Keys are not null: changes without one are left out. ``write_back`` is a ``write`` for
    :func:`eventloom.streaming.each_batch`; a batch id that was written before replaces its own
    changes, or does nothing if it is in the base already. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, value: str, seq: str, generations: int = 8) -> None:
        self.spark, self.path, self.generations = spark, path.rstrip("/"), generations
        self.key, self.value, self.seq = key, value, seq
        self._name = f"keyed_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"

    # -- what the manifest says

    def _manifest(self) -> tuple[int, int, list[int]]:
        """(version, last batch in the base, generation of each bucket): one row a bucket."""
        rows = self.spark.read.parquet(f"{self.path}/manifest")
        last = rows.agg(F.max("version")).first()[0]
        own = sorted(rows.where(F.col("version") == last).collect(), key=lambda r: r["bucket"])
        return last, own[0]["merged"], [r["gen"] for r in own]

    def _commit(self, version: int, merged: int, gens: list[int]) -> None:
        rows = [(bucket, gen, merged) for bucket, gen in enumerate(gens)]
        out = self.spark.createDataFrame(rows, "bucket int, gen int, merged bigint").coalesce(1)
        out.write.parquet(f"{self.path}/manifest/version={version}")

    # -- writing

    def create(self, base: DataFrame, seq_type: str = "bigint", buckets: int | None = None) -> KeyedTable:
        """Write ``base(key, value)`` as the first generation.

        A bucket is read by one task: give so many that one fits into it, and no fewer than the
        session's shuffle partitions, else Spark prefers to shuffle. This is the one shuffle of the base.
        """
        n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        kinds = {f.name: f.dataType.simpleString() for f in base.schema.fields}
        rows = base.select(self.key, self.value, F.lit(None).cast(seq_type).alias(self.seq))
        rows = rows.repartition(n, self.key)
        columns = f"`{self.key}` {kinds[self.key]}, `{self.value}` {kinds[self.value]}, `{self.seq}` {seq_type}"
        self._register(columns, n)
        self._append(rows, 0)
        self._commit(0, -1, [0] * n)
        return self

    def _register(self, columns: str, n: int) -> None:
        self.spark.sql(
            f"create table if not exists {self._name} ({columns}, _gen int) using parquet "
            f"partitioned by (_gen) clustered by (`{self.key}`) into {n} buckets location '{self.path}/base'"
        )

    def _append(self, rows: DataFrame, gen: int) -> None:
        rows.withColumn("_gen", F.lit(gen)).write.mode("append").insertInto(self._name)

    def open(self) -> KeyedTable:
        """Use a table that another session has written."""
        if not self.spark.catalog.tableExists(self._name):
            gens = self._manifest()[2]
            kinds = self.spark.read.parquet(f"{self.path}/base").schema
            columns = ", ".join(f"`{c}` {kinds[c].dataType.simpleString()}" for c in (self.key, self.value, self.seq))
            self._register(columns, len(gens))
        self.spark.sql(f"msck repair table {self._name}")
        return self

    def write_back(self, batch: DataFrame, batch_id: int) -> None:
        """Log the last change of each key among the batch's rows with ``is_updated``."""
        if batch_id <= self._manifest()[1]:
            return
        latest = latest_dirty(batch.where(F.col(self.key).isNotNull()), self.key, self.value, self.seq)
        latest.write.mode("overwrite").parquet(f"{self.path}/log/batch_id={batch_id}")

    def compact(self, upto: int | None = None) -> None:
        """Move the log's batches (up to ``upto``) into the base; buckets without changes stay as they are."""
        version, merged, gens = self._manifest()
        changes = self._open_log(merged, upto)
        met = changes.agg(F.max("batch_id")).first()[0]
        if met is None:
            return
        n, gen = len(gens), 1 + max([r["_gen"] for r in self._generations()], default=0)
        bucket = F.pmod(F.hash(self.key), F.lit(n))  # as Spark deals bucketed tables
        changed = {r[0] for r in changes.select(bucket).distinct().collect()}  # one number a bucket
        if len(set(gens)) >= self.generations:
            changed = set(range(n))
        merged_rows = self._merged(self._base(gens, changed), changes)
        self._append(merged_rows, gen)
        self._commit(version + 1, met, [gen if b in changed else g for b, g in enumerate(gens)])

    # -- reading

    def _generations(self) -> list:
        return self.spark.table(self._name).select("_gen").distinct().collect()

    def _base(self, gens: list[int], buckets: set[int] | None = None) -> DataFrame:
        """The base's rows that count; of ``buckets`` only, if given, whose files alone are read."""
        held = self.spark.table(self._name).where(F.col("_gen").isin(sorted(set(gens))))
        if len(set(gens)) > 1:
            of_bucket = F.array(*[F.lit(g) for g in gens])
            held = held.where(F.get(of_bucket, F.pmod(F.hash(self.key), F.lit(len(gens)))) == F.col("_gen"))
        if buckets is not None and len(buckets) < len(gens):
            number = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)\.", 1).cast("int")
            held = held.where(number.isin(sorted(buckets)))
        return held.select(self.key, self.value, self.seq)

    def _open_log(self, merged: int, upto: int | None) -> DataFrame:
        own = self.spark.table(self._name).select(self.key, self.value, self.seq).schema.fields
        schema = T.StructType([*own, T.StructField("batch_id", T.LongType())])
        try:
            log = self.spark.read.schema(schema).parquet(f"{self.path}/log")
        except Exception as error:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(error):
                raise
            log = self.spark.createDataFrame([], schema)
        log = log.where(F.col("batch_id") > merged)
        return log if upto is None else log.where(F.col("batch_id") <= upto)

    def _merged(self, base: DataFrame, changes: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(self.value, self.seq), self.seq).alias("_new")
        latest = changes.groupBy(self.key).agg(last)
        joined = base.join(latest, self.key, "full_outer")
        newer = F.col("_new").isNotNull() & (
            F.col(self.seq).isNull() | (F.col(f"_new.{self.seq}") >= F.col(self.seq))
        )
        pick = lambda c: F.when(newer, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
        return joined.select(self.key, pick(self.value), pick(self.seq))

    def read(self, upto: int | None = None) -> DataFrame:
        """``(key, value)`` as of now, or as of batch ``upto``, which must not be compacted yet."""
        _, merged, gens = self._manifest()
        if upto is not None and upto < merged:  # -1: before any batch
            raise ValueError(f"batches up to {merged} are in the base")
        rows = self._merged(self._base(gens), self._open_log(merged, upto))
        return rows.select(self.key, self.value)

    def vacuum(self) -> None:
        """Remove generations and logs that no longer count. Not while an earlier version is read."""
        _, merged, gens = self._manifest()
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for gen in {r["_gen"] for r in self._generations()} - set(gens):
            self.spark.sql(f"alter table {self._name} drop partition (_gen = {gen})")
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/base/_gen={gen}")
            folder.getFileSystem(conf).delete(folder, True)
        log = jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
        files = log.getFileSystem(conf)
        for status in files.listStatus(log) if files.exists(log) else []:
            number = status.getPath().getName().partition("batch_id=")[2]
            if number and int(number) <= merged:
                files.delete(status.getPath(), True)


class CarriedTotals:
    """The running total at every record of a stream: a ``write`` for :func:`eventloom.streaming.each_batch`.

    Within a batch the table operator runs, which spreads a hot key over many tasks. What each
    key had before comes from a :class:`KeyedTable` of carries, to which the batch's sums are
    written back: a batch costs its own rows and keys. Batches follow one another as they come,
    ``order`` sorts within a batch. A repeated batch replaces what it wrote, from the same carries.
    Rows without key are left out.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str, key_type: str, order: list[str], value: str, compact_every: int = 10
    ) -> None:
        self.path, self.key, self.order, self.value, self.every = path.rstrip("/"), key, order, value, compact_every
        self.carries = KeyedTable(spark, f"{self.path}/carries", key, "_carry", "_batch")
        try:
            self.carries.open()
        except Exception as error:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(error):
                raise
            self.carries.create(spark.createDataFrame([], f"`{key}` {key_type}, _carry bigint"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from eventloom.operators.ordered import running_total

        rows = batch.where(F.col(self.key).isNotNull())
        before = self.carries.read(upto=batch_id - 1)
        totals = running_total(rows, [self.key], self.order, self.value, "_total")
        joined = totals.join(before, self.key, "left")
        total = (F.col("_total") + F.coalesce("_carry", F.lit(0))).alias("total")
        joined.select(*batch.columns, total).write.mode("overwrite").parquet(f"{self.path}/totals/batch_id={batch_id}")
        sums = rows.groupBy(self.key).agg(F.sum(self.value).alias("_sum")).join(before, self.key, "left")
        changed = sums.select(
            self.key,
            (F.coalesce("_sum", F.lit(0)) + F.coalesce("_carry", F.lit(0))).cast("bigint").alias("_carry"),
            F.lit(batch_id).cast("bigint").alias("_batch"),
            F.lit(True).alias("is_updated"),
        )
        if batch_id > 0 and batch_id % self.every == 0:
            self.carries.compact(upto=batch_id - 1)  # this batch stays in the log, so that it can be repeated
        self.carries.write_back(changed, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """All records so far with their totals."""
        return spark.read.parquet(f"{self.path}/totals")
