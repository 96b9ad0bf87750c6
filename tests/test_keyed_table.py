"""Write-back into a bucketed table, and totals carried from batch to batch."""

import os
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators.lookup import upsert
from eventloom.operators.ordered import running_total
from eventloom.streaming.keyed_table import CarriedTotals, KeyedTable

CHANGES = "key bigint, value double, seq bigint, is_updated boolean"


def changes(spark, seed, keys, n=40):
    rng = random.Random(seed)
    rows = [(rng.choice(keys), rng.random() if rng.random() < 0.9 else None, seed * 1000 + i, rng.random() < 0.7) for i in range(n)]
    return spark.createDataFrame(rows, CHANGES)


def files(path):
    return {f for d, _, names in os.walk(f"{path}/base") for f in names if f.endswith(".parquet") and not f.startswith(".")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(k, k / 2) for k in range(500)], "key bigint, value double")


def test_equals_upsert_over_twenty_batches(spark, new_folder, base):
    path = new_folder("keyed")
    table = KeyedTable(spark, path, "key", "value", "seq", generations=3).create(base, buckets=8)
    everything = changes(spark, 0, range(550))
    table.write_back(everything, 0)
    for i in range(1, 21):
        batch = changes(spark, i, range(0, 900, 7))
        everything = everything.unionByName(batch)
        table.write_back(batch, i)
        if i % 4 == 0:
            table.compact()
            table.write_back(changes(spark, 77, range(9)), i)  # a batch that is in the base changes nothing
            table.write_back(changes(spark, 78, range(9)), 1)
        if i % 7 == 0:
            expected = upsert(base, everything, "key", "value", "seq")
            assert sorted(map(tuple, table.read().collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    assert len(set(table._manifest()[2])) <= 3
    table.vacuum()
    assert os.listdir(f"{path}/log") == []
    reopened = KeyedTable(spark.newSession(), path, "key", "value", "seq").open()
    assert reopened.read().count() == table.read().count() == upsert(base, everything, "key", "value", "seq").count()


def test_repeated_batch_replaces_itself(spark, new_folder, base):
    table = KeyedTable(spark, new_folder("keyed"), "key", "value", "seq").create(base, buckets=8)
    one = spark.createDataFrame([(1, 10.0, 5, True), (2, 20.0, 6, False), (None, 1.0, 7, True)], CHANGES)
    table.write_back(one, 0)
    table.write_back(one, 0)
    got = dict(table.read().collect())
    assert got[1] == 10.0 and got[2] == 1.0 and None not in got and len(got) == 500
    # A later batch with an older change does not undo a newer one, compacted or not.
    for compact in (False, True):
        if compact:
            table.compact()
        table.write_back(spark.createDataFrame([(1, 9.0, 4, True)], CHANGES), 1)
        assert dict(table.read().collect())[1] == 10.0


def test_only_changed_buckets_are_read_and_written(spark, new_folder, base):
    path = new_folder("keyed")
    table = KeyedTable(spark, path, "key", "value", "seq").create(base, buckets=8)
    before = files(path)
    table.write_back(spark.createDataFrame([(3, 1.0, 1, True)], CHANGES), 0)
    assert files(path) == before
    bucket = spark.range(1).select(F.pmod(F.hash(F.lit(3).cast("bigint")), F.lit(8))).first()[0]
    read = table._base([0] * 8, {bucket}).select(F.col("key")).inputFiles()
    held = table._base([0] * 8, {bucket})
    assert held.select(F.pmod(F.hash("key"), F.lit(8))).distinct().collect() == [(bucket,)] and read
    table.compact()
    new = files(path) - before
    assert len(new) == 1 and f"_{bucket:05d}." in new.pop()
    metrics = table._manifest()
    assert metrics[1] == 0 and sorted(set(metrics[2])) == [0, 1] and metrics[2].count(1) == 1


def test_the_base_is_not_shuffled(spark, new_folder, base):
    table = KeyedTable(spark, new_folder("keyed"), "key", "value", "seq").create(base, buckets=8)
    table.write_back(changes(spark, 1, range(600), n=500), 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(table.read())
        at = text.index("FileScan parquet spark_catalog")
        above = text[:at].rstrip().split("\n")
        assert "Bucketed: true" in text
        side = []  # the operators between the join and the base's scan
        for line in reversed(above):
            if "SortMergeJoin" in line:
                break
            side.append(line)
        assert side and not any("Exchange" in line for line in side)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_carried_totals_equal_the_table(spark, new_folder):
    rng = random.Random(4)
    rows = [(i, rng.choice(["hot"] * 5 + ["a", "b", None]), rng.randrange(-5, 9)) for i in range(600)]
    schema = "id bigint, k string, v bigint"
    path = new_folder("carried")
    carried = CarriedTotals(spark, path, "k", "string", ["id"], "v", compact_every=2)
    for b in range(6):
        if b == 3:
            carried = CarriedTotals(spark, path, "k", "string", ["id"], "v", compact_every=2)  # restarted
        batch = spark.createDataFrame(rows[b * 100 : b * 100 + 100], schema).repartition(4)
        carried(batch, b)
        if b in (2, 4):
            carried(batch, b)  # handed over again
    whole = spark.createDataFrame([r for r in rows if r[1]], schema)
    expected = running_total(whole, ["k"], ["id"], "v")
    got = carried.read(spark).select("id", "k", "v", "total")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
