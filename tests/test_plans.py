"""What the plans look like: pruned scans, no Python, split hot keys, no single task."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventloom import drop_scratch, scratch_path, session, stage_table
from eventloom.operators import joins, lookup, windows
from eventloom.plans import catalog

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - {"line_stream", "page_join_stream"}))
def test_no_python_no_cross_join_no_single_partition(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text
    if name not in ("lookup_hit_rate",):  # a global aggregate of partial sums
        assert "SinglePartition" not in text


def test_scans_read_only_what_is_used(spark):
    text = plan(catalog.QUERIES["sql_group_count"](spark, FOLDER))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
    text = plan(catalog.QUERIES["window_join"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in text
    text = plan(catalog.QUERIES["dirty_upsert"](spark, FOLDER))
    assert "GreaterThan(value,50.0)" in text


def test_top_k_is_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(catalog.QUERIES["sql_topk"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan(catalog.QUERIES["recent_keys_topn"](spark, FOLDER))


@pytest.mark.parametrize(
    "name",
    ["window_cogroup", "page_cogroup", "windowed_word_count", "content_totals", "dirty_upsert"],
)
def test_rows_are_aggregated_before_the_shuffle(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    assert "HashAggregate" in text and "partial_" in text
    assert "SortAggregate" not in text and "collect_list" not in text


def test_page_join_reads_each_route_alone(spark):
    text = plan(catalog.QUERIES["page_join"](spark, FOLDER))
    assert text.count("PartitionFilters: [isnotnull(route") == 2
    assert "from_json" not in text


@pytest.fixture
def shuffled_joins(spark):
    """Joins as they are for large tables: shuffled, with low limits for what is skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def hot(spark, n, shift):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500 + 10)
    return spark.range(n, numPartitions=8).select(
        "id", key.alias("k"), F.timestamp_seconds(F.col("id") % 2 + shift).cast("timestamp_ntz").alias("ts")
    )


def test_hot_join_key_is_split(spark, shuffled_joins):
    left = hot(spark, 30_000, 0)
    right = hot(spark, 300, 0)
    joined = joins.window_join(left, right, "k", "ts", "5 seconds")
    result = joined.select(F.col("l.id").alias("l"), F.col("r.id").alias("r"))
    got = Counter()
    for row in result.groupBy("r").count().collect():
        got[row.r] = row["count"]
    final = plan(result.groupBy("r").count())
    counts = Counter(7 if i % 3 == 0 else i % 500 + 10 for i in range(30_000))
    assert got == {
        i: counts[7 if i % 3 == 0 else i % 500 + 10]
        for i in range(300)
        if counts[7 if i % 3 == 0 else i % 500 + 10]
    }
    assert "BroadcastHashJoin" not in final

    stored = result.write.format("noop").mode("overwrite")
    stored.save()
    query = result._jdf.queryExecution()
    query.executedPlan().execute().count()
    assert "skew=true" in query.executedPlan().toString()


def test_hot_lookup_key_is_split(spark, shuffled_joins):
    facts = hot(spark, 60_000, 0).select("id", "k")
    known = spark.range(0, 600).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    result = lookup.enrich(facts, known, "k", ["v"])
    query = result._jdf.queryExecution()
    assert query.executedPlan().execute().count() == 60_000
    assert "skew=true" in query.executedPlan().toString()


def test_salted_join_spreads_one_group(spark, shuffled_joins):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one = spark.range(4000).select("id", F.lit(1).alias("k"), F.lit(None).alias("x")).withColumn(
            "ts", F.lit("2024-01-01").cast("timestamp_ntz")
        )
        few = one.where("id < 3")
        pairs = joins.window_join(one, few, "k", "ts", "5 seconds", salts=8)
        tasks = pairs.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert sum(t["count"] for t in tasks) == 12_000
        assert len(tasks) >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scratch_is_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    path = scratch_path(spark, "x")
    assert path.startswith(root) and scratch_path(spark, "x") != path
    staged = stage_table(spark.range(3), "x")
    assert root in staged.inputFiles()[0]


@pytest.mark.parametrize("master", ["yarn", "local-cluster[3,2,1024]", "local[2]"])
def test_scratch_is_below_the_warehouse_without_a_checkpoint_folder(master):
    class Context:
        pass

    class Conf:
        def get(self, key, default=None):
            return "hdfs://shared/warehouse" if key == "spark.sql.warehouse.dir" else default

    class Session:
        sparkContext, conf = Context(), Conf()

    Session.sparkContext.master = master
    assert session._shared_root(Session()) == "hdfs://shared/warehouse/_scratch"


def test_drop_scratch(spark, new_folder, monkeypatch):
    own = new_folder("own")
    monkeypatch.setattr(session, "_shared_root", lambda _: own)
    staged = stage_table(spark.range(3), "x")
    assert staged.count() == 3 and os.listdir(own)
    drop_scratch(spark)
    assert not os.listdir(own)


def test_window_functions_take_any_width(spark):
    df = spark.range(100).select("id", F.lit("k").alias("k"), F.timestamp_seconds("id").alias("ts"))
    for width, expected in (("2 seconds", 50), ("5 seconds", 20), ("1 minute", 2)):
        assert windows.window_counts(df, "k", "ts", width).count() == expected
