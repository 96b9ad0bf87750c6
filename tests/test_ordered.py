"""Order-dependent operators against brute force, with hot keys and any partitioning."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventloom.operators import windows
from eventloom.operators.joins import window_join
from eventloom.operators.ordered import delimiter_segments, running_total


def skewed_rows(n=3000, seed=7):
    """A third of the rows under one key and time, a third under one key, the rest spread."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice(["hot", "warm", None, *[f"k{j}" for j in range(40)]])
        second = rng.randrange(1000)
        if i % 3 == 0:
            key, second = "hot", 500
        elif i % 3 == 1:
            key = "warm"
        rows.append((i, key, second, rng.randrange(20), rng.random() < 0.05))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "id int, k string, sec int, v int, d boolean")
    return df.withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz"))


def by_key(rows):
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        groups[row[1]].append(row)
    return groups


@pytest.fixture(params=[1, 4, 16])
def shuffle_partitions(request, spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    # Keep the small partitions apart, so that keys do cross borders.
    spark.conf.set(coalesce, "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set(coalesce, "true")


def test_running_total(spark, shuffle_partitions):
    rows = skewed_rows()
    got = running_total(frame(spark, rows), ["k"], ["ts", "id"], "v")
    expected = {}
    for group in by_key(rows).values():
        total = 0
        for row in group:
            total += row[3]
            expected[row[0]] = total
    assert got.columns == ["id", "k", "sec", "v", "d", "ts", "total"]
    assert {r.id: r.total for r in got.collect()} == expected


def test_rows_without_time_are_not_lost(spark):
    df = spark.range(100).select(
        "id", F.lit(1).alias("v"), F.when(F.col("id") >= 10, F.timestamp_seconds("id")).alias("ts")
    )
    got = running_total(df, [], ["ts", "id"], "v").collect()
    assert {r.id: r.total for r in got} == {i: i + 1 for i in range(100)}


def test_keys_of_several_columns_and_kinds(spark):
    df = frame(spark, skewed_rows(600)).withColumn("day", F.to_date("ts"))
    keys = ["k", "day", "v"]
    got = running_total(df, keys, ["ts", "id"], "v").collect()
    expected, totals = {}, Counter()
    for r in sorted(df.collect(), key=lambda r: (r.ts, r.id)):
        totals[(r.k, r.day, r.v)] += r.v
        expected[r.id] = totals[(r.k, r.day, r.v)]
    assert {r.id: r.total for r in got} == expected


def test_running_total_without_key_and_with_nulls(spark, shuffle_partitions):
    df = spark.range(500).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"))
    got = running_total(df, [], ["id"], "v").collect()
    assert {r.id: r.total for r in got} == {
        i: sum(j for j in range(i + 1) if j % 2 == 0) for i in range(500)
    }


def test_hot_key_is_spread_over_partitions(spark, shuffle_partitions):
    from eventloom.operators.ordered import _cut, _with_key

    rows, names = _with_key(frame(spark, skewed_rows()), ["k"])
    placed, borders = _cut(rows, names, ["ts", "id"], "v")
    assert borders.count() <= 2 * shuffle_partitions
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert max(sizes) <= 3 * 3000 / shuffle_partitions
    assert len(sizes) >= shuffle_partitions / 2


def brute_segments(rows):
    out = Counter()
    for key, group in by_key(rows).items():
        waiting = []
        for row in group:
            if not row[4]:
                waiting.append(str(row[3]))
            elif waiting:
                out[(key, len(waiting), " ".join(waiting) + " ")] += 1
                waiting = []
    return out


def test_delimiter_segments(spark, shuffle_partitions):
    rows = skewed_rows()
    got = delimiter_segments(frame(spark, rows), ["k"], ["ts", "id"], "v", F.col("d"))
    assert Counter((r.k, r.n, r["items"]) for r in got.collect()) == brute_segments(rows)


def test_long_open_tail_is_not_emitted(spark, shuffle_partitions):
    rows = [(i, "k", i, i, i in (0, 3)) for i in range(1000)]
    got = delimiter_segments(frame(spark, rows), ["k"], ["ts", "id"], "v", F.col("d")).collect()
    assert [(r.segment, r.n, r["items"]) for r in got] == [(1, 2, "1 2 ")]


def test_segment_over_many_partitions(spark, shuffle_partitions):
    rows = [(i, "k", i, i, i == 999) for i in range(1000)]
    got = delimiter_segments(frame(spark, rows), ["k"], ["ts", "id"], "v", F.col("d")).collect()
    text = " ".join(str(i) for i in range(999)) + " "
    assert [(r.segment, r.n, r["items"]) for r in got] == [(0, 999, text)]


def test_total_per_window_is_the_largest_running_total(spark, shuffle_partitions):
    df = frame(spark, skewed_rows()).where(F.col("k").isNotNull())
    per_window = windows.running_total_per_window(df, "k", "ts", "5 seconds", "v")
    running = running_total(df.select("id", "k", "ts", "v"), ["k"], ["ts", "id"], "v")
    largest = running.groupBy(F.window("ts", "5 seconds").alias("w"), "k").agg(F.max("total").alias("m"))
    expected = {(r.w.start, r.k): r.m for r in largest.collect()}
    assert {(r.window_start, r.k): r.total for r in per_window.collect()} == expected


@pytest.mark.parametrize("salts", [1, 5])
def test_window_join_brute_force(spark, shuffle_partitions, salts):
    rows = [r for r in skewed_rows(600) if r[1] is not None]
    df = frame(spark, rows)
    left, right = df.where("not d").select("id", "k", "ts"), df.where("d").select("id", "k", "ts")
    got = window_join(left, right, "k", "ts", "5 seconds", salts=salts)
    expected = Counter(
        (a[0], b[0])
        for a in rows
        for b in rows
        if not a[4] and b[4] and a[1] == b[1] and a[2] // 5 == b[2] // 5
    )
    assert Counter((r.l.id, r.r.id) for r in got.collect()) == expected
