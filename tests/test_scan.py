"""Scans with any associative function, and the places of lines, against plain loops."""

import os
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import ordered, windows
from eventloom.sources import read_positions


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(rng.choice(["hot"] * 6 + ["a", "b", None]), i, rng.choice([None, rng.randrange(-9, 9)]), rng.choice("xyz")) for i in range(6000)]
    rng.shuffle(out)
    return out


def plain(rows, combine, column):
    held, out = {}, {}
    for row in sorted(rows, key=lambda r: r[1]):
        value = row[column]
        held[row[0]] = combine(held[row[0]], value) if row[0] in held else value
        out[row[1]] = held[row[0]]
    return out


def known_max(a, b):
    return b if a is None else a if b is None else max(a, b)


CASES = {
    "maximum": ("v", 2, lambda a, b: F.greatest(a, b), known_max),
    "last known": ("v", 2, lambda a, b: F.coalesce(b, a), lambda a, b: a if b is None else b),
    "sum": ("v", 2, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), lambda a, b: (a or 0) + (b or 0)),
    "last three letters": ("s", 3, lambda a, b: F.right(F.concat(a, b), F.lit(3)), lambda a, b: (a + b)[-3:]),
}


@pytest.mark.parametrize("rows_per_part", [1, 1 << 10, 1 << 24])
@pytest.mark.parametrize("name", CASES)
def test_running_reduce(spark, rows, name, rows_per_part):
    column, at, combine, own = CASES[name]
    df = spark.createDataFrame(rows, "k string, t bigint, v bigint, s string").repartition(5)
    got = ordered.running_reduce(df, ["k"], ["t"], column, combine, "out", rows_per_part).collect()
    assert len(got) == len(rows)
    assert {r["t"]: r["out"] for r in got} == plain(rows, own, at)


def test_running_reduce_without_key_and_on_nothing(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(2000)], "t bigint, v bigint").repartition(6)
    got = {r["t"]: r["m"] for r in ordered.running_reduce(df, [], ["t"], "v", lambda a, b: F.greatest(a, b), "m").collect()}
    assert got == {i: min(i, 6) for i in range(2000)}
    assert ordered.running_reduce(df.limit(0), [], ["t"], "v", lambda a, b: a + b).count() == 0


def test_negative_values_with_an_order(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:01", 1, 3), ("a", "2024-01-01 00:00:02", 2, -5)], "k string, t string, i bigint, v bigint")
    timed = windows.with_event_time(df, "t")
    assert windows.running_total_per_window(timed, "k", "t", "5 seconds", "v", order=["i"]).first()["total"] == 3


def test_line_positions_over_many_blocks(spark, new_folder):
    folder, rng = new_folder("lines"), random.Random(3)
    for n in range(3):
        with open(os.path.join(folder, f"f{n}.txt"), "w") as out:
            out.write("".join(f"{n}-{i}-{'x' * rng.randrange(40)}\n" for i in range(3000)))
    open(os.path.join(folder, "empty.txt"), "w").close()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = read_positions(spark, folder).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(got) == 9000
    assert all(r["value"].startswith(f"{r['file_path'][-5]}-{r['line']}-") for r in got)
