"""What jobs drop is counted in the same pass, late rows are named, and windows close by the clock."""

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F

from eventloom.operators import joins, windows
from eventloom.operators.watch import Watch
from eventloom.plans import jobs
from eventloom.sources import read_lines, stream_lines
from eventloom.streaming import clock_window_count_stream, dropped_counts, file_sink, late_rows
from test_streaming import put


def page(path, cards, at="2024-05-01 10:00:00"):
    return json.dumps({"header": {"fileTime": at, "contentsTime": at, "fileContents": path}, "body": {"cards": cards}})


LINES = [
    page("x/NAV.json", [{"id": "P1"}, {"title": "no id"}, {"title": "none either"}]),
    page("x/P1.json", [{"id": "c"}]),
    page("x/plain", [{"id": "c"}, {"id": "d"}]),
    page("x/P2.json", [{"id": "c"}], at="no time"),
    '{"header":{}}',
    "{bad",
    "also bad",
]
COUNTS = {
    "lines": 7,
    "bad_lines": 2,
    "records_without_route": 1,
    "pages_without_key": 1,
    "nav_cards_without_id": 2,
    "page_cards_without_page": 2,
    "cards_without_time": 1,
}


def test_counts_on_a_table(spark, new_folder):
    folder = new_folder("log")
    put(folder, "a.txt", LINES)
    for job in (jobs.page_cards, jobs.cogroup_pages, jobs.join_pages):
        watch = Watch()
        out = job(read_lines(spark, folder), watch=watch)
        out.collect()
        assert watch.counts() == COUNTS


def test_counts_on_a_stream(spark, new_folder):
    folder = new_folder("log")
    for i in range(3):
        put(folder, f"{i}.txt", LINES)
    cards = jobs.page_cards(stream_lines(spark, folder, files_per_trigger=1), watch=Watch())
    query = file_sink(cards, new_folder("out"), new_folder("checkpoint"))
    query.awaitTermination()
    assert dropped_counts(query) == {k: 3 * n for k, n in COUNTS.items()}
    with pytest.raises(ValueError):
        jobs.join_pages(stream_lines(spark, folder), watch=Watch())


def test_late_rows_of_a_join_are_named_and_counted(spark, new_folder):
    folder = new_folder("log")

    def rows(*events):
        return [json.dumps({"id": i, "side": side, "k": k, "ts": f"2024-05-01 10:{ts}"}) for i, side, k, ts in events]

    put(folder, "0.txt", rows((1, "l", "a", "00:01"), (2, "r", "a", "00:02")))
    put(folder, "1.txt", rows((3, "l", "a", "05:00"), (4, "r", "a", "05:01")))
    # Rows are dropped by the watermark that the batch before them worked with, so not yet in this one.
    put(folder, "2.txt", rows((7, "l", "a", "05:02")))
    put(folder, "3.txt", rows((5, "l", "a", "00:03"), (6, "r", "a", "04:59")))
    put(folder, "4.txt", rows((8, "l", "b", "09:00"), (9, "r", "b", "09:00"), (10, "r", "a", "00:00")))
    lines = stream_lines(spark, folder, files_per_trigger=1)
    parsed = lines.select(F.from_json("value", "id int, side string, k string, ts string").alias("e")).select("e.*")
    timed = windows.with_event_time(parsed, "ts", "10 seconds")
    sides = [timed.where(F.col("side") == s).select("id", "k", "ts") for s in "lr"]
    pairs = joins.window_join(*sides, "k", "ts", "5 seconds").select(F.col("l.id").alias("l"), F.col("r.id").alias("r"))
    out = new_folder("out")
    query = file_sink(pairs, out, new_folder("checkpoint"))
    query.awaitTermination()
    got = sorted(map(tuple, spark.read.schema("l int, r int").parquet(out).collect()))
    assert got == [(1, 2), (3, 4), (7, 4), (8, 9)]
    assert late_rows(query) == 2  # rows 5 and 10; 6 is within the delay, without a partner


def test_windows_close_by_the_clock(spark, new_folder):
    folder, out = new_folder("log"), new_folder("out")
    put(folder, "0.txt", ["a", "b", "a"])
    counts = clock_window_count_stream(stream_lines(spark, folder), "value", datetime.timedelta(seconds=2))
    query = file_sink(counts, out, new_folder("checkpoint"), every="500 milliseconds")
    try:
        until = time.time() + 90
        got = []
        while time.time() < until and len(got) < 2:  # no further row comes
            time.sleep(0.5)
            got = spark.read.schema(counts.schema).parquet(out).collect()
        assert sorted((r["value"], r["n"], r["total"]) for r in got) == [("a", 2, 2), ("b", 1, 1)]
        put(folder, "1.txt", ["a"])
        while time.time() < until and len(got) < 3:
            time.sleep(0.5)
            got = spark.read.schema(counts.schema).parquet(out).collect()
        assert sorted((r["value"], r["n"], r["total"]) for r in got) == [("a", 1, 3), ("a", 2, 2), ("b", 1, 1)]
        assert all(r["window_start"].second % 2 == 0 and r["window_start"].microsecond == 0 for r in got)
    finally:
        query.stop()
