"""Streams against the same operator on a table, and across restarts."""

import datetime
import itertools
import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventloom.operators import joins, windows
from eventloom.plans import jobs
from eventloom.sources import keyword_rows, keyword_stream, read_folder, read_lines, stream_lines
from eventloom.streaming import (
    console_sink,
    cumulative_window_count_stream,
    delimiter_segments_stream,
    each_record,
    file_sink,
    run_to_end,
    running_totals_stream,
)
from eventloom.streaming.sinks import batch_folder, change_log, read_upserted
from eventloom.streaming.stateful import CarriedSegments
from tests_data import CONTENT, PAGES

SCHEMA = "id bigint, sec bigint, k string, v bigint"


WRITTEN = itertools.count(int(time.time()) - 10_000)


def put(folder, name, texts):
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write("".join(f"{t}\n" for t in texts))
    # The stream takes files in the order of their times: a second apart, one by one.
    second = next(WRITTEN)
    os.utime(path, (second, second))


def put_rows(folder, name, rows):
    put(folder, name, [f"{i},{sec},{k},{v}" for i, sec, k, v in rows])


def csv_stream(spark, folder, files=None):
    reader = spark.readStream.schema(SCHEMA)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return timed(reader.csv(folder))


def csv_table(spark, folder):
    return timed(spark.read.schema(SCHEMA).csv(folder))


def timed(df):
    return windows.with_event_time(df.withColumn("ts", F.timestamp_seconds("sec")), "ts")


def wait(query):
    query.awaitTermination()
    assert query.exception() is None


def collected(df):
    return Counter(tuple(r) for r in df.collect())


def test_lines_and_folder(spark, new_folder):
    folder = new_folder("lines")
    put(folder, "one.log", ["a b", "", "c"])
    put(folder, "two.log", ["d"])
    os.mkdir(os.path.join(folder, "inner"))
    put(os.path.join(folder, "inner"), "three.log", ["not read"])
    rows = read_folder(spark, folder).collect()
    assert sorted((r.value, r.file_path.rsplit("/", 1)[1]) for r in rows) == [
        ("", "one.log"),
        ("a b", "one.log"),
        ("c", "one.log"),
        ("d", "two.log"),
    ]
    assert [r.value for r in read_lines(spark, f"{folder}/one.log").collect()] == ["a b", "", "c"]
    streamed = run_to_end(stream_lines(spark, folder, files_per_trigger=1), "lines")
    assert sorted(r.value for r in streamed.collect()) == ["", "a b", "c", "d"]
    one = run_to_end(stream_lines(spark, folder, name_glob="two*"), "lines")
    assert [r.value for r in one.collect()] == ["d"]


def test_missing_path_fails(spark, new_folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_lines(spark, new_folder("none") + "/absent")


def test_line_stream_goes_on_after_restart(spark, new_folder):
    folder, out, state = new_folder("in"), new_folder("out"), new_folder("state")
    put(folder, "1.log", ["a", "b"])
    wait(file_sink(stream_lines(spark, folder), out, state))
    put(folder, "2.log", ["c"])
    wait(file_sink(stream_lines(spark, folder), out, state))
    wait(file_sink(stream_lines(spark, folder), out, state))
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_console_sink(spark, new_folder):
    folder = new_folder("in")
    put(folder, "1.log", ["printed"])
    query = console_sink(stream_lines(spark, folder), new_folder("state"))
    wait(query)
    assert query.lastProgress["numInputRows"] == 1


def test_keyword_stream_is_replayable(spark, new_folder):
    stream = keyword_stream(spark, list("abcdefgh"), rows_per_batch=8, start_millis=0)
    out, state = new_folder("out"), new_folder("state")
    for _ in range(2):
        query = file_sink(stream, out, state, every="0 seconds")
        while not query.recentProgress or query.recentProgress[-1]["batchId"] < 1:
            if query.exception():
                raise query.exception()
            query.awaitTermination(0.2)
        query.stop()
    rows = sorted((r.n, r.keyword) for r in spark.read.parquet(out).collect())
    assert len(rows) >= 16
    assert rows == [(n, "abcdefgh"[n % 8]) for n in range(len(rows))]


ROWS = [
    (i, [1, 2, 3, 4, 6, 7, 8, 11, 12, 14, 15, 16, 17, 21, 22, 26][i % 16] + 30 * (i // 16), k, i % 5)
    for i, k in enumerate("abacabadcabbacad" * 4)
]


def closed(table, seconds):
    """The windows that a watermark at the latest event has closed."""
    last = max(sec for _, sec, _, _ in ROWS)
    limit = datetime.datetime.fromtimestamp(last, datetime.UTC).replace(tzinfo=None)
    width = datetime.timedelta(seconds=seconds)
    return [r for r in table.collect() if naive(r.window_start) + width <= limit]


def naive(t):
    return t if t.tzinfo is None else t.astimezone(datetime.UTC).replace(tzinfo=None)


def test_window_aggregates_stream_equals_table(spark, new_folder):
    folder = new_folder("in")
    for i in range(4):
        put_rows(folder, f"{i}.csv", ROWS[16 * i : 16 * i + 16])

    def sums(df):
        return windows.windowed_sum(df, "k", "ts", "5 seconds", "v")

    def best(df):
        return windows.window_max_by(df, "k", "ts", "5 seconds", "v", ["ts", "id"])

    for build in (sums, best):
        table = build(csv_table(spark, folder))
        expected = Counter(tuple(r) for r in closed(table, 5))
        assert len(expected) > 30
        assert collected(run_to_end(build(csv_stream(spark, folder, 1)), "win")) == expected


def test_word_count_stream(spark, new_folder):
    folder = new_folder("in")
    put(folder, "1.log", ["to be or", "not  to be "])

    def count(lines):
        ts = windows.with_event_time(
            lines.withColumn("ts", F.lit("2024-01-01 00:00:00")), "ts"
        )
        return jobs.word_counts(ts)

    table = {r.word: r.total for r in count(read_lines(spark, folder)).collect()}
    assert table == {"to": 2, "be": 2, "or": 1, "not": 1, "": 1}
    query = (
        count(stream_lines(spark, folder))
        .writeStream.format("memory")
        .queryName("words")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    wait(query)
    assert {r.word: r.total for r in spark.table("words").collect()} == table


def test_running_totals_stream(spark, new_folder):
    folder = new_folder("in")
    put_rows(folder, "1.csv", ROWS[:20])
    put_rows(folder, "2.csv", ROWS[20:])
    query = (
        running_totals_stream(csv_stream(spark, folder, 1), "k", "v")
        .writeStream.format("memory")
        .queryName("totals")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    wait(query)
    rows = spark.table("totals").collect()
    assert len(rows) == 8
    expected = Counter()
    for _, _, k, v in ROWS:
        expected[k] += v
    assert {k: max(r.total for r in rows if r.k == k) for k in expected} == dict(expected)


@pytest.mark.parametrize("salts", [1, 3])
def test_window_join_stream(spark, new_folder, salts):
    left, right = new_folder("l"), new_folder("r")
    put_rows(left, "1.csv", ROWS[:40])
    put_rows(right, "1.csv", ROWS[20:])

    def join(a, b):
        pairs = joins.window_join(a, b, "k", "ts", "5 seconds", salts=salts)
        return pairs.select("k", F.col("l.id").alias("l"), F.col("r.id").alias("r"))

    expected = collected(join(csv_table(spark, left), csv_table(spark, right)))
    assert len(expected) > 20
    got = run_to_end(join(csv_stream(spark, left), csv_stream(spark, right)), "join")
    assert collected(got) == expected


def test_page_jobs_stream(spark, new_folder):
    folder = new_folder("in")
    put(folder, "1.log", PAGES.values())
    joined = run_to_end(jobs.join_pages(stream_lines(spark, folder)), "pages")
    expected = jobs.join_pages(read_lines(spark, folder))
    assert collected(joined) == collected(expected)
    assert sum(collected(joined).values()) == 2

    query = (
        jobs.cogroup_pages(stream_lines(spark, folder))
        .writeStream.format("memory")
        .queryName("groups")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    wait(query)
    groups = spark.table("groups").collect()
    assert sorted((r.key, r.n_left, r.n_right) for r in groups) == [
        ("P1", 1, 2),
        ("P2", 0, 1),
        ("P9", 1, 0),
    ]


def test_cogroup_stream_equals_table(spark, new_folder):
    left, right = new_folder("l"), new_folder("r")
    for i in range(4):
        put_rows(left, f"{i}.csv", [r for r in ROWS[16 * i : 16 * i + 16] if r[3] < 4])
        put_rows(right, f"{i}.csv", [r for r in ROWS[16 * i : 16 * i + 16] if r[3] > 1])

    def group(a, b):
        aggs = [F.sum("l.v").alias("sl"), F.max("r.id").alias("mr")]
        return joins.window_cogroup(a, b, "k", "ts", "5 seconds", aggs)

    table = group(csv_table(spark, left), csv_table(spark, right))
    expected = Counter(tuple(r) for r in closed(table, 5))
    got = collected(run_to_end(group(csv_stream(spark, left, 4), csv_stream(spark, right, 4)), "g"))
    # Both inputs end at the same second or earlier, so the slower one sets the watermark.
    assert got and not got - Counter(tuple(r) for r in table.collect())
    assert len(expected) - len(got) <= 4


def test_cumulative_count_goes_on_after_restart(spark, new_folder):
    folder, out, state = new_folder("in"), new_folder("out"), new_folder("state")

    def run():
        counts = cumulative_window_count_stream(csv_stream(spark, folder), "k", "ts", "5 seconds")
        wait(file_sink(counts, out, state))

    for i in range(4):
        put_rows(folder, f"{i}.csv", ROWS[16 * i : 16 * i + 16])
        run()
    table = windows.cumulative_window_count(csv_table(spark, folder), "k", "ts", "5 seconds")
    expected = Counter((r.window_start, r.k, f"({r.k})", r.n, r.total) for r in closed(table, 5))
    assert collected(spark.read.parquet(out)) == expected


def test_cumulative_count_from_seed(spark, new_folder):
    folder = new_folder("in")
    put_rows(folder, "1.csv", ROWS)
    seed = spark.createDataFrame([("a", 100), ("z", 5)], "k string, seed bigint")
    counts = cumulative_window_count_stream(
        csv_stream(spark, folder), "k", "ts", "5 seconds", seed=seed
    )
    table = windows.cumulative_window_count(
        csv_table(spark, folder), "k", "ts", "5 seconds", seed=seed
    )
    expected = Counter((r.window_start, r.k, f"({r.k})", r.n, r.total) for r in closed(table, 5))
    assert max(r[4] for r in expected) > 100
    assert collected(run_to_end(counts, "seeded")) == expected


def test_content_totals_stream(spark, new_folder):
    folder = new_folder("in")
    put(folder, "1.log", [f"00:00:01|{line}" for line in CONTENT])
    put(folder, "2.log", [f"00:00:06|{CONTENT[0]}", f"00:00:11|{CONTENT[1]}"])

    def totals(lines):
        parts = lines.select(
            F.concat(F.lit("2024-01-01 "), F.substring_index("value", "|", 1)).alias("ts"),
            F.substring_index("value", "|", -1).alias("value"),
        )
        return jobs.content_totals(windows.with_event_time(parts, "ts"))

    # The last line has no video, but its time closes the second window.
    streamed = run_to_end(totals(stream_lines(spark, folder)), "content").collect()
    assert sorted((r.ctype, naive(r.window_start).second, r.total) for r in streamed) == [
        ("1", 0, 2),
        ("1", 5, 4),
        ("2", 0, 1),
        ("2", 5, 2),
    ]
    table = totals(read_lines(spark, folder)).collect()
    assert sorted((r.ctype, r.window_start.second, r.total) for r in table) == [
        ("1", 0, 2),
        ("1", 5, 4),
        ("2", 0, 1),
        ("2", 5, 2),
    ]


def test_keyword_counts_across_restarts(spark, new_folder):
    words = list("abcdefgh")
    rows = keyword_rows(spark.range(16), "id", words)
    timed_rows = rows.withColumn("ts", F.timestamp_seconds("n").cast("timestamp_ntz"))
    table = jobs.keyword_counts(timed_rows).collect()
    assert collected_last(table) == {f"({w})": 2 for w in words}

    out, state = new_folder("out"), new_folder("state")
    for last_batch in (2, 5):
        stream = keyword_stream(spark, words, rows_per_batch=8, millis_per_batch=2000)
        counts = jobs.keyword_counts(windows.with_event_time(stream, "ts"))
        query = file_sink(counts, out, state, every="0 seconds")
        while not query.recentProgress or query.recentProgress[-1]["batchId"] < last_batch:
            query.awaitTermination(0.2)
        query.stop()
    seen = spark.read.parquet(out).collect()
    # Every keyword comes once per window: its totals are 1, 2, 3, ... without a gap.
    for word in words:
        totals = sorted(r.total for r in seen if r.label == f"({word})")
        assert totals == list(range(1, len(totals) + 1)) and len(totals) >= 2


def collected_last(rows):
    last = {}
    for r in rows:
        last[r.label] = max(r.total, last.get(r.label, 0))
    return last


def test_each_record(spark, new_folder):
    # Defined here to be sent to the workers by value.
    class FileWriter:
        """Keeps the rows of one partition and batch in one file, written when it closes."""

        def __init__(self, folder):
            self.folder = folder

        def open(self, partition_id, batch_id):
            self.path, self.rows = f"{self.folder}/{batch_id}-{partition_id}", []
            return True

        def process(self, row):
            self.rows.append(row.value)

        def close(self, error):
            if error is None:
                with open(self.path, "w") as out:
                    out.write("\n".join(self.rows))

    folder, out = new_folder("in"), new_folder("out")
    put(folder, "1.log", ["a", "b"])
    put(folder, "2.log", ["c"])
    wait(each_record(stream_lines(spark, folder), FileWriter(out), new_folder("state"), every=None))
    got = []
    for name in os.listdir(out):
        with open(os.path.join(out, name)) as file:
            got += file.read().split("\n")
    assert sorted(line for line in got if line) == ["a", "b", "c"]


SEQUENCE = [12, 40, 1, 33, 52, 1, 25, 60, 18, 77, 1]
SEGMENTS = Counter([("s", 2, "12 40 "), ("s", 2, "33 52 "), ("s", 4, "25 60 18 77 ")])


def sequence_files():
    rows = [(i, i, "s", v) for i, v in enumerate(SEQUENCE)]
    return [list(reversed(rows[:5])), list(reversed(rows[5:9])), list(reversed(rows[9:]))]


def test_delimiter_segments_go_on_after_restart(spark, new_folder):
    folder, out, state = new_folder("in"), new_folder("out"), new_folder("state")
    for i, part in enumerate(sequence_files()):
        put_rows(folder, f"{i}.csv", part)
        segments = delimiter_segments_stream(
            csv_stream(spark, folder), "k", ["id"], "v", F.col("v") == 1
        )
        wait(file_sink(segments, out, state))
    assert collected(spark.read.parquet(out)) == SEGMENTS


def test_carried_segments(spark, new_folder):
    write = CarriedSegments(new_folder("seg"), ["k"], ["id"], "v", F.col("v") == 1)
    for i, part in enumerate(sequence_files()):
        batch = spark.createDataFrame(part, SCHEMA)
        write(batch, i)
        write(batch, i)  # handed over again after a failure
    got = write.read(spark).select("k", "n", "items")
    assert collected(got) == SEGMENTS


def test_change_log_is_idempotent(spark, new_folder):
    log = new_folder("log") + "/changes"
    write = change_log(log, "key", "value", "seq")
    columns = "key string, value int, seq bigint, is_updated boolean"
    first = spark.createDataFrame([("a1", 5, 1, True), ("a1", 7, 2, True)], columns)
    second = spark.createDataFrame([("a2", 9, 3, False), ("a3", 4, 4, True)], columns)
    for batch_id, batch in ((0, first), (1, second), (1, second)):
        write(batch, batch_id)
    base = spark.createDataFrame([("a1", 1), ("a4", 2)], "key string, value int")
    rows = read_upserted(base, log, "key", "value", "seq").collect()
    assert sorted(tuple(r) for r in rows) == [("a1", 7), ("a3", 4), ("a4", 2)]


def test_batch_folder_replaces_by_id(spark, new_folder):
    path = new_folder("batches") + "/out"
    write = batch_folder(path)
    for batch_id in (0, 1, 1):
        write(spark.range(3), batch_id)
    assert spark.read.parquet(path).count() == 6
