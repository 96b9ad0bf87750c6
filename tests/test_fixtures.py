"""Small inputs with results worked out by hand."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from eventloom.operators import flatten, lookup, parse, windows
from eventloom.operators.ordered import delimiter_segments, running_total
from eventloom.operators.relational import group_count, register_table
from eventloom.operators.routing import NAV, select_route, write_routes
from eventloom.plans import jobs
from eventloom.sources import keyword_rows
from tests_data import CONTENT, PAGES

SEASONS = [
    "2031,Ann,12,9,20.5,3.25,0.5,0.25,11.5",
    "2032,Bo,41,40,18.25,2.5,1.25,0,9.75",
    "2033,Ann,41,17,22,4.5,0.75,0.5,14",
    "2034,Cy,8,3,9.5,0.25,0,1.5,3.25,extra",
    "2035,Cy,41,41,30.75,7.5,2.25,1,19.5",
    "2036,Ann,27,26,25.25,5,1.5,0.75,16.25",
]

WINDOW = datetime.datetime(2023, 4, 5, 9, 41, 15)


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_top_players(spark):
    rows = jobs.top_players(lines(spark, SEASONS), 2).collect()
    assert [tuple(r) for r in rows] == [("Ann", 3), ("Cy", 2)]
    typed = parse.parse_delimited(lines(spark, SEASONS), jobs.SCORE_SCHEMA)
    assert [t for _, t in typed.dtypes] == ["string"] * 3 + ["int"] + ["double"] * 5
    register_table(typed, "score")
    assert spark.sql("select count(*) n from score where play_num = '41'").first().n == 3
    assert [tuple(r) for r in group_count(typed, "player", "season").collect()] == [
        ("Ann", 3),
        ("Cy", 2),
        ("Bo", 1),
    ]


@pytest.mark.parametrize(
    "bad",
    ["2031,Ann,12,9,20.5,3.25,0.5,0.25", "2031,Ann,12,x,20.5,3.25,0.5,0.25,11.5",
     "2031,Ann,12, 9,20.5,3.25,0.5,0.25,11.5", "2031,Ann,12,9\t,20.5,3.25,0.5,0.25,11.5",
     "2031,Ann,12,1.5,20.5,3.25,0.5,0.25,11.5", ""],
)
def test_bad_delimited_line_fails_the_job(spark, bad):
    # Also where the query does not use the malformed column.
    with pytest.raises(Exception, match="bad line"):
        jobs.top_players(lines(spark, [*SEASONS, bad]), 3).collect()


def test_content_log(spark):
    timed = lines(spark, CONTENT).withColumn("ts", F.lit(WINDOW).cast("timestamp_ntz"))
    types = jobs.content_types(timed, ["ts"])
    assert sorted(r.ctype for r in types.collect()) == ["1", "1", "2"]
    parsed = parse.parse_json(timed, jobs.CONTENT_SCHEMA)
    assert [r.value for r in parse.quarantine(parsed).collect()] == ["{bad"]
    totals = jobs.content_totals(timed).collect()
    assert sorted((r.ctype, r.total) for r in totals) == [("1", 2), ("2", 1)]


def test_running_total_of_content(spark):
    rows = [(0, "1", 1), (1, "2", 1), (2, "1", 1)]
    df = spark.createDataFrame(rows, "seq int, ctype string, n int")
    got = running_total(df, ["ctype"], ["seq"], "n").orderBy("seq").collect()
    assert [(r.ctype, r.total) for r in got] == [("1", 1), ("2", 1), ("1", 2)]


@pytest.mark.parametrize(
    "text",
    [
        "",
        "  ",
        "null",
        "5",
        "[1]",
        '[{"x":1}]',
        '{"header":5}',
        '{"body":{"cards":[7]}}',
        '{"x":1',
        '{"x":1} more',
        '{"x":1}{"y":2}',
        '{"x":1},{"y":2}',
        '{"x":1},"y":2',
        '{"x":1}}',
        '{"x":1}]',
        '{"x":1}],"size":1}',
        None,
    ],
)
def test_json_quarantine_cases(spark, text):
    log = jobs.page_log(lines(spark, [text, PAGES["n1"]]))
    assert [r.value for r in parse.quarantine(log).collect()] == [text]
    assert sorted(r.route for r in log.collect()) == ["NAV", "NULL_TYPE"]
    with pytest.raises(Exception, match="bad JSON line"):
        jobs.page_log(lines(spark, [text]), strict=True).collect()


def test_page_routes_and_cards(spark, new_folder):
    log = jobs.page_log(lines(spark, PAGES.values()))
    routes = {r.value: r.route for r in log.collect()}
    assert [routes[PAGES[k]] for k in PAGES] == ["NAV", "PAGE", "PAGE"] + ["NULL_TYPE"] * 3
    nav = flatten.nav_cards(log).collect()
    assert sorted(r.key for r in nav) == ["P1", "P9"]
    assert {r.fileContents for r in nav} == {"a/NAV.json"}
    page = flatten.page_cards(log).collect()
    assert sorted(r.key for r in page) == ["P1", "P1", "P2"]

    path = new_folder("routes") + "/table"
    write_routes(log.select("value", "route"), path)
    stored = spark.read.parquet(path)
    assert [r.value for r in select_route(stored, NAV).collect()] == [PAGES["n1"]]
    assert {r.route: r["count"] for r in stored.groupBy("route").count().collect()} == {
        "NAV": 1,
        "PAGE": 2,
        "NULL_TYPE": 3,
    }


def test_page_paths_without_name_are_counted(spark):
    def page(path):
        return json.dumps({"header": {"fileContents": path}, "body": {"cards": [{"id": "c"}]}})

    paths = ["a/b.json", "x/.json", "nojson", "a.json/b"]
    log = jobs.page_log(lines(spark, [page(p) for p in paths]))
    assert [r.key for r in flatten.page_cards(log).collect()] == ["b"]
    assert flatten.pages_without_key(log).first().n_without_key == 3
    with pytest.raises(Exception, match="no .json file name"):
        flatten.page_cards(log, strict=True).collect()


def test_page_join(spark):
    rows = jobs.join_pages(lines(spark, PAGES.values())).collect()
    common = {"navSource": "s1", "navTitle": "t1", "navPageId": "P1", "pageId": "P1"}
    got = sorted((json.loads(r.value) for r in rows), key=lambda d: d["title"])
    assert got == [{**common, "source": "x", "title": "y"}, {**common, "title": "z"}]


def test_page_join_keeps_nested_values_and_leaves_out_nulls(spark):
    nav = json.loads(PAGES["n1"])
    nav["body"]["cards"] = [
        {"id": "P1", "source": {"a": [1, {"b": None}]}, "title": None, "fileTime": "1999"}
    ]
    page = json.loads(PAGES["p1"])
    page["body"]["cards"] = [{"id": 1, "source": 2.5, "title": True}, {"source": [1, "2"]}]
    rows = jobs.join_pages(lines(spark, [json.dumps(nav), json.dumps(page)])).collect()
    common = {"navSource": {"a": [1, {"b": None}]}, "navPageId": "P1", "pageId": "P1"}
    got = sorted((json.loads(r.value) for r in rows), key=lambda d: "title" in d)
    assert got == [{**common, "source": [1, "2"]}, {**common, "source": 2.5, "title": True}]


def test_page_join_salted_is_the_same(spark):
    plain = jobs.join_pages(lines(spark, PAGES.values())).collect()
    salted = jobs.join_pages(lines(spark, PAGES.values()), salts=3).collect()
    assert sorted(r.value for r in plain) == sorted(r.value for r in salted)


def test_page_cogroup(spark):
    rows = jobs.cogroup_pages(lines(spark, PAGES.values())).collect()
    assert sorted(tuple(r) for r in rows) == [
        (WINDOW, "P1", 1, 2, "yes"),
        (WINDOW, "P2", 0, 1, "yes"),
        (WINDOW, "P9", 1, 0, "yes"),
    ]


def test_rows_without_time_can_be_counted(spark):
    df = spark.createDataFrame([("2023-04-05 09:41:18", 1), ("soon", 1), (None, 1)], "t string, n int")
    timed = windows.with_event_time(df, "t")
    assert windows.without_time(timed, "t").count() == 2
    counts = windows.window_counts(timed, "n", "t", "5 seconds", out="rows")
    assert [tuple(r) for r in counts.collect()] == [(WINDOW, 1, 1)]
    stamped = windows.with_event_time(df, "t", ingest_time=True)
    assert windows.without_time(stamped, "t").count() == 0


SEQUENCE = [12, 40, 1, 33, 52, 1, 25, 60, 18, 77, 1]
SEGMENTS = [(2, "12 40 "), (2, "33 52 "), (4, "25 60 18 77 ")]


@pytest.mark.parametrize("tail", [[], [8], [8, 1, 1, 1], [1, 1]])
def test_delimiter_segments(spark, tail):
    rows = list(enumerate(SEQUENCE + tail))
    df = spark.createDataFrame(rows, "seq int, value bigint")
    got = delimiter_segments(df, [], ["seq"], "value", F.col("value") == 1)
    expected = SEGMENTS + ([(1, "8 ")] if tail[:2] == [8, 1] else [])
    assert [(r.n, r["items"]) for r in got.orderBy("segment").collect()] == expected
    assert got.columns == ["segment", "n", "items"]


def test_keyword_rows(spark):
    words = list("abcdefgh")
    rows = keyword_rows(spark.range(16), "id", words).orderBy("n").collect()
    assert [tuple(r) for r in rows] == [(1, words[n % 8], n) for n in range(16)]


def test_window_max_by_takes_the_first_on_a_tie(spark):
    rows = [(0, "k", 1, 3.0), (1, "k", 2, 5.0), (2, "k", 3, 5.0), (3, "k", 7, 1.0)]
    df = spark.createDataFrame(rows, "seq int, k string, sec int, value double").withColumn(
        "ts", F.timestamp_seconds("sec").cast("timestamp_ntz")
    )
    got = windows.window_max_by(df, "k", "ts", "5 seconds", "value", ["seq"]).collect()
    assert sorted((r.window_start.second, r.value, r.seq) for r in got) == [(0, 5.0, 1), (5, 1.0, 3)]


def test_lookup_family(spark):
    source = spark.createDataFrame([(f"k{i}", i) for i in range(500)], "key string, value int")
    asked = spark.createDataFrame([("k1",), ("zz",)], "key string")
    got = lookup.enrich(asked, source, "key", ["value"]).collect()
    assert sorted(tuple(r) for r in got) == [("k1", 1), ("zz", None)]
    assert tuple(lookup.hit_rate(asked, source, "key").first()) == (2, 1)
    assert tuple(lookup.hit_rate(asked.limit(0), source, "key").first()) == (0, 0)

    held = spark.createDataFrame([("k1", 100)], "key string, value int")
    nulls = source.unionByName(spark.createDataFrame([("zz", None)], "key string, value int"))
    more = asked.unionByName(spark.createDataFrame([("k7",), ("k7",), ("q",)], "key string"))
    filled = lookup.backfill(more, held, nulls, "key").collect()
    assert sorted(tuple(r) for r in filled) == [("k1", 100), ("k7", 7)]

    base = spark.createDataFrame([("k1", 1)], "key string, value int")
    changes = spark.createDataFrame(
        [("k1", 5, 1, True), ("k1", 7, 2, True), ("k2", 9, 3, False)],
        "key string, value int, seq bigint, is_updated boolean",
    )
    assert [tuple(r) for r in lookup.latest_dirty(changes, "key", "value", "seq").collect()] == [
        ("k1", 7, 2)
    ]
    assert [tuple(r) for r in lookup.upsert(base, changes, "key", "value", "seq").collect()] == [
        ("k1", 7)
    ]

    used = spark.createDataFrame(list(enumerate(["k1", "k2", "k3", "k1"])), "seq int, key string")
    assert [r.key for r in lookup.recent_keys(used, "key", "seq", 2).collect()] == ["k1", "k3"]


def test_repeated_lookup_keys_count_once(spark):
    calls = spark.createDataFrame([("p",), ("p",)], "key string")
    held = spark.createDataFrame([("p", 4), ("p", 2), ("q", 1)], "key string, value int")
    assert tuple(lookup.hit_rate(calls, held, "key").first()) == (2, 2)
    assert [tuple(r) for r in lookup.enrich(calls, held, "key", ["value"]).collect()] == [("p", 2)] * 2


@pytest.mark.parametrize(
    "kind, values, best",
    [
        ("double", [None, 5.0], 5.0),
        ("double", [5.0, float("nan"), 7.0], "NaN"),
        ("bigint", [-(2**63), -4, None], -4),
        ("string", ["ash", "yew", "oak"], "yew"),
        ("date", [datetime.date(2023, 1, 2), datetime.date(2024, 1, 2)], datetime.date(2024, 1, 2)),
    ],
)
def test_window_max_by_orders_any_type(spark, kind, values, best):
    rows = [(i, "k", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"seq int, k string, value {kind}").withColumn("ts", F.lit(WINDOW).cast("timestamp_ntz"))
    got = windows.window_max_by(df, "k", "ts", "5 seconds", "value", ["seq"]).collect()
    assert [("NaN" if r.value != r.value else r.value) for r in got] == [best]


@pytest.mark.parametrize(
    "line",
    [
        '{"x":1}],"a":[{"y":2}',
        '{"x":1}],"line":[{"x":2}',
        '{"x":1}],"size":1,"b":[{"y":2}',
        '{"x":1},{"x":2}',
        '{"x":1}]',
        '{"x":1}]}',
        '{"x":"1" 2}',
        "",
        "[]",
        "null",
    ],
)
def test_a_line_cannot_close_the_check(spark, line):
    parsed = parse.parse_json(lines(spark, [line, '{"x":7}']), "x int").select("value", "bad", "doc.x").collect()
    assert {r.value: (r.bad, r.x if not r.bad else None) for r in parsed} == {line: (True, None), '{"x":7}': (False, 7)}


def test_arrival_time_needs_no_file_time(spark):
    nav = '{"header":{"fileContents":"a/NAV.json"},"body":{"cards":[{"id":"P1","title":"t1"}]}}'
    page = '{"header":{"fileContents":"a/P1.json"},"body":{"cards":[{"title":"y"}]}}'
    log = lines(spark, [nav, page])
    assert jobs.join_pages(log, "1 day").count() == 0
    assert [json.loads(r.value)["title"] for r in jobs.join_pages(log, "1 day", ingest_time=True).collect()] == ["y"]
    assert jobs.cogroup_pages(log, "1 day", ingest_time=True).count() == 1


def test_a_time_with_offset_is_moved_to_utc(spark):
    df = spark.createDataFrame([("2023-04-05T09:41:18+08:00",), ("2023-04-05 09:41:18",)], "t string")
    got = [r.t for r in windows.with_event_time(df, "t").collect()]
    assert got == [datetime.datetime(2023, 4, 5, 1, 41, 18), datetime.datetime(2023, 4, 5, 9, 41, 18)]


def test_negative_values_have_no_running_total_per_window(spark):
    df = spark.createDataFrame([("k", 3), ("k", -5)], "k string, v bigint").withColumn("ts", F.lit(WINDOW).cast("timestamp_ntz"))
    with pytest.raises(Exception, match="negative value"):
        windows.running_total_per_window(df, "k", "ts", "5 seconds", "v").collect()
