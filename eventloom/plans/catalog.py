"""Every operator as a query over the given tables: ``name -> (spark, folder) -> table``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.strings import key_label, split_whitespace
from eventloom.operators import flatten, joins, lookup, ordered, parse, relational, windows
from eventloom.operators.watch import Watch
from eventloom.plans import derive, jobs
from eventloom.session import scratch_path, stage_table
from eventloom.sources import keyword_rows, read_folder, read_lines, read_positions, stream_lines
from eventloom.streaming.keyed_table import KeyedTable
from eventloom.streaming.sinks import run_to_end

Query = Callable[[SparkSession, str], DataFrame]

# The keyword list is an argument of the source; this is the one the query uses.
KEYWORDS = ("red", "orange", "yellow", "green", "blue", "indigo", "violet", "grey")

# Ranges of time in which the page log is written that is read as a stream.
LOG_RANGES = 12

LINE_FIELDS = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_returnflag": "string",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_linestatus": "string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text_folder(lines: DataFrame, name: str) -> str:
    """Write ``value`` as text files to the shared folder, as a log collector would."""
    path = scratch_path(lines.sparkSession, name)
    lines.select("value").write.text(path)
    return path


def _documents(spark, folder):
    return table(spark, folder, "documents").select(F.col("text").alias("value"))


def text_scan(spark, folder):
    return read_lines(spark, _text_folder(_documents(spark, folder), "documents"))


def folder_scan(spark, folder):
    path = _text_folder(_documents(spark, folder), "documents")
    return read_folder(spark, path).select(
        "value", F.col("file_path").endswith(".txt").alias("from_text_file")
    )


def line_stream(spark, folder):
    path = _text_folder(_documents(spark, folder), "documents")
    return run_to_end(stream_lines(spark, path, bytes_per_trigger=str(1 << 30)), "line-stream")


def line_passthrough(spark, folder):
    said = table(spark, folder, "conversations").select(F.col("text").alias("value"))
    return run_to_end(stream_lines(spark, _text_folder(said, "said"), bytes_per_trigger=str(1 << 30)), "passthrough")


def keyword_sequence(spark, folder):
    return keyword_rows(table(spark, folder, "orders"), "o_orderkey", KEYWORDS)


def delimited_parse(spark, folder):
    lines = derive.lineitem_lines(table(spark, folder, "lineitem"), list(LINE_FIELDS))
    schema = ", ".join(f"{name} {kind}" for name, kind in LINE_FIELDS.items())
    return parse.parse_delimited(lines, schema)


def content_running(spark, folder):
    """A content log in order of its lines: one total per record and type."""
    lines = derive.numbered_content_lines(table(spark, folder, "lineitem"))
    log = read_positions(spark, _text_folder(lines, "content-log"))
    docs = parse.good_rows(parse.parse_json(log, f"id string, {jobs.CONTENT_SCHEMA}"))
    keep = ["file", "line", "id"]
    rows = flatten.explode_two_levels(docs.withColumn("id", F.col("doc.id")), "doc.ZT_content", "ZT_leaf_video", "ctype", "ctype", keep)
    # Of one line's types each comes once, so file, line and type are an order.
    # Staged, as a cut by range evaluates its input twice: lines are parsed once.
    typed = stage_table(flatten.nonempty(rows, "ctype"), "typed")
    totals = ordered.running_total(typed, ["ctype"], ["file", "line"], "n")
    return totals.select("id", "ctype", "total")


def sql_group_count(spark, folder):
    return relational.group_count(table(spark, folder, "orders"), "o_custkey", "o_orderdate")


def sql_topk(spark, folder):
    return jobs.top_players(derive.score_lines(table(spark, folder, "orders")), 3)


def json_parse(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.col("props").alias("value"))
    docs = parse.good_rows(parse.parse_json(events, "k bigint"))
    return docs.select("event_id", "doc.k")


def json_quarantine(spark, folder):
    props = F.col("props")
    cut_off = F.substring(props, F.lit(1), F.length(props) - 1)
    events = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") == "error", cut_off).otherwise(props).alias("value")
    )
    return parse.quarantine(parse.parse_json(events, "k bigint"))


def json_nested_explode(spark, folder):
    lines = derive.content_lines(table(spark, folder, "lineitem"))
    docs = parse.good_rows(parse.parse_json(lines, jobs.CONTENT_SCHEMA))
    rows = flatten.explode_two_levels(docs, "doc.ZT_content", "ZT_leaf_video", "ctype", "ctype")
    return rows.groupBy("ctype").agg(F.sum("n").alias("n"))


def filter_nonempty(spark, folder):
    rows = jobs.content_types(derive.content_lines(table(spark, folder, "lineitem")))
    return rows.groupBy("ctype").agg(F.sum("n").alias("n"))


def content_totals(spark, folder):
    lines = derive.content_lines(table(spark, folder, "lineitem"))
    return jobs.content_totals(lines, "ts", "1 day")


def tokenize(spark, folder):
    words = F.explode(split_whitespace(F.col("text"))).alias("word")
    return table(spark, folder, "documents").select("doc_id", words, F.lit(1).alias("n"))


def windowed_word_count(spark, folder):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    second = F.make_dt_interval(secs=F.col("doc_id"))
    lines = table(spark, folder, "documents").select(
        (start + second).alias("ts"), F.col("text").alias("value")
    )
    return jobs.word_counts(lines, "ts", "5 seconds")


def running_reduce(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", "ts", "event_type", F.lit(1).alias("n")
    )
    totals = ordered.running_total(
        events, ["event_type"], ["ts", "event_id"], "n"
    )
    return totals.select("event_id", "event_type", "total")


def running_maximum(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    return ordered.running_reduce(
        events, ["event_type"], ["ts", "event_id"], "value", lambda a, b: F.greatest(a, b), "highest"
    ).select("event_id", "event_type", "highest")


def last_known(spark, folder):
    clicked = F.when(F.col("event_type") == "click", F.col("event_id")).alias("clicked")
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", clicked)
    return ordered.running_reduce(
        events, ["user_id"], ["ts", "event_id"], "clicked", lambda a, b: F.coalesce(b, a), "last_click"
    ).select("event_id", "user_id", "last_click")


def running_total_signed(spark, folder):
    change = (F.col("user_id") % 7 - 3).alias("change")
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", change)
    return windows.running_total_per_window(events, "event_type", "ts", "1 hour", "change", order=["event_id"])


def window_max_by(spark, folder):
    return windows.window_max_by(
        table(spark, folder, "events"), "event_type", "ts", "1 hour", "value", ["ts", "event_id"]
    )


def running_total_per_window(spark, folder):
    return windows.running_total_per_window(
        table(spark, folder, "events"), "event_type", "ts", "1 hour"
    )


def cumulative_window_count(spark, folder):
    counts = windows.cumulative_window_count(
        table(spark, folder, "events"), "event_type", "ts", "1 hour"
    )
    return counts.select("window_start", key_label(F.col("event_type")).alias("label"), "total")


def seeded_window_count(spark, folder):
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("user_id"))
    return windows.cumulative_window_count(
        table(spark, folder, "events"),
        "user_id",
        "ts",
        "1 day",
        seed=orders.agg(F.count(F.lit(1)).alias("seed")),
    )


def split_route(spark, folder):
    log = jobs.page_log(derive.page_lines(table(spark, folder, "events")))
    return log.select("event_id", "route")


def _card_texts(cards: DataFrame) -> DataFrame:
    return cards.select(
        "key",
        "id",
        F.col("source").cast("string").alias("source"),
        F.col("title").cast("string").alias("title"),
        "fileTime",
        "contentsTime",
        "fileContents",
    )


def nav_cards(spark, folder):
    log = jobs.page_log(derive.page_lines(table(spark, folder, "events")))
    return _card_texts(flatten.nav_cards(log))


def page_cards(spark, folder):
    log = jobs.page_log(derive.page_lines(table(spark, folder, "events")))
    return _card_texts(flatten.page_cards(log))


def json_project(spark, folder):
    log = jobs.page_log(derive.page_lines(table(spark, folder, "events")))
    cards = flatten.page_cards(log)
    record = F.struct("source", "title", F.col("key").alias("pageId"))
    return cards.select(F.to_json(record).alias("value"))


def page_join(spark, folder):
    return jobs.join_pages(derive.page_lines(table(spark, folder, "events")), "1 day")


def page_cogroup(spark, folder):
    return jobs.cogroup_pages(derive.page_lines(table(spark, folder, "events")), "1 day")


def _log_in_time(events: DataFrame, ranges: int) -> tuple[str, int]:
    """A page log as a collector leaves it, the files of one range of time after those of another,
    and the length of a range in seconds: no row of a file is older by more than that than one before."""
    spark = events.sparkSession
    path = scratch_path(spark, "page-log")
    first, last = events.select(*[F.unix_seconds(f("ts").cast("timestamp")) for f in (F.min, F.max)]).first()
    first, last = first or 0, last or 0
    length = (last - first) // ranges + 1
    number = F.floor((F.unix_seconds(F.col("ts").cast("timestamp")) - first) / length)
    for i in range(ranges):  # one after the other, since a stream takes files by their time of writing
        own = events.where(F.coalesce(number, F.lit(0)) == i)
        derive.page_lines(own).select("value").write.mode("append").text(path)
    return path, length


def page_join_stream(spark, folder):
    path, length = _log_in_time(table(spark, folder, "events"), LOG_RANGES)
    lines = stream_lines(spark, path, files_per_trigger=LOG_RANGES // 3)
    joined = jobs.join_pages(lines, "1 day", delay=f"{length} seconds", salts=4)
    return run_to_end(joined, "page-join", refuse_late=True)


def dropped_records(spark, folder):
    watch = Watch()
    log = derive.page_lines(table(spark, folder, "events"))
    jobs.page_cards(log, watch=watch).write.format("noop").mode("overwrite").save()
    counts = sorted(watch.counts().items())
    return spark.createDataFrame(counts, "what string, n bigint")


def _views_and_clicks(spark, folder, *columns):
    events = table(spark, folder, "events").select("user_id", "ts", *columns, "event_type")
    views = events.where(F.col("event_type") == "view").drop("event_type")
    clicks = events.where(F.col("event_type") == "click").drop("event_type")
    return views, clicks


def window_join(spark, folder):
    views, clicks = _views_and_clicks(spark, folder, "event_id")
    return joins.window_join(views, clicks, "user_id", "ts", "1 day").select(
        F.col("window.start").alias("window_start"),
        "user_id",
        F.col("l.event_id").alias("view_id"),
        F.col("r.event_id").alias("click_id"),
    )


def window_cogroup(spark, folder):
    views, clicks = _views_and_clicks(spark, folder, "value")
    return joins.window_cogroup(
        views,
        clicks,
        "user_id",
        "ts",
        "1 day",
        aggs=[F.max("l.value").alias("max_left"), F.max("r.value").alias("max_right")],
    )


def delimiter_segments(spark, folder):
    return ordered.delimiter_segments(
        table(spark, folder, "events"),
        ["user_id"],
        ["ts", "event_id"],
        "event_id",
        F.col("event_type") == "error"
    )


def lookup_enrich(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return lookup.enrich(documents, table(spark, folder, "labels"), "doc_id", ["quality", "toxic"])


def lookup_hit_rate(spark, folder):
    return lookup.hit_rate(
        table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id"
    )


def lookup_backfill(spark, folder):
    source = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_acctbal", "c_mktsegment"
    )
    held = source.where(F.col("c_mktsegment") == "BUILDING")
    asked = table(spark, folder, "orders").select(F.col("o_custkey").alias("custkey"))
    return lookup.backfill(asked, held, source, "custkey")


def dirty_upsert(spark, folder):
    base = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("value")
    )
    changes = table(spark, folder, "events").select(
        F.col("user_id").alias("key"),
        "value",
        F.col("event_id").alias("seq"),
        (F.col("value") > 50).alias("is_updated"),
    )
    return lookup.upsert(base, changes, "key", "value", "seq")


def dirty_write_back(spark, folder):
    """Changes in eight batches, one of them repeated, two of the merges in between."""
    base = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("value"))
    changes = table(spark, folder, "events").select(
        F.col("user_id").alias("key"), "value", F.col("event_id").alias("seq"), (F.col("value") > 50).alias("is_updated")
    )
    store = KeyedTable(spark, scratch_path(spark, "keyed"), "key", "value", "seq").create(base)
    for batch_id in (0, 1, 2, 2, 3, 4, 5, 6, 7):
        store.write_back(changes.where(F.col("seq") % 8 == batch_id), batch_id)
        if batch_id in (3, 5):
            store.compact()
    return store.read()


def recent_keys_topn(spark, folder):
    return lookup.recent_keys(table(spark, folder, "events"), "user_id", "event_id", 20)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        text_scan,
        folder_scan,
        line_stream,
        line_passthrough,
        keyword_sequence,
        delimited_parse,
        content_running,
        sql_group_count,
        sql_topk,
        json_parse,
        json_quarantine,
        json_nested_explode,
        filter_nonempty,
        content_totals,
        tokenize,
        windowed_word_count,
        running_reduce,
        running_maximum,
        last_known,
        running_total_signed,
        window_max_by,
        running_total_per_window,
        cumulative_window_count,
        seeded_window_count,
        split_route,
        nav_cards,
        page_cards,
        json_project,
        page_join,
        page_cogroup,
        page_join_stream,
        dropped_records,
        window_join,
        window_cogroup,
        delimiter_segments,
        lookup_enrich,
        lookup_hit_rate,
        lookup_backfill,
        dirty_upsert,
        dirty_write_back,
        recent_keys_topn,
    )
}
