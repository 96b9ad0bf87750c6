"""The end-to-end jobs: lines in, result rows out. All but the SQL top-k also run on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.strings import key_label, path_stem, split_whitespace
from eventloom.operators.flatten import explode_two_levels, keyed_cards, nonempty
from eventloom.operators.joins import cogroup_tagged, window_join
from eventloom.operators.parse import good_rows, parse_delimited, parse_json
from eventloom.operators.relational import run_sql
from eventloom.operators.routing import NAV, NULL_TYPE, PAGE, add_route, select_route
from eventloom.operators.watch import Watch, counting
from eventloom.operators.windows import (
    cumulative_window_count,
    running_total_per_window,
    windowed_sum,
    with_event_time,
)
from eventloom.session import stage_table
from eventloom.streaming.stateful import cumulative_window_count_stream

# Field names and types of the three record kinds.
SCORE_SCHEMA = (
    "season string, player string, play_num string, first_court int, time double, "
    "assists double, steals double, blocks double, scores double"
)
CONTENT_SCHEMA = (
    "ZT_content array<struct<ZT_leaf_video array<struct<ctype string>>>>"
)
PAGE_LOG_SCHEMA = (
    "header struct<fileTime string, contentsTime string, fileContents string>, "
    "body struct<cards array<struct<id string, source variant, title variant>>>"
)


def top_players(lines: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` players with the most seasons, from delimited lines, in SQL."""
    score = parse_delimited(lines, SCORE_SCHEMA)
    return run_sql(
        lines.sparkSession,
        "select player, count(season) as num from {score} "
        f"group by player order by num desc, player limit {int(k)}",
        score=score,
    )


def content_types(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row ``(*keep, ctype, n=1)`` per video with a type, from nested JSON lines."""
    docs = good_rows(parse_json(lines, CONTENT_SCHEMA))
    rows = explode_two_levels(docs, "doc.ZT_content", "ZT_leaf_video", "ctype", "ctype", keep)
    return nonempty(rows, "ctype")


def content_totals(lines: DataFrame, ts: str = "ts", width: str = "5 seconds") -> DataFrame:
    """``(window_start, ctype, total)``: largest running total per content type and window."""
    types = content_types(lines, [ts])
    if lines.isStreaming:
        totals = cumulative_window_count_stream(types, "ctype", ts, width)
        return totals.select("window_start", "ctype", "total")
    return running_total_per_window(types, "ctype", ts, width, "n")


def keyword_counts(rows: DataFrame, ts: str = "ts", width: str = "2 seconds") -> DataFrame:
    """``(total, label)`` per keyword and window: how often the keyword came so far."""
    if rows.isStreaming:
        counts = cumulative_window_count_stream(rows, "keyword", ts, width)
    else:
        counts = cumulative_window_count(rows, "keyword", ts, width).withColumn(
            "label", key_label(F.col("keyword"))
        )
    return counts.select("total", "label")


def word_counts(lines: DataFrame, ts: str = "ts", width: str = "5 seconds") -> DataFrame:
    """Words per window; ``lines`` has ``value`` and an event time."""
    words = lines.select(
        ts, F.explode(split_whitespace(F.col("value"))).alias("word"), F.lit(1).alias("n")
    )
    return windowed_sum(words, "word", ts, width, "n")


def page_log(lines: DataFrame, strict: bool = False, watch: Watch | None = None) -> DataFrame:
    """Parsed and routed navigation and page records.

    ``watch`` counts lines, bad lines, records of neither kind and pages without a page name.
    """
    log = add_route(parse_json(lines, PAGE_LOG_SCHEMA, strict=strict))
    no_name = F.coalesce(path_stem(F.col("doc.header.fileContents")), F.lit("")) == ""
    return counting(
        watch,
        log,
        "lines",
        lines=F.lit(True),
        bad_lines=F.col("bad"),
        records_without_route=~F.col("bad") & (F.col("route") == NULL_TYPE),
        pages_without_key=(F.col("route") == PAGE) & no_name,
    )


def page_cards(
    lines: DataFrame,
    delay: str = "0 seconds",
    strict: bool = False,
    ingest_time: bool = False,
    watch: Watch | None = None,
) -> DataFrame:
    """The keyed cards of both record kinds: ``(route, key, ts, source, title)``.

    Cards without a usable ``fileTime`` are in no window; with ``ingest_time`` the arrival
    time counts and none is needed. ``watch`` counts in the same pass what is dropped on the way.
    """
    cards = keyed_cards(page_log(lines, strict, watch), strict=strict, watch=watch)
    timed = with_event_time(cards, "fileTime", delay, out="ts", ingest_time=ingest_time)
    timed = timed.select("route", "key", "ts", "source", "title")
    return counting(watch, timed, "times", cards_without_time=F.col("ts").isNull())


def page_record() -> Column:
    """The output record of a joined pair as JSON; absent fields are left out."""
    return F.to_json(
        F.struct(
            F.col("l.source").alias("navSource"),
            F.col("l.title").alias("navTitle"),
            F.col("l.key").alias("navPageId"),
            F.col("r.source").alias("source"),
            F.col("r.title").alias("title"),
            F.col("r.key").alias("pageId"),
        )
    )


def join_pages(
    lines: DataFrame,
    width: str = "5 seconds",
    delay: str = "0 seconds",
    salts: int = 1,
    ingest_time: bool = False,
    watch: Watch | None = None,
) -> DataFrame:
    """Navigation cards joined with the cards of the page they lead to, as JSON lines.

    A table of lines is read and parsed once: the cards are staged by route, and each
    side of the join reads its own. A stream reads its source once per side; ``delay`` has to
    cover the disorder between the batches, and ``salts`` splits hot pages. ``watch`` counts what
    is dropped, on tables only, where the log is read once.
    """
    if watch is not None and lines.isStreaming:
        raise ValueError("a stream is read once per side: watch page_cards or cogroup_pages instead")
    cards = page_cards(lines, delay, ingest_time=ingest_time, watch=watch)
    if not lines.isStreaming:
        cards = stage_table(cards, "cards", partition_by="route")
    nav, page = (select_route(cards, side).drop("route") for side in (NAV, PAGE))
    pairs = window_join(nav, page, "key", "ts", width, salts=salts)
    return pairs.select(page_record().alias("value"))


def cogroup_pages(
    lines: DataFrame,
    width: str = "5 seconds",
    delay: str = "0 seconds",
    ingest_time: bool = False,
    watch: Watch | None = None,
) -> DataFrame:
    """One row per page and window with the number of cards on either side, in one pass."""
    cards = page_cards(lines, delay, ingest_time=ingest_time, watch=watch)
    return cogroup_tagged(cards, "key", "ts", width, is_left=F.col("route") == NAV)
