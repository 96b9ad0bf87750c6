"""Text lines made by Spark from the given tables: row by row, nothing gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SECONDS = "yyyy-MM-dd HH:mm:ss"


def score_lines(orders: DataFrame) -> DataFrame:
    """An order as a player season: the customer plays, the month is the season."""
    return orders.select(
        F.concat_ws(
            ",",
            F.date_format("o_orderdate", "yyyy-MM"),
            F.concat(F.lit("player-"), F.col("o_custkey")),
            F.col("o_orderkey").cast("string"),
            F.month("o_orderdate").cast("string"),
            F.col("o_totalprice").cast("string"),
            F.col("o_custkey").cast("double").cast("string"),
            F.lit("1.5"),
            F.lit("0"),
            F.col("o_totalprice").cast("string"),
        ).alias("value")
    )


def lineitem_lines(lineitem: DataFrame, columns: list[str]) -> DataFrame:
    return lineitem.select(
        F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("value")
    )


def content_lines(lineitem: DataFrame) -> DataFrame:
    """A line item as nested content record: its flag and its line number are the types.

    Holds a numeric type, an empty one, an absent one and an empty list as well.
    """
    return lineitem.select(
        F.col("l_shipdate").alias("ts"),
        F.concat(
            F.lit('{"ZT_content":[{"ZT_leaf_video":[{"ctype":"'),
            F.col("l_returnflag"),
            F.lit('"},{"ctype":'),
            F.col("l_linenumber").cast("string"),
            F.lit('}]},{"ZT_leaf_video":[{"ctype":""},{"other":1}]},{"ZT_leaf_video":[]}]}'),
        ).alias("value"),
    )


def numbered_content_lines(lineitem: DataFrame) -> DataFrame:
    """A content log in order of its line items, in as many files as there are partitions.

    Every line has the types flag and line number, an empty one and its own ``id``.
    """
    line = F.concat(
        F.lit('{"id":"'), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"),
        F.lit('","ZT_content":[{"ZT_leaf_video":[{"ctype":"'), F.col("l_returnflag"), F.lit('"},{"ctype":'),
        F.col("l_linenumber").cast("string"), F.lit('}]},{"ZT_leaf_video":[{"ctype":""}]}]}'),
    )
    place = ["l_orderkey", "l_linenumber", "l_returnflag"]
    # A line is put together when its place is known, so that only the place is shuffled and sorted.
    return lineitem.select(*place).repartitionByRange(*place).sortWithinPartitions(*place).select(line.alias("value"))


def page_lines(events: DataFrame) -> DataFrame:
    """Events as page log: views are navigation, clicks are pages, the rest is neither.

    Sign-ups have a header without path, purchases no header, errors are broken JSON.
    """
    at = F.date_format("ts", SECONDS)
    page = F.concat(F.lit("P"), F.col("user_id"))
    event = F.col("event_id").cast("string")

    def header(path):
        return F.concat(
            F.lit('{"header":{"fileTime":"'), at, F.lit('","contentsTime":"'), at,
            F.lit('","fileContents":"'), path, F.lit('"},"body":{"cards":['),
        )

    nav = F.concat(
        header(F.lit("site/NAV.json")),
        F.lit('{"id":"'), page, F.lit('","source":"view","title":"nav '), event,
        F.lit('","fileTime":"overwritten"},{"title":"without id"}]}}'),
    )
    pages = F.concat(
        header(F.concat(F.lit("pages/"), page, F.lit(".json"))),
        F.lit('{"id":"c'), event, F.lit('","source":{"event":'), event,
        F.lit('},"title":"first"},{"id":'), event, F.lit(',"title":"second","source":null}]}}'),
    )
    no_path = F.concat(F.lit('{"header":{"fileTime":"'), at, F.lit('"}}'))
    return events.select(
        "event_id",
        F.when(F.col("event_type") == "view", nav)
        .when(F.col("event_type") == "click", pages)
        .when(F.col("event_type") == "signup", no_path)
        .when(F.col("event_type") == "purchase", '{"x":1}')
        .otherwise("{bad")
        .alias("value"),
    )
