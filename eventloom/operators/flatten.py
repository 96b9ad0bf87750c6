"""Nested arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.strings import path_stem
from eventloom.operators.routing import NAV, PAGE, select_route
from eventloom.operators.watch import Watch, counting


def explode_two_levels(
    df: DataFrame, outer: str, inner: str, leaf: str, out: str, keep: list[str] | None = None
) -> DataFrame:
    """One row ``(*keep, out, n=1)`` per element of ``outer[*].inner[*]``.

    Null or empty arrays give no row, neither do elements whose ``leaf`` is null.
    """
    keep = keep or []
    level_1 = df.select(*keep, F.explode(F.col(outer)).alias("_o"))
    level_2 = level_1.select(*keep, F.explode(F.col(f"_o.{inner}")).alias("_i"))
    return level_2.select(*keep, F.col(f"_i.{leaf}").alias(out), F.lit(1).alias("n")).where(
        F.col(out).isNotNull()
    )


def nonempty(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull() & (F.col(key) != ""))


def _known(any_value: Column) -> Column:
    # An explicit JSON null counts as absent.
    return F.when(~F.is_variant_null(any_value), any_value)


def keyed_cards(
    log: DataFrame,
    doc: str = "doc",
    keep: list[str] | None = None,
    strict: bool = False,
    watch: Watch | None = None,
) -> DataFrame:
    """One row per card of the routed navigation and page records, in one pass.

    ``watch`` counts the cards that are dropped for want of a key, by kind of record.

    A navigation card has its own id as ``key``, a page card the page name in the
    header's path; a card without key gives no row. Time and path come from the header,
    whatever the card itself says.
    """
    path = F.col(f"{doc}.header.fileContents")
    is_page = F.col("route") == PAGE
    cards = log.where(F.col("route").isin(NAV, PAGE)).select(
        *(keep or []),
        "route",
        F.when(is_page, path_stem(path, strict=strict)).alias("_page"),
        F.col(f"{doc}.header").alias("_header"),
        F.explode(F.col(f"{doc}.body.cards")).alias("_card"),
    )
    key = F.when(is_page, F.nullif("_page", F.lit(""))).otherwise(F.col("_card.id"))
    with_key = cards.withColumn("key", key)
    no_key = F.col("key").isNull()
    with_key = counting(
        watch, with_key, "cards", nav_cards_without_id=no_key & ~is_page, page_cards_without_page=no_key & is_page
    )
    return with_key.where(F.col("key").isNotNull()).select(
        *(keep or []),
        "route",
        "key",
        F.col("_card.id").alias("id"),
        _known(F.col("_card.source")).alias("source"),
        _known(F.col("_card.title")).alias("title"),
        F.col("_header.fileTime").alias("fileTime"),
        F.col("_header.contentsTime").alias("contentsTime"),
        F.col("_header.fileContents").alias("fileContents"),
    )


def nav_cards(log: DataFrame, doc: str = "doc", keep: list[str] | None = None) -> DataFrame:
    """The cards of the navigation records of a routed log, keyed by card id."""
    return keyed_cards(select_route(log, NAV), doc, keep).drop("route")


def page_cards(
    log: DataFrame, doc: str = "doc", keep: list[str] | None = None, strict: bool = False
) -> DataFrame:
    """The cards of the page records of a routed log, keyed by page name."""
    return keyed_cards(select_route(log, PAGE), doc, keep, strict).drop("route")


def pages_without_key(log: DataFrame, doc: str = "doc") -> DataFrame:
    """Number of page records without a page name, whose cards are therefore dropped."""
    path = F.col(f"{doc}.header.fileContents")
    no_name = F.coalesce(path_stem(path), F.lit("")) == ""
    return select_route(log, PAGE).agg(F.count_if(no_name).alias("n_without_key"))
