"""One label per record, and the selection of a label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marker in the path and the three labels.
NAV_MARKER = "NAV.json"
NAV, PAGE, NULL_TYPE = "NAV", "PAGE", "NULL_TYPE"


def route_label(path: Column, marker: str = NAV_MARKER) -> Column:
    return (
        F.when(path.contains(marker), NAV).when(path.isNotNull(), PAGE).otherwise(NULL_TYPE)
    )


def add_route(df: DataFrame, doc: str = "doc", marker: str = NAV_MARKER) -> DataFrame:
    """Add ``route``. Bad lines have no usable path and get ``NULL_TYPE``."""
    path = F.when(~F.col("bad"), F.col(f"{doc}.header.fileContents"))
    return df.withColumn("route", route_label(path, marker))


def select_route(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col("route") == label)


def write_routes(df: DataFrame, path: str) -> None:
    """Write every route in one pass, a folder each; readers of one route skip the rest."""
    df.write.partitionBy("route").parquet(path)
