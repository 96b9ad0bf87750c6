"""Windowed inner join and co-group of two tables or two streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.windows import tumbling


def _row_hash(df: DataFrame) -> Column:
    # Variants and maps cannot be hashed as they are.
    return F.xxhash64(
        *[
            F.to_json(name) if "variant" in kind or "map<" in kind else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def window_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    width: str,
    salts: int = 1,
) -> DataFrame:
    """Every pair with the same ``key`` in the same window.

    Columns ``window, key`` and the rest as structs ``l`` and ``r``. On tables, hot
    (window, key) groups are split at run time by the adaptive skew join. Streams have
    no such re-planning: there ``salts`` > 1 spreads a group over that many tasks, by
    a hash of the left row, and repeats the right rows as often.
    """
    salt = F.pmod(_row_hash(left), F.lit(salts)).cast("int").alias("_salt")
    lhs = left.select(
        tumbling(ts, width).alias("window"),
        key,
        F.struct(*left.columns).alias("l"),
        *([salt] if salts > 1 else []),
    )
    rhs = right.select(
        tumbling(ts, width).alias("window"), key, F.struct(*right.columns).alias("r")
    )
    on = ["window", key]
    if salts > 1:
        rhs = rhs.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on.append("_salt")
    return lhs.join(rhs, on).select("window", key, "l", "r")


def window_cogroup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    width: str,
    aggs: Sequence[Column] = (),
    marker: str = "yes",
) -> DataFrame:
    """One row per key and window present on either side.

    Columns ``window_start, key, n_left, n_right, marker`` and ``aggs``, which may use
    the fields of the structs ``l`` and ``r`` (null on rows of the other side). The two
    inputs are put under each other and aggregated before and after one shuffle, so
    a large group is never gathered, unless ``aggs`` asks for a list.
    """
    l_row, r_row = F.struct(*left.columns).alias("l"), F.struct(*right.columns).alias("r")
    l_type = left.select(l_row).schema["l"].dataType
    r_type = right.select(r_row).schema["r"].dataType
    lhs = left.select(ts, key, l_row, F.lit(None).cast(r_type).alias("r"))
    rhs = right.select(ts, key, F.lit(None).cast(l_type).alias("l"), r_row)
    is_left = F.col("l").isNotNull()
    return cogroup_tagged(lhs.unionByName(rhs), key, ts, width, is_left, aggs, marker)


def cogroup_tagged(
    both: DataFrame,
    key: str,
    ts: str,
    width: str,
    is_left: Column,
    aggs: Sequence[Column] = (),
    marker: str = "yes",
) -> DataFrame:
    """:func:`window_cogroup` of two inputs that already are one, read in one pass."""
    result = both.groupBy(tumbling(ts, width).alias("window"), key).agg(
        F.count_if(is_left).alias("n_left"), F.count_if(~is_left).alias("n_right"), *aggs
    )
    extra = [c for c in result.columns if c not in ("window", key, "n_left", "n_right")]
    return result.select(
        F.col("window.start").alias("window_start"),
        key,
        "n_left",
        "n_right",
        F.lit(marker).alias("marker"),
        *extra,
    )
