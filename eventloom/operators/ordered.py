"""Work that depends on the order of single rows, split so that no key meets one task.

A key's rows are cut into parts that follow one another, by range partitioning on key and
order. This spreads any key, also one with all its rows at one time. A running value is then the
value within the part plus the sum of the key's earlier parts. There is one plan at every size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from eventloom.session import stage_table

PART = "_part"


def _with_key(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with columns that name its key, none of them null, so that joins find it."""
    names = []
    for i, key in enumerate(keys):
        kind = df.schema[key].dataType
        if isinstance(kind, (T.StringType, T.NumericType)):
            stand_in = F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)
            df = df.withColumn(f"_key{i}", F.coalesce(key, stand_in))
            df = df.withColumn(f"_keynull{i}", F.col(key).isNull())
            names += [f"_key{i}", f"_keynull{i}"]
        else:
            df = df.withColumn(f"_key{i}", F.struct(key))
            names.append(f"_key{i}")
    if not names:
        return df.withColumn("_key", F.lit(0)), ["_key"]
    return df, names


def _borders(sums: DataFrame, names: list[str]) -> DataFrame:
    """``(key, _part, _before, _after)``: sums over the earlier and later parts of the key."""
    parts = Window.partitionBy(*names).orderBy(PART)
    before = F.sum("_sum").over(parts.rowsBetween(Window.unboundedPreceding, -1))
    after = F.sum("_sum").over(parts.rowsBetween(1, Window.unboundedFollowing))
    return (
        sums.select(*names, PART, before.alias("_before"), after.alias("_after"))
        # A key with one part needs no row here.
        .where(F.col("_before").isNotNull() | F.col("_after").isNotNull())
    )


def _cut(df: DataFrame, names: list[str], order: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with its part in ``_part``, and the borders of the parts."""
    ranged = df.repartitionByRange(*names, *order).withColumn(PART, F.spark_partition_id())
    # Written once: a second evaluation could draw the range borders elsewhere.
    parted = stage_table(ranged, "ordered")
    sums = parted.groupBy(*names, PART).agg(F.sum(value).alias("_sum"))
    # Only keys that cross a partition border are left: at most two rows per partition.
    return parted, F.broadcast(_borders(sums, names))


def _to_here(names: list[str], order: list[str]) -> WindowSpec:
    return (
        Window.partitionBy(*names, PART)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    out: str = "total",
) -> DataFrame:
    """Add the sum of ``value`` over this and all earlier rows of the same key.

    One output row per input row. ``order`` must name a unique order within a key; with
    no ``keys`` the whole table is one sequence. Tables only; select the columns that
    are wanted before, since all of them are shuffled.
    """
    keyed, names = _with_key(df, keys)
    counted = keyed.withColumn("_value", F.coalesce(value, F.lit(0)))
    parted, borders = _cut(counted, names, order, "_value")
    local = parted.withColumn("_local", F.sum("_value").over(_to_here(names, order)))
    total = F.col("_local") + F.coalesce("_before", F.lit(0))
    return local.join(borders, [*names, PART], "left").select(*df.columns, total.alias(out))


def number_segments(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    is_delimiter: Column,
) -> DataFrame:
    """Add to each row the segment it is in, and whether that segment has been closed.

    New columns: ``segment`` (number of delimiters before the row), ``is_mark`` (the row
    is a delimiter), ``closed``, and what places the row: its key columns and ``_part``.
    """
    keyed, names = _with_key(df, keys)
    marked = keyed.withColumn("_mark", F.coalesce(is_delimiter, F.lit(False)).cast("bigint"))
    parted, borders = _cut(marked, names, order, "_mark")
    counted = parted.withColumn("_seen", F.sum("_mark").over(_to_here(names, order))).withColumn(
        "_in_part", F.sum("_mark").over(Window.partitionBy(*names, PART))
    )
    is_mark = F.col("_mark") == 1
    ends_here = F.col("_seen") < F.col("_in_part")
    ends_later = F.coalesce("_after", F.lit(0)) > 0
    segment = F.col("_seen") - F.col("_mark") + F.coalesce("_before", F.lit(0))
    return counted.join(borders, [*names, PART], "left").select(
        *df.columns,
        *names,
        PART,
        segment.alias("segment"),
        is_mark.alias("is_mark"),
        (is_mark | ends_here | ends_later).alias("closed"),
    )


def collect_segments(
    numbered: DataFrame, keys: list[str], order: list[str], value: str
) -> DataFrame:
    """``(keys, segment, n, items)`` for the closed, non-empty segments.

    Open tails and delimiters are left out before anything is collected. A segment is
    first put together per part, then from these pieces.
    """
    text = F.coalesce(F.col(value).cast("string"), F.lit("null")).alias("_text")
    members = numbered.where(F.col("closed") & ~F.col("is_mark"))
    in_order = F.array_sort(F.collect_list(F.struct(*order, text)))
    # By the columns the rows already are partitioned by; the key itself comes along.
    names = [c for c in numbered.columns if c.startswith("_key")]
    key = [F.any_value(c).alias(c) for c in keys]
    pieces = (
        members.groupBy(*names, PART, "segment")
        .agg(in_order.alias("_rows"), *key)
        .select(
            *names,
            *keys,
            PART,
            "segment",
            F.size("_rows").alias("_n"),
            F.concat(F.array_join("_rows._text", " "), F.lit(" ")).alias("_piece"),
        )
    )
    by_part = F.array_sort(F.collect_list(F.struct(PART, "_piece")))
    return (
        pieces.groupBy(*keys, "segment")
        .agg(F.sum("_n").cast("int").alias("n"), by_part.alias("_pieces"))
        .select(*keys, "segment", "n", F.array_join("_pieces._piece", "").alias("items"))
    )


def delimiter_segments(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    is_delimiter: Column,
) -> DataFrame:
    """The rows between delimiters, as ``(keys, segment, n, items)``.

    ``items`` is every value followed by a blank. A segment is emitted when its closing
    delimiter is there and it is not empty; delimiters themselves are not part of it.
    """
    marked = df.withColumn("_delim", is_delimiter).select(*dict.fromkeys([*keys, *order, value, "_delim"]))
    numbered = number_segments(marked, keys, order, F.col("_delim"))
    return collect_segments(numbered, keys, order, value)


FAN = 256  # rows, or blocks of rows, that are combined in one array


def _boxed(value: Column, kind: str) -> Column:
    """A value in a struct, so that no value at all and a null one differ; the field is always nullable."""
    return F.struct(value.alias("v")).cast(f"struct<v:{kind}>")


def _running_array(values: Column, combine: Callable[[Column, Column], Column], kind: str) -> Column:
    """The inclusive scan of a short array of one-field structs ``v``."""

    def step(done: Column, x: Column) -> Column:
        one = F.when(F.size(done) == 0, x).otherwise(_boxed(combine(F.element_at(done, -1)["v"], x["v"]), kind))
        return F.concat(done, F.array(one))

    return F.aggregate(values, F.array().cast(f"array<struct<v:{kind}>>"), step)


def _block_carries(
    blocks: DataFrame, names: list[str], combine: Callable[[Column, Column], Column], kind: str, rows: int
) -> DataFrame:
    """``(key, _part, _block, _carry)``: what comes before each block of its part, from ``(..., _block, _v)``.

    Blocks are combined ``FAN`` at a time, and what comes of that again, until ``rows`` rows
    of a part would be one block. The first block of a part has no row.
    """
    place = [*names, PART]
    grouped = blocks.groupBy(*place, F.floor(F.col("_block") / FAN).alias("_upper")).agg(
        F.array_sort(F.collect_list(F.struct("_block", _boxed(F.col("_v"), kind).alias("s")))).alias("_in")
    )
    scanned = grouped.withColumn("_run", _running_array(F.col("_in.s"), combine, kind))
    before = F.transform(
        "_in",
        lambda b, i: F.struct(b["_block"].alias("_block"), F.when(i > 0, F.get("_run", i - 1)).alias("own")),
    )
    if rows <= FAN:
        rest = scanned.select(*place, F.explode(before).alias("_b"))
        return rest.where("_b.own is not null").select(*place, "_b._block", F.col("_b.own").alias("_carry"))
    upper = scanned.select(*place, F.col("_upper").alias("_block"), F.element_at("_run", -1)["v"].alias("_v"))
    above = _block_carries(upper, names, combine, kind, rows // FAN).withColumnRenamed("_block", "_upper")
    joined = scanned.join(above, [*place, "_upper"], "left").select(*place, F.explode(before).alias("_b"), "_carry")
    both = (
        F.when(F.col("_carry").isNull(), F.col("_b.own"))
        .when(F.col("_b.own").isNull(), F.col("_carry"))
        .otherwise(_boxed(combine(F.col("_carry.v"), F.col("_b.own.v")), kind))
    )
    return joined.select(*place, "_b._block", both.alias("_carry")).where("_carry is not null")


def running_reduce(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    combine: Callable[[Column, Column], Column],
    out: str = "total",
    rows_per_part: int = 1 << 24,
) -> DataFrame:
    """Add ``combine`` over the values of this and all earlier rows of the same key, in order.

    ``combine(earlier, later)`` is any associative expression of the type of ``value``; it need not
    commute and says itself what nulls mean, e.g. ``lambda a, b: F.coalesce(b, a)`` for the last
    known value. As for :func:`running_total`, ``order`` must be unique within a key and no key is
    one task: a parallel scan combines ``FAN`` rows, then as many of these blocks, and so on, and at
    last the parts of a key. No array holds more than ``FAN`` rows, or one row a part of the key;
    parts of more than ``rows_per_part`` rows only make the uppermost arrays longer. Tables only.
    """
    keyed, names = _with_key(df, keys)
    kind = df.schema[value].dataType.simpleString()
    place = [*names, PART]
    parted = stage_table(
        keyed.repartitionByRange(*names, *order).withColumn(PART, F.spark_partition_id()), "ordered"
    )
    in_part = Window.partitionBy(*place).orderBy(*order)
    numbered = parted.withColumn("_block", F.floor((F.row_number().over(in_part) - 1) / FAN))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    in_order = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), row.alias("row"))))
    blocks = numbered.groupBy(*place, "_block").agg(in_order.alias("_rows"))
    values = F.transform("_rows", lambda r: _boxed(r["row"][value], kind))
    blocks = blocks.withColumn("_run", _running_array(values, combine, kind))
    # Read three times below: the rows, the blocks' own results and those of the parts.
    blocks = stage_table(blocks.select(*place, "_block", "_rows.row", "_run"), "ordered-blocks")

    totals = blocks.select(*place, "_block", F.element_at("_run", -1)["v"].alias("_v"))
    carries = _block_carries(totals, names, combine, kind, max(FAN, rows_per_part // FAN))
    last = totals.groupBy(*place).agg(F.max("_block").alias("_block"))
    ends = totals.join(last, [*place, "_block"]).join(carries, [*place, "_block"], "left")
    whole = F.when(F.col("_carry").isNull(), F.col("_v")).otherwise(combine(F.col("_carry.v"), F.col("_v")).cast(kind))
    # One row a part and key; only keys that cross a border of parts are left, so it is broadcast.
    by_key = (
        ends.select(*names, F.struct(PART, _boxed(whole, kind).alias("s")).alias("p"))
        .groupBy(*names)
        .agg(F.array_sort(F.collect_list("p")).alias("_parts"))
        .where(F.size("_parts") > 1)
        .withColumn("_run", _running_array(F.col("_parts.s"), combine, kind))
    )
    earlier = F.transform("_parts", lambda p, i: F.struct(p[PART].alias(PART), F.when(i > 0, F.get("_run", i - 1)).alias("s")))
    borders = by_key.select(*names, F.explode(earlier).alias("_p")).where("_p.s is not null")
    borders = borders.select(*names, F.col(f"_p.{PART}").alias(PART), F.col("_p.s").alias("_before"))

    joined = blocks.join(carries, [*place, "_block"], "left").join(F.broadcast(borders), place, "left")
    start = (
        F.when(F.col("_before").isNull(), F.col("_carry"))
        .when(F.col("_carry").isNull(), F.col("_before"))
        .otherwise(_boxed(combine(F.col("_before.v"), F.col("_carry.v")), kind))
    )
    rows = joined.select(start.alias("_start"), F.explode(F.arrays_zip("row", "_run")).alias("_r"))
    own = F.col("_r._run.v")
    result = F.when(F.col("_start").isNull(), own).otherwise(combine(F.col("_start.v"), own).cast(kind))
    return rows.select("_r.row.*", result.alias(out))
