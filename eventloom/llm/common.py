"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once even if lambdas below use it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole_text(column: str = "text") -> Column:
    """The text as a string, null as the empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def space_words(text: Column) -> Column:
    """Maximal runs of other characters than ``SPACE``."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; a null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def extended(df: DataFrame, new: str, without: tuple[str, ...] = ()) -> StructType:
    """The columns of ``df`` but ``without``, and those of the definition ``new``."""
    return StructType([f for f in df.schema.fields if f.name not in without] + StructType.fromDDL(new).fields)


def as_row(df: DataFrame) -> Column:
    """All columns in one, so that names an operator adds can't clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])
