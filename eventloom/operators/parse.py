"""Typed rows from text lines."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _field(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.IntegralType):
        # A cast would forgive white space around a whole number.
        text = F.when(text.rlike(r"^[+-]?[0-9]+\z"), text)
    return text.try_cast(kind)


def parse_delimited(
    df: DataFrame, schema: T.StructType | str, sep: str = ",", value: str = "value"
) -> DataFrame:
    """Cut each line at ``sep`` and cast by position. No quoting, extra fields ignored.

    One missing or malformed field fails the job, also when its column is not used
    later: the check sits in a filter, which column pruning keeps.
    """
    fields = _struct(schema).fields
    # As the output of a generator the line is cut once, not once per field and filter.
    cut = df.select(value, F.explode(F.array(F.split(F.col(value), re.escape(sep)))).alias("_p"))
    typed = cut.select(
        F.col(value).alias("_line"),
        *[_field(F.get("_p", F.lit(i)), f.dataType).alias(f.name) for i, f in enumerate(fields)],
    )
    complete = F.lit(True)
    for field in fields:
        complete = complete & F.col(field.name).isNotNull()
    message = F.concat(F.lit("bad line: "), F.coalesce("_line", F.lit("null")))
    checked = F.when(complete, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return typed.where(checked).drop("_line")


def parse_json(
    df: DataFrame,
    schema: T.StructType | str,
    value: str = "value",
    into: str = "doc",
    strict: bool = False,
) -> DataFrame:
    """Add the parsed line as struct ``into`` and a flag ``bad``.

    A line that is not just one JSON object, or that has a field of another type than
    ``schema``, is bad and keeps its text; with ``strict`` it raises instead.
    """
    # The parser stops at the end of the first value, so the line is put into a list that a
    # mark with its length ends. A line with more than one object, or one that closes the list
    # itself, leaves the list without the mark as its second element; the names in use
    # are drawn anew for each plan, so no line can hold them.
    name = uuid.uuid4().hex
    text = F.concat(
        F.lit(f'{{"{name}":['), F.col(value), F.lit(f',{{"{name}":'), F.length(value), F.lit("}]}")
    )
    element = T.StructType([*_struct(schema).fields, T.StructField(name, T.LongType())])
    full = T.StructType([T.StructField(name, T.ArrayType(element)), T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(text, full, {"columnNameOfCorruptRecord": CORRUPT})
    # As the output of a generator the struct is computed once; as a plain column it
    # would be parsed again in every filter that is pushed below this step.
    out = df.select("*", F.explode(F.array(parsed)).alias("_json"))
    both = F.col(f"_json.{name}")
    first, mark = F.get(both, F.lit(0)), F.get(both, F.lit(1))
    doc = first.dropFields(name)
    good = (
        F.col(f"_json.{CORRUPT}").isNull()
        & (F.size(both) == 2)
        & first.isNotNull()
        & first[name].isNull()
        & (mark[name] == F.length(value))
    )
    bad = ~F.coalesce(good, F.lit(False))
    if strict:
        bad = F.when(~bad, F.lit(False)).otherwise(
            F.raise_error(F.concat(F.lit("bad JSON line: "), F.coalesce(value, F.lit("null")))).cast("boolean")
        )
    return out.withColumn(into, doc).withColumn("bad", bad).drop("_json")


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("bad"))


def quarantine(parsed: DataFrame, into: str = "doc") -> DataFrame:
    """The bad lines with their raw text and whatever columns came with them."""
    return parsed.where(F.col("bad")).drop(into, "bad")
