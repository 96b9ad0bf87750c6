import pytest
from pyspark.sql import functions as F

from eventloom.functions import key_label, path_stem, split_whitespace

TOKENS = {
    "a b ": ["a", "b"],
    "": [""],
    "   ": [],
    "\t\n": [],
    " a": ["", "a"],
    "a  b": ["a", "", "b"],
    "a\tb": ["a", "b"],
    "a\x0bb\x0cc\rd\n": ["a", "b", "c", "d"],
    "a b": ["a b"],
    None: None,
}

STEMS = {
    "a/b.json": "b",
    "b.json.json": "b.json",
    "a/b.json.bak": "b",
    "x/.json": "",
    "nojson": "",
    "a.json/b": "",
    "a/b.json.jsonx": "b.json",
    "deep/er/P1.json": "P1",
    None: None,
}


def test_split_whitespace(spark):
    df = spark.createDataFrame([(k,) for k in TOKENS], "v string")
    got = {r.v: r.t for r in df.select("v", split_whitespace(F.col("v")).alias("t")).collect()}
    assert got == TOKENS


def test_path_stem(spark):
    df = spark.createDataFrame([(k,) for k in STEMS], "v string")
    got = {r.v: r.t for r in df.select("v", path_stem(F.col("v")).alias("t")).collect()}
    assert got == STEMS


@pytest.mark.parametrize("path", ["nojson", "a.json/b"])
def test_path_stem_strict_raises(spark, path):
    df = spark.createDataFrame([(path,)], "v string")
    with pytest.raises(Exception, match="no .json file name"):
        df.select(path_stem(F.col("v"), strict=True)).collect()
    ok = spark.createDataFrame([("a/b.json",), (None,)], "v string")
    rows = ok.select(path_stem(F.col("v"), strict=True).alias("t")).collect()
    assert [r.t for r in rows] == ["b", None]


def test_key_label(spark):
    df = spark.createDataFrame([("red", 1)], "k string, n int")
    row = df.select(key_label(F.col("k")).alias("a"), key_label(F.col("n")).alias("b")).first()
    assert (row.a, row.b) == ("(red)", "(1)")
