"""A content log is parsed once and its lines are not shuffled to find their place."""

from pyspark.sql import functions as F

from eventloom.operators import ordered
from eventloom.plans import catalog
from eventloom.sources import read_positions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_parsed_once(spark, new_folder, monkeypatch):
    folder = new_folder("content")
    line = [F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit("R").alias("l_returnflag")]
    spark.range(300).select(*line).write.parquet(f"{folder}/lineitem.parquet")
    cut, running_total = [], ordered.running_total

    def watched(df, *args):
        cut.append(df)
        return running_total(df, *args)

    monkeypatch.setattr(ordered, "running_total", watched)
    got = {(r["id"], r["ctype"]): r["total"] for r in catalog.content_running(spark, folder).collect()}
    assert got == {(f"{i}-1", ctype): i + 1 for i in range(300) for ctype in "R1"}
    # A cut by range evaluates its input twice.
    assert "Generate" not in plan(cut[0]) and "Scan parquet" in plan(cut[0])


def test_lines_are_joined_with_few_blocks(spark, new_folder):
    folder = new_folder("lines") + "/log"
    spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256)).repartition(3).write.text(folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        placed = read_positions(spark, folder)
        assert "SortMergeJoin" not in plan(placed)
        files = placed.groupBy("file").agg(F.any_value("file_path").alias("p"), F.count_distinct("file_path").alias("n"))
        rows = files.orderBy("file").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [r["file"] for r in rows] == [0, 1, 2] and all(r["n"] == 1 for r in rows)
    assert [r["p"] for r in rows] == sorted(r["p"] for r in rows)
