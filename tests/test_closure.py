"""Redirect closure beyond the row limit of recursive SQL."""

from pyspark.sql import functions as F

from prosemill.operators import linkgraph


def test_closure_of_over_a_million_rows(spark):
    n = 1_100_000
    one = spark.range(n).select(F.concat(F.lit("r"), "id").alias("source"), F.concat(F.lit("t"), "id").alias("target"))
    chain = spark.createDataFrame([(f"c{i}", f"c{i + 1}") for i in range(20)] + [("x", "y"), ("y", "x"), ("s", "s")], "source string, target string")
    got = linkgraph.closure(one.unionByName(chain)).cache()
    assert got.count() == got.select("source").distinct().count() == n + 23
    assert got.where("source like 'r%' and substr(source, 2) = substr(final, 2) and final like 't%'").count() == n
    rest = {r["source"]: r["final"] for r in got.where("source not like 'r%'").collect()}
    assert rest == {f"c{i}": f"c{min(i + 16, 20)}" for i in range(20)} | {"x": "y", "y": "x", "s": "s"}
