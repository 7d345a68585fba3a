"""Connected components of links, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node of each component that `edges` (a, b) connect; nodes without a link are not in it.

    Large-star and small-star by turns until nothing changes, which takes a number of rounds that grows as the square of
    the logarithm of the links at most; each round is a table in the shared folder.
    """
    state = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    before = None
    while True:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).where("a != b").distinct()
        after = stored(small, "links")
        drop_stored(state)
        state = after
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = mark
