"""Audit of a rule change, and the demo slice of a store."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..options import DEFAULT, Options
from .classify import accepted, would_have_dropped


def rescued(pages: DataFrame, store_titles: DataFrame, options: Options = DEFAULT) -> DataFrame:
    """(title, words, chars, in_store): pages that the old rule dropped and the present rules accept."""
    old = pages.where(would_have_dropped(F.coalesce("raw", F.lit(""))))
    rows = accepted(old, options).select("title", "words", F.length("raw").cast("long").alias("chars"))
    known = store_titles.select("title").distinct().withColumn("in_store", F.lit(True))
    return rows.join(known, "title", "left").withColumn("in_store", F.coalesce("in_store", F.lit(False)))


def missing(pages: DataFrame, store_titles: DataFrame, options: Options = DEFAULT, n: int = 100) -> DataFrame:
    """The longest rescued pages that the store lacks: a report of n rows."""
    rows = rescued(pages, store_titles, options).where("not in_store")
    return rows.orderBy(F.desc("words"), "title").limit(n).select("title", "words", "chars")


def report(rows: DataFrame, path: str) -> None:
    rows.orderBy(F.desc("words"), "title").write.mode("overwrite").json(path)


def text_report(rows: DataFrame, n: int = 100) -> DataFrame:
    """(line, text): a heading with the numbers of rescued and missing pages, and the n longest missing ones."""
    rows = rows.select("title", "words", "in_store")
    counts = rows.agg(F.count("*").alias("all"), F.coalesce(F.count_if(~F.col("in_store")), F.lit(0)).alias("missing"))
    head = counts.select(F.lit(0).alias("line"), F.format_string("%d rescued, %d of them missing", "all", "missing").alias("text"))
    best = rows.where("not in_store").orderBy(F.desc("words"), "title").limit(n)
    ranked = best.select(F.row_number().over(Window.orderBy(F.desc("words"), "title")).alias("line"), F.format_string("%7d  %s", "words", "title").alias("text"))  # over n rows
    return head.unionByName(ranked)


def demo(articles: DataFrame, titles: list[str], extra: dict[str, str]) -> DataFrame:
    """Articles of the named titles and synthetic ones, renumbered as one part, ready for store.build()."""
    spark = articles.sparkSession
    named = articles.where(F.col("title").isin(titles)).select(F.lit(0).cast("long").alias("part"), "page_id", "title", "text")
    rows = [(0, -1 - i, title, text) for i, (title, text) in enumerate(extra.items())]
    return named.unionByName(spark.createDataFrame(rows, "part bigint, page_id bigint, title string, text string"))
