"""Link graph: links, redirects, their closure, in-degrees and reports.

Keys are normalized titles; the 32-bit hash of a title is kept as a column, not as the key, so titles whose hashes
collide stay apart.  Redirects are resolved once, in their own table, then joined to the links.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import fnv1a32, hex8, link_targets, norm_title, strip
from ..options import DEFAULT
from ..plans.stage import staged


def redirect_target(raw: Column) -> Column:
    """Target named in the first 300 characters; empty if none."""
    return F.regexp_extract(F.substring(raw, 1, 300), P.REDIRECT_TARGET, 1)


def graph_pages(pages: DataFrame) -> DataFrame:
    """(page_id, part, title, is_redirect, redirect, targets); a malformed redirect is an ordinary page here."""
    raw = F.coalesce("raw", F.lit(""))
    rows = pages.select("page_id", "part", strip(F.coalesce("title", F.lit(""))).alias("title"), raw.alias("raw"), redirect_target(raw).alias("redirect"))
    return rows.select("page_id", "part", "title", (F.col("redirect") != "").alias("is_redirect"), "redirect", F.when(F.col("redirect") == "", link_targets(F.col("raw"))).alias("targets"))


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, source, target): every link occurrence, by normalized titles; empty targets and links to oneself are no links."""
    return _page_links(graph_pages(pages))


def _page_links(graph: DataFrame) -> DataFrame:
    rows = graph.where("not is_redirect").select("page_id", norm_title(F.col("title")).alias("source"), F.explode("targets").alias("t"))
    return rows.select("page_id", "source", norm_title(F.col("t")).alias("target")).where("target != '' and target != source")


def redirects(pages: DataFrame) -> DataFrame:
    """(source, target): of several redirects of a title the last by part and page."""
    return _redirects(graph_pages(pages))


def _redirects(graph: DataFrame) -> DataFrame:
    rows = graph.where("is_redirect").select("part", "page_id", norm_title(F.col("title")).alias("source"), norm_title(F.col("redirect")).alias("target"))
    rows = rows.where("source != '' and target != ''")
    return rows.groupBy("source").agg(F.max_by("target", F.struct("part", "page_id", "target")).alias("target"))


def closure(redirect: DataFrame, hops: int = DEFAULT.redirect_hops) -> DataFrame:
    """(source, final): where a link to a redirect ends, after at most `hops` steps; a step to a title already seen isn't taken.

    A round per step over tables, whatever the number of redirects; rows that have ended leave the rounds.
    """
    redirect = staged(redirect, "redirects")
    step = redirect.select(F.col("source").alias("at"), F.col("target").alias("next"))
    state = redirect.select("source", F.col("source").alias("at"), F.array("source").alias("seen"))
    ended = []
    for _ in range(hops):
        # a left join, as a title has one step at most
        moved = state.join(step, "at", "left").withColumn("go", F.col("next").isNotNull() & ~F.array_contains("seen", F.coalesce("next", F.lit(""))))
        after = staged(moved.select("source", F.when(F.col("go"), F.col("next")).otherwise(F.col("at")).alias("at"), F.when(F.col("go"), F.concat("seen", F.array("next"))).otherwise(F.col("seen")).alias("seen"), "go"), "redirect-walk")
        ended.append(after.where("not go").select("source", F.col("at").alias("final")))
        state = after.where("go").select("source", "at", "seen")
        if state.isEmpty():
            break
    return reduce(DataFrame.unionByName, ended, state.select("source", F.col("at").alias("final")))


def indegrees(pages: DataFrame, distinct: bool = False) -> DataFrame:
    """(target, h, indegree): link occurrences per resolved target, or with `distinct` the pages that link to it."""
    graph = staged(graph_pages(pages), "graph")
    final = closure(_redirects(graph)).withColumnRenamed("source", "target")
    ends = lambda counted: counted.join(final, "target", "left").withColumn("target", F.coalesce("final", "target"))
    # Occurrences are summed before the join, so that a target that many pages link to is one row there.
    keys = ["target", "page_id"] if distinct else ["target"]
    counted = ends(_page_links(graph).groupBy(*keys).agg(F.count("*").alias("n")))
    found = counted.groupBy("target").agg((F.countDistinct("page_id") if distinct else F.sum("n")).alias("indegree"))
    return found.select("target", fnv1a32(F.col("target")).alias("h"), "indegree")


def titles(pages: DataFrame) -> DataFrame:
    """(title, first_title): normalized titles of pages, redirects included, and the title as first seen."""
    rows = graph_pages(pages).where("title != ''")
    return rows.groupBy(norm_title(F.col("title")).alias("title")).agg(F.min_by("title", F.struct("part", "page_id")).alias("first_title"))


def sidecar(pages: DataFrame) -> DataFrame:
    """(hash8, indegree, title), '?' for targets without a page."""
    known = titles(pages).withColumnRenamed("title", "target")
    return indegrees(pages).join(known, "target", "left").select(hex8(F.col("h")).alias("hash8"), "indegree", F.coalesce("first_title", F.lit("?")).alias("title"))


def by_degree(rows: DataFrame, n: int | None = None) -> DataFrame:
    """The sidecar from the most linked target on, ties by hash and title; its first n rows, or all."""
    ordered = rows.orderBy(F.desc("indegree"), "hash8", "title")
    return ordered if n is None else ordered.limit(n)


def write_sidecar(rows: DataFrame, path: str) -> None:
    """Tab-separated files in order of degree, without quotes or header; tabs and line ends in titles become spaces."""
    plain = rows.withColumn("title", F.translate("title", "\t\r\n", "   "))
    by_degree(plain).select("hash8", "indegree", "title").write.option("sep", "\t").option("quote", "\u0000").option("emptyValue", "").mode("overwrite").csv(path)


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("quote", "\u0000").schema("hash8 string, indegree bigint, title string").csv(path)


def unlinked(pages: DataFrame) -> DataFrame:
    return titles(pages).join(indegrees(pages).withColumnRenamed("target", "title"), "title", "left_anti").select("title")


def percentiles(degrees: DataFrame, at: tuple[int, ...] = (10, 50, 90, 99)) -> DataFrame:
    """(p, indegree): nearest rank, index min(n - 1, floor(n p)) of the sorted degrees, from a histogram of degrees."""
    spark = degrees.sparkSession
    histogram = degrees.groupBy("indegree").agg(F.count("*").alias("n"))
    upto = Window.orderBy("indegree")  # over distinct degrees, not targets
    ranked = histogram.select("indegree", F.sum("n").over(upto).alias("last"), (F.sum("n").over(upto) - F.col("n")).alias("first"), F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    wanted = spark.createDataFrame([(p,) for p in at], "p int")
    index = F.least(F.col("total") - 1, F.floor(F.col("total") * F.col("p") / 100))
    hit = ranked.select("*", F.explode(F.array(*(F.lit(p) for p in at))).alias("p")).withColumn("index", index).where("index >= first and index < last")
    return hit.join(F.broadcast(wanted), "p").select("p", "indegree")


def lookup(degrees: DataFrame, names: list[str]) -> DataFrame:
    """(title, indegree) of named titles, 0 where there is no link."""
    asked = degrees.sparkSession.createDataFrame([(n,) for n in names], "title string").withColumn("target", norm_title(F.col("title")))
    return asked.join(degrees, "target", "left").select("title", F.coalesce("indegree", F.lit(0)).alias("indegree"))


def html_links(pages: DataFrame) -> DataFrame:
    """(page_id, title, target) of raw html: local links."""
    rows = pages.select("page_id", F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"), F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1))).alias("target"))
    return rows.where("target != ''").withColumn("target", norm_title(F.col("target"))).where("target != ''")
