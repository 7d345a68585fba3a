"""Importance tiers: 1 for the core, 2 for niche articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import norm_title
from ..options import DEFAULT, Options


def tiers(articles: DataFrame, degrees: DataFrame | None, options: Options = DEFAULT) -> DataFrame:
    """articles with `indegree` and `tier`.  Without a link graph in-degree is null and its rule is off; with one,
    titles that it lacks have 0."""
    if degrees is None:
        rows = articles.withColumn("indegree", F.lit(None).cast("long"))
    else:
        rows = articles.withColumn("target", norm_title(F.col("title"))).join(degrees.select("target", "indegree"), "target", "left").drop("target").withColumn("indegree", F.coalesce("indegree", F.lit(0)))
    words = F.col("words")
    tier = (
        F.when(words >= options.rescue_words, 1)
        .when(F.col("title").rlike(P.FICTION_TITLE) | F.col("raw").rlike(P.FICTION_CATEGORY), 2)
        .when(F.col("raw").rlike(P.TAXON) & (words < options.taxon_words), 2)
        .when((F.col("indegree") < options.min_indegree) & (words < options.short_words), 2)
        .otherwise(1)
    )
    return rows.withColumn("tier", tier)
