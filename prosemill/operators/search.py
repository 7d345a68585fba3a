"""Substring search over titles and lead samples: trigram postings, matching, BM25 ranking, fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import trigrams

#: Fixed values of the ranking function and of the columns' weights.
K1, B, TITLE_WEIGHT, SAMPLE_WEIGHT, LEAST_IDF = 1.2, 0.75, 10.0, 1.0, 1e-6


def postings(table: DataFrame) -> DataFrame:
    """(trigram, id, col, tf): col 0 is the title, 1 the sample.  Sorted by trigram within partitions, for storage."""
    rows = table.select("id", F.explode(F.array(F.struct(F.lit(0).alias("col"), F.col("title").alias("said")), F.struct(F.lit(1).alias("col"), F.col("content_sample").alias("said")))).alias("f"))
    each = rows.select("id", "f.col", F.explode(trigrams(F.col("f.said"))).alias("trigram"))
    return each.groupBy("trigram", "id", "col").agg(F.count("*").alias("tf"))


def _term(term: str) -> list[str]:
    low = term.lower()
    return sorted({low[i : i + 3] for i in range(len(low) - 2)})


def match(table: DataFrame, index: DataFrame, term: str) -> DataFrame:
    """Rows of table whose title or sample contains the term, letter case aside: candidates hold all of its trigrams in
    one column, then the substring is verified.  Terms under three characters match nothing."""
    grams = _term(term)
    if not grams:
        return table.limit(0)
    ids = index.where(F.col("trigram").isin(grams)).groupBy("id", "col").agg(F.count("*").alias("n")).where(F.col("n") == len(grams)).select("id").distinct()
    return table.join(ids, "id", "left_semi").where(contains(term))


def contains(term: str) -> Column:
    return F.contains(F.lower("title"), F.lit(term.lower())) | F.contains(F.lower("content_sample"), F.lit(term.lower()))


def top(hits: DataFrame, n: int = 5, tier: int | None = 1) -> DataFrame:
    rows = hits if tier is None else hits.where(F.col("tier") == tier)
    return rows.orderBy("id").limit(n)


def bm25(table: DataFrame, term: str, n: int = 10) -> DataFrame:
    """(id, title, score) of the matches, best (least) first.  The phrase counts as one term: its occurrences are
    weighted by column, a row's length is its number of trigrams."""
    low = F.lit(term.lower())
    length = lambda c: F.greatest(F.lit(0), F.length(F.lower(F.col(c))) - 2)
    times = lambda c: F.size(F.filter(F.sequence(F.lit(0), F.length(F.lower(F.col(c)))), lambda i: (i > 0) & (F.lower(F.col(c)).substr(i, F.lit(len(term))) == low)))
    rows = table.select("id", "title", (length("title") + length("content_sample")).alias("size"), F.when(F.contains(F.lower("title"), low), times("title")).otherwise(0).alias("a"), F.when(F.contains(F.lower("content_sample"), low), times("content_sample")).otherwise(0).alias("b"))
    whole = rows.agg(F.struct(F.count("*").alias("N"), F.avg("size").alias("mean"), F.count_if((F.col("a") > 0) | (F.col("b") > 0)).alias("hits"))).scalar()
    one = whole.getField
    idf = F.greatest(F.lit(LEAST_IDF), F.log((one("N") - one("hits") + 0.5) / (one("hits") + 0.5)))
    tf = TITLE_WEIGHT * F.col("a") + SAMPLE_WEIGHT * F.col("b")
    score = -idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("size") / one("mean")))
    return rows.where("a > 0 or b > 0").select("id", "title", F.round(score, 6).alias("score")).orderBy("score", "id").limit(n)
