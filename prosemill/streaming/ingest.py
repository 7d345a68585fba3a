"""Incremental ingest: pages arrive as files, are classified and sanitized without state, and land in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.classify import accepted
from ..options import DEFAULT, Options

PAGES = "page_id bigint, part bigint, title string, raw string"


def pages(spark: SparkSession, path: str, schema: str = PAGES) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def ingest(rows: DataFrame, out: str, state: str, options: Options = DEFAULT) -> StreamingQuery:
    """Accepted articles appended to `out`, all that is there now; a later call goes on from `state`.  Of repeated titles the
    store keeps the first (store.dedupe)."""
    articles = accepted(rows, options).select("page_id", "part", "title", "text", "words", "links")
    return articles.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()


def reason_counts(rows: DataFrame, name: str) -> StreamingQuery:
    """Running histogram of raw-rule reasons in a memory table."""
    from ..operators.classify import classify_raw

    counts = classify_raw(rows).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))
    return counts.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
