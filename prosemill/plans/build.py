"""Whole builds: link graph, articles, store, search index, spelling dictionary, with checks between the stages."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import classify, linkgraph, search, spelling, store, tiering
from ..options import DEFAULT, SCHEMA_VERSION, Options
from .stage import hadoop_path, resumed, signature, staged


@dataclass(frozen=True)
class Corpus:
    articles: DataFrame
    chunks: DataFrame
    postings: DataFrame
    vocabulary: DataFrame
    deletes: DataFrame
    degrees: DataFrame | None


Keep = Callable[[Callable[[], DataFrame], str], DataFrame]


def _staged(make: Callable[[], DataFrame], tag: str) -> DataFrame:
    return staged(make(), tag)


def articles(pages: DataFrame, options: Options = DEFAULT, graph: bool = True, link_pages: DataFrame | None = None, keep: Keep = _staged) -> tuple[DataFrame, DataFrame | None]:
    """Accepted pages with tiers, staged, and the in-degrees of `link_pages`, or of the pages; without a graph its tier
    rule is off."""
    degrees = keep(lambda: linkgraph.indegrees(pages if link_pages is None else link_pages), "degrees") if graph else None
    kept = keep(lambda: classify.accepted(pages, options), "accepted")
    return tiering.tiers(kept, degrees, options), degrees


def corpus(pages: DataFrame, options: Options = DEFAULT, graph: bool = True, link_pages: DataFrame | None = None, work: str | None = None) -> Corpus:
    """A whole build.  With a folder `work` its stages are kept there under a signature of input files, options and schema
    version: a later run of the same signature goes on where one stopped, another signature starts anew."""
    spark, keep = pages.sparkSession, _staged
    if work:
        both = pages if link_pages is None else pages.select("title").unionByName(link_pages.select("title"))
        sign = signature(both, options, graph, SCHEMA_VERSION)
        keep = lambda make, tag: resumed(spark, work, tag, sign, make)
    kept, degrees = articles(pages, options, graph, link_pages, keep)
    table = keep(lambda: store.build(kept, options), "articles")
    store.check(table)
    vocab = keep(lambda: spelling.vocabulary(spelling.frequencies(table, options), options), "vocabulary")
    return Corpus(table, store.chunks(table, options), search.postings(table), vocab, spelling.delete_index(vocab), degrees)


def publish(built: Corpus, path: str) -> None:
    """Tables in a new version folder under path, a marker last; the version before stays for those who
    have it open, older ones go.  What readers open is the newest version with a marker, wherever a publish stops."""
    spark = built.articles.sparkSession
    files, _ = hadoop_path(spark, path)
    version = f"v{max([int(v[1:]) for v in _versions(spark, path)], default=0) + 1:06d}"
    folder = f"{path}/{version}"
    files.delete(hadoop_path(spark, folder)[1], True)
    built.articles.drop("text").write.parquet(f"{folder}/articles")
    built.chunks.write.parquet(f"{folder}/chunks")
    # by range of (trigram, id), so that the postings of a frequent trigram are dealt to many files
    built.postings.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "trigram", "id").sortWithinPartitions("trigram", "id", "col").write.parquet(f"{folder}/postings")
    built.vocabulary.write.parquet(f"{folder}/vocabulary")
    built.deletes.sort("h", "idx").write.parquet(f"{folder}/deletes")
    if built.degrees is not None:
        built.degrees.write.parquet(f"{folder}/degrees")
    marker = spark.createDataFrame([(json.dumps({"schema_version": SCHEMA_VERSION}),)], "value string").coalesce(1)
    marker.write.text(f"{folder}/_meta")
    for old in _versions(spark, path)[:-2]:
        if old != version:
            files.delete(hadoop_path(spark, f"{path}/{old}")[1], True)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the version folders under path, finished or not, in order."""
    files, top = hadoop_path(spark, path)
    names = [x.getPath().getName() for x in files.listStatus(top)] if files.exists(top) else []
    return sorted((n for n in names if re.fullmatch(r"v[0-9]{6,}", n)), key=lambda n: int(n[1:]))


def published(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest whole build under path of the present schema version, which a resumed run may keep."""
    for version in reversed(_versions(spark, path)):
        files, done = hadoop_path(spark, f"{path}/{version}/_meta/_SUCCESS")
        if files.exists(done) and json.loads(spark.read.text(f"{path}/{version}/_meta").first()["value"])["schema_version"] == SCHEMA_VERSION:
            return f"{path}/{version}"
    return None


def opened(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the newest whole build under path."""
    folder = published(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no finished build of schema version {SCHEMA_VERSION} in {path}")
    names = ("articles", "chunks", "postings", "vocabulary", "deletes", "degrees")
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names if hadoop_path(spark, folder)[0].exists(hadoop_path(spark, f"{folder}/{n}")[1])}
