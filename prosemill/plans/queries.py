"""Registered queries over the driver's tables: one per operator or rule, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sanitize as san
from ..functions import text as tx
from ..operators import audit, classify, linkgraph, search, spelling, store
from ..options import Options
from ..sources import wiki
from . import build
from .adapter import dump_files, pages, text_files
from .stage import stage_root, staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: The adapter makes short corpora, so the store's queries use small chunks.
SMALL = Options(chunk_size=20)
DEMO_TITLES = ["Doc 0", "Doc 40", "Doc 41", "Doc 80", "Doc 99999"]
DEMO_EXTRA = {"Beispiel": "Ein Beispiel ist ein Text, der nicht im Bestand ist."}
MISSPELLED = ("tha", "thhe", "adn", "teh", "kategorie", "nicth", "ereh", "labell")
TERM = "ent"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _rule(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = classify.prepared(pages(spark, sf_dir))
        return rows.where(classify.raw_rules(F.col("title"), F.col("raw"))[name][1]).select("page_id")

    return run


for _name in ("f01_empty_title", "f02_namespace_title", "f03_list_title", "f04_redirect", "f05_disambiguation", "f06_stub", "f07_quality_template", "f08_promo_category", "f09_promo_title", "f10_year_title", "f11_date_title", "f12_episode_title", "f13_deletion_banner"):
    QUERIES[_name] = _rule(_name)


def _prose(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = classify.measured(classify.prepared(pages(spark, sf_dir)))
        return rows.where(classify.prose_rules()[name][1]).select("page_id")

    return run


for _name in ("f14_disguised", "f15_too_short", "f16_link_heavy"):
    QUERIES[_name] = _prose(_name)


def _raw(value: Callable[[Column], Column]) -> Query:
    """Length and digest of a function of the raw text."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = classify.once(pages(spark, sf_dir), "v", value(F.col("raw")))
        return rows.select("page_id", F.length("v").cast("long").alias("n"), F.md5(F.col("v").cast("binary")).alias("digest"))

    return run


QUERIES |= {
    "strip_comments": _raw(lambda c: san.step(c, "comments")),
    "strip_media_and_categories": _raw(lambda c: san.step(c, "image_links", "category_links")),
    "strip_refs": _raw(lambda c: san.step(c, "refs", "self_refs")),
    "strip_templates": _raw(lambda c: san.step(c, "templates")),
    "unwrap_links": _raw(lambda c: san.step(c, "wikilinks")),
    "strip_urls": _raw(lambda c: san.step(c, "url_url_links", "url_links", "bare_links", "urls")),
    "strip_bold": _raw(lambda c: san.step(c, "bold")),
    "strip_tables": _raw(lambda c: san.step(c, "tables")),
    "pipe_cleanup": _raw(lambda c: san.step(c, "pipe_lines", "row_breaks", "leading_pipes", "trailing_pipes", "inner_pipes")),
    "strip_ipa_coordinates": _raw(lambda c: san.step(c, "phonetics", "coordinate_templates", "coordinates")),
    "decode_entities": _raw(san.decode_entities),
    "strip_appendix": _raw(san.strip_appendix),
    "tidy_whitespace": _raw(san.tidy),
    "sanitize_full": _raw(san.sanitize),
    "lead_sample": _raw(lambda c: tx.lead_sample(c, 300)),
}


@query
def strip_tags_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = classify.once(rows, "v", san.step(F.col("html"), "comments", "tags"))
    return rows.select("page_id", F.length("v").cast("long").alias("n"), F.md5(F.col("v").cast("binary")).alias("digest"))


@query
def drop_reason_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify.classify_raw(pages(spark, sf_dir))
    return rows.groupBy(F.coalesce("reason", F.lit("passed")).alias("reason")).agg(F.count("*").alias("n"))


@query
def page_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.reasons(pages(spark, sf_dir))


@query
def accepted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.accepted(pages(spark, sf_dir)).select("page_id", "title", "words", "links", F.md5(F.col("text").cast("binary")).alias("digest"))


@query
def quality_exempt_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages(spark, sf_dir)
    return rows.where(F.col("raw").rlike(classify.P.QUALITY) & F.col("raw").rlike(classify.P.OUTDATED)).select("page_id")


@query
def future_banner_vs_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages(spark, sf_dir).where(F.col("raw").rlike(r"(?i)\{\{zukunft"))
    return rows.select("page_id", F.col("raw").rlike(classify.P.OUTLOOK).alias("banner"))


@query
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", tx.word_count(F.col("raw")).cast("long").alias("words"))


@query
def content_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", tx.content_links(F.col("raw")).cast("long").alias("links"))


@query
def norm_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", tx.norm_title(F.col("title")).alias("title"))


@query
def fnv_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", tx.fnv1a32(F.col("title")).alias("h"), tx.hex8(tx.fnv1a32(F.col("title"))).alias("hex8"))


@query
def links_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.page_links(pages(spark, sf_dir)).groupBy("page_id", "source", "target").agg(F.count("*").alias("n"))


@query
def redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.redirects(pages(spark, sf_dir))


@query
def redirect_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.closure(linkgraph.redirects(pages(spark, sf_dir)))


@query
def indegree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.indegrees(pages(spark, sf_dir))


@query
def indegree_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.indegrees(pages(spark, sf_dir), distinct=True).select("target", "indegree")


@query
def indegree_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.percentiles(linkgraph.indegrees(pages(spark, sf_dir)))


@query
def unlinked_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.unlinked(pages(spark, sf_dir))


@query
def title_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.sidecar(pages(spark, sf_dir))


@query
def indegree_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.lookup(linkgraph.indegrees(pages(spark, sf_dir)), ["doc_1", "Doc 2", "Nirgends"])


@query
def html_indegree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linkgraph.html_links(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return rows.groupBy("target").agg(F.count("*").alias("indegree"))


def _tiered(spark: SparkSession, sf_dir: str, graph: bool = True) -> DataFrame:
    return build.articles(pages(spark, sf_dir), graph=graph)[0]


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(classify.accepted(pages(spark, sf_dir)), "accepted")


@query
def tier_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiered(spark, sf_dir).select("page_id", "title", "words", "indegree", "tier")


@query
def tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiered(spark, sf_dir).groupBy("tier").agg(F.count("*").alias("n"), F.sum("words").alias("words"))


@query
def tier_without_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiered(spark, sf_dir, graph=False).select("page_id", "tier")


@query
def dedupe_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.dedupe(_accepted(spark, sf_dir)).select("part", "page_id", "title")


@query
def chunk_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.laid_out(store.dedupe(_accepted(spark, sf_dir)), SMALL).select("part", "page_id", "local_chunk", "offset", "length")


def _table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(store.build(_tiered(spark, sf_dir), SMALL), "articles")


@query
def merge_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir).select("id", "title", "content_sample", "chunk_id", "offset", "length", "tier")


@query
def store_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.stats(_table(spark, sf_dir))


@query
def chunk_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir)
    back = store.fetch(table, store.chunks(table, SMALL))
    return back.select("id", "title", F.md5(F.col("text").cast("binary")).alias("digest"))


@query
def compression_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.sweep(classify.accepted(pages(spark, sf_dir)).select("page_id", "text")).drop("mb_per_s")  # differs from run to run


@query
def fetch_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir)
    named = table.where(F.col("title") == "Doc 40")
    return store.fetch(named, store.chunks(table.join(named.select("chunk_id"), "chunk_id", "left_semi"), SMALL)).select("title", F.length("text").cast("long").alias("n"), F.md5(F.col("text").cast("binary")).alias("digest"))


@query
def token_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.frequencies(_table(spark, sf_dir))


def _vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spelling.vocabulary(spelling.frequencies(_table(spark, sf_dir))), "vocabulary")


@query
def vocab_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary(spark, sf_dir).select("idx", "word", "freq")


@query
def delete_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.delete_index(_vocabulary(spark, sf_dir))


@query
def delete_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.packed(spelling.delete_index(_vocabulary(spark, sf_dir))).agg(F.count("*").alias("entries"))


@query
def spell_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = _vocabulary(spark, sf_dir)
    asked = spark.createDataFrame([(w,) for w in MISSPELLED], "query string")
    return spelling.suggest(asked, vocab, spelling.delete_index(vocab))


@query
def trigram_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.postings(_table(spark, sf_dir))


@query
def search_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir)
    return search.match(table, search.postings(table), TERM).select("id", "title")


@query
def search_tier1_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir)
    return search.top(search.match(table, search.postings(table), TERM)).select("id", "title")


@query
def search_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.bm25(_table(spark, sf_dir), TERM, 10)


@query
def audit_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.rescued(pages(spark, sf_dir), _known_titles(spark, sf_dir))


@query
def audit_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.missing(pages(spark, sf_dir), _known_titles(spark, sf_dir))


def _known_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older store: the titles of pages of even id."""
    return pages(spark, sf_dir).where("page_id % 2 = 0").select("title")


@query
def demo_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.dedupe(_accepted(spark, sf_dir))
    return store.build(audit.demo(rows, DEMO_TITLES, DEMO_EXTRA)).select("id", "title", "chunk_id", "offset", "length")


@query
def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.text_report(audit.rescued(pages(spark, sf_dir), _known_titles(spark, sf_dir)))


def _page_digests(rows: DataFrame) -> DataFrame:
    return rows.select("page_id", "title", F.length("raw").cast("long").alias("n"), F.md5(F.col("raw").cast("binary")).alias("digest"))


@query
def dump_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter's pages, written as an XML dump and read back."""
    return _page_digests(wiki.dump(spark, dump_files(spark, sf_dir)))


@query
def dump_link_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_digests(wiki.dump(spark, dump_files(spark, sf_dir), missing_is_main=False, drop_nested=False))


@query
def dump_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts found by listing hold the pages that the folder does."""
    found = wiki.parts(spark, dump_files(spark, sf_dir), "part-*")
    return wiki.dump(spark, found).agg(F.count("*").alias("pages"), F.sum("page_id").alias("ids"))


@query
def extracted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wiki.extracted(spark, text_files(spark, sf_dir))
    return rows.select("title", F.length("raw").cast("long").alias("n"), F.md5(F.col("raw").cast("binary")).alias("digest"))


@query
def sidecar_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tab-separated sidecar, written in order of degree and read back."""
    path = f"{stage_root(spark)}/sidecar-{uuid.uuid4().hex}"
    linkgraph.write_sidecar(linkgraph.sidecar(pages(spark, sf_dir)), path)
    return linkgraph.read_sidecar(spark, path)


@query
def targets_by_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 most linked targets, ranked."""
    rows = linkgraph.by_degree(linkgraph.sidecar(pages(spark, sf_dir)), 100)
    return rows.select(F.row_number().over(Window.orderBy(F.desc("indegree"), "hash8", "title")).alias("place"), "hash8", "indegree", "title")


@query
def common_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.most_common(spelling.frequencies(_table(spark, sf_dir)))


@query
def build_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = staged(_tiered(spark, sf_dir), "tiered")
    return store.counts(pages(spark, sf_dir), kept, staged(store.build(kept, SMALL), "articles"))


@query
def bench_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiki.sample(pages(spark, sf_dir), 100).select("page_id", "title", F.length("text").cast("long").alias("n"))
