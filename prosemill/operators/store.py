"""Article store: first title wins, articles are numbered, packed into chunks and compressed.

Numbers come in two phases, counts per stretch of page ids, then a running sum over the stretches, so no window
ever holds a whole part.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions.text import lead_sample
from ..options import DEFAULT, Options

STRETCH = 4096


def dedupe(articles: DataFrame) -> DataFrame:
    """The first article of each title, by part and page."""
    best = articles.groupBy("title").agg(F.min(F.struct("part", "page_id")).alias("first")).select("title", "first.part", "first.page_id")
    return articles.join(best, ["title", "part", "page_id"], "left_semi").dropDuplicates(["title"])


def numbered(rows: DataFrame, name: str = "n") -> DataFrame:
    """rows with a number from 0 within each part, by page_id."""
    rows = rows.withColumn("_stretch", F.floor(F.col("page_id") / STRETCH))
    counts = rows.groupBy("part", "_stretch").agg(F.count("*").alias("_count"))
    before = F.coalesce(F.sum("_count").over(Window.partitionBy("part").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("part", "_stretch").orderBy("page_id"))
    return rows.join(counts.select("part", "_stretch", before.alias("_before")), ["part", "_stretch"]).withColumn(name, (F.col("_before") + within - 1).cast("long")).drop("_stretch", "_before")


def _bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def laid_out(articles: DataFrame, options: Options = DEFAULT) -> DataFrame:
    """articles with local_chunk (from 1 in each part), byte offset and length in the chunk."""
    rows = numbered(articles).withColumn("local_chunk", F.floor(F.col("n") / options.chunk_size) + 1)
    before = Window.partitionBy("part", "local_chunk").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("length", _bytes(F.col("text"))).withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def merged(rows: DataFrame) -> DataFrame:
    """Laid-out rows with chunk_id and id, dense from 1 over all parts in their order."""
    parts = rows.groupBy("part").agg(F.max("local_chunk").alias("chunks"), F.count("*").alias("articles"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over parts
    base = parts.select("part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("chunks", "articles")))
    return rows.join(base, "part").withColumn("chunk_id", F.col("chunks_before") + F.col("local_chunk")).withColumn("id", F.col("articles_before") + F.col("n") + 1).drop("chunks_before", "articles_before")


def build(articles: DataFrame, options: Options = DEFAULT) -> DataFrame:
    """The articles table before compression: (id, title, content_sample, chunk_id, offset, length, tier, text)."""
    rows = merged(laid_out(dedupe(articles), options))
    tier = F.col("tier") if "tier" in articles.columns else F.lit(1)
    return rows.select("id", "title", lead_sample(F.col("text"), options.sample_chars).alias("content_sample"), "chunk_id", "offset", "length", tier.alias("tier"), "text")


def compressor(level: int, window_log: int):  # noqa: ANN201
    import zstandard

    if level < 19:
        return zstandard.ZstdCompressor(level=level)
    return zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(level, window_log=window_log, enable_ldm=True))


def chunks(table: DataFrame, options: Options = DEFAULT) -> DataFrame:
    """(chunk_id, data): one frame per chunk, of its texts in order of offset.  Rows stream sorted, one chunk at a time."""
    rows = table.select("chunk_id", "offset", "text").repartition("chunk_id").sortWithinPartitions("chunk_id", "offset")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, now, parts = compressor(options.level, options.window_log), None, []
        done = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([press.compress(b"".join(parts))], pa.binary())], names=["chunk_id", "data"])
        for batch in batches:
            for chunk, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if now is not None and chunk != now:
                    yield done()
                    parts = []
                now = chunk
                parts.append((text or "").encode())
        if now is not None:
            yield done()

    return rows.mapInArrow(run, "chunk_id bigint, data binary")


@F.pandas_udf(BinaryType())
def decompressed(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
    import zstandard

    reader = zstandard.ZstdDecompressor()
    for series in frames:
        yield series.map(lambda x: None if x is None else reader.decompress(x, max_output_size=1 << 31))


def fetch(table: DataFrame, packed: DataFrame) -> DataFrame:
    """(id, title, text) read back: a chunk is decompressed once, its articles are byte slices of it."""
    slices = table.groupBy("chunk_id").agg(F.collect_list(F.struct("id", "title", "offset", "length")).alias("slices"))  # chunk_size at most
    opened = slices.join(packed, "chunk_id").select("slices", F.explode(F.array(decompressed(F.col("data")))).alias("bytes"))
    cut = lambda s: F.struct(s["id"].alias("id"), s["title"].alias("title"), F.decode(F.col("bytes").substr(s["offset"].cast("int") + 1, s["length"].cast("int")), "UTF-8").alias("text"))
    return opened.select(F.inline(F.transform("slices", cut)))


def check(table: DataFrame) -> None:
    """Raises unless ids and chunk ids are dense and some article exists."""
    r = table.agg(F.count("*").alias("n"), F.max("id").alias("last"), F.countDistinct("chunk_id").alias("chunks"), F.max("chunk_id").alias("last_chunk")).first()
    if not r["n"]:
        raise ValueError("no article was accepted")
    if r["n"] != r["last"] or r["chunks"] != r["last_chunk"]:
        raise ValueError("ids or chunk ids have gaps")


def stats(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("articles"), F.countDistinct("chunk_id").alias("chunks"), F.sum("length").alias("bytes"), F.coalesce(F.max("id"), F.lit(0)).alias("last_id"))


def counts(pages: DataFrame, kept: DataFrame, table: DataFrame) -> DataFrame:
    """(pages, accepted, skipped, duplicates, articles, chunks) of a build: what came in, what the rules kept of it, and
    what the store has after repeated titles went."""
    inside, passed = pages.agg(F.count("*")).scalar(), kept.agg(F.count("*")).scalar()
    return table.agg(inside.alias("pages"), passed.alias("accepted"), (inside - passed).alias("skipped"), (passed - F.count("*")).alias("duplicates"), F.count("*").alias("articles"), F.countDistinct("chunk_id").alias("chunks"))


def sweep(texts: DataFrame, levels: tuple[int, ...] = (3, 19, 20, 21, 22), chunk: int = 200, window_log: int = DEFAULT.window_log) -> DataFrame:
    """(level, bytes, compressed, ratio, mb_per_s): the texts (page_id, text) in chunks of `chunk`, by compression level;
    mb_per_s is of one core."""
    rows = texts.select(F.floor(F.row_number().over(Window.partitionBy(F.floor(F.col("page_id") / STRETCH)).orderBy("page_id")) / chunk).alias("c"), F.floor(F.col("page_id") / STRETCH).alias("s"), "page_id", "text")
    grouped = rows.groupBy("s", "c").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "text"))), lambda x: x["text"]), "").alias("text"))

    @F.pandas_udf("size long, seconds double")
    def size(texts: pd.Series, level: pd.Series) -> pd.DataFrame:
        makers, out = {n: compressor(int(n), window_log) for n in level.unique()}, []
        for t, n in zip(texts, level, strict=True):
            data, began = t.encode(), time.perf_counter()
            out.append((len(makers[n].compress(data)), time.perf_counter() - began))
        return pd.DataFrame(out, columns=["size", "seconds"])

    each = grouped.select(F.octet_length("text").cast("long").alias("n"), "text", F.explode(F.array(*(F.lit(x) for x in levels))).alias("level"))
    summed = each.select("level", "n", size("text", "level").alias("s")).groupBy("level").agg(F.sum("n").alias("bytes"), F.sum("s.size").alias("compressed"), F.sum("s.seconds").alias("seconds"))
    return summed.select("level", "bytes", "compressed", F.round(F.col("bytes") / F.col("compressed"), 4).alias("ratio"), F.round(F.col("bytes") / F.col("seconds") / 1e6, 3).alias("mb_per_s"))
