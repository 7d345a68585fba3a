"""Spelling dictionary: weighted word frequencies, vocabulary, delete variants, lookup, binary file."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..functions.text import deletes, fnv1a32, tokens
from ..options import DEFAULT, Options

#: Fixed values of the binary format.
MAGIC, VERSION, HEADER_BYTES, MAX_DISTANCE = b"OSSD", 1, 64, 2


def frequencies(table: DataFrame, options: Options = DEFAULT) -> DataFrame:
    """(word, freq) over titles and samples."""
    said = F.array(F.struct(F.col("title").alias("said"), F.lit(options.title_weight).alias("w")), F.struct(F.col("content_sample").alias("said"), F.lit(options.sample_weight).alias("w")))
    rows = table.select(F.explode(said).alias("f")).select(F.explode(tokens(F.col("f.said"))).alias("word"), "f.w")
    return rows.groupBy("word").agg(F.sum("w").alias("freq"))


def vocabulary(freqs: DataFrame, options: Options = DEFAULT) -> DataFrame:
    """(idx, word, freq, tier1): the most frequent `max_words`, ties by word; ranked after the limit, so over that many rows."""
    best = freqs.where(F.col("freq") >= options.min_freq).orderBy(F.desc("freq"), "word").limit(options.max_words)
    ranked = best.withColumn("idx", F.row_number().over(Window.orderBy(F.desc("freq"), "word")) - 1)
    return ranked.select("idx", "word", "freq", (F.col("idx") < options.tier1_words).alias("tier1"))


def most_common(freqs: DataFrame, n: int = 30) -> DataFrame:
    """The n most frequent words, ties by word: a report."""
    return freqs.orderBy(F.desc("freq"), "word").limit(n)


def delete_index(vocab: DataFrame) -> DataFrame:
    """(variant, h, idx): each word, its one-letter deletes, and for tier 1 its two-letter deletes."""
    own = F.array("word")
    one = deletes(own)
    variants = F.when(F.col("tier1"), F.array_union(F.array_union(own, one), deletes(one))).otherwise(F.array_union(own, one))
    return vocab.select("idx", F.explode(variants).alias("variant")).select("variant", fnv1a32(F.col("variant")).alias("h"), "idx")


def packed(index: DataFrame) -> DataFrame:
    """(entry): hash in the high, word number in the low 32 bits, as decimal(20,0); a set."""
    return index.select((F.col("h").cast("decimal(20,0)") * F.lit(4294967296).cast("decimal(20,0)") + F.col("idx")).cast("decimal(20,0)").alias("entry")).distinct()


def damerau(a: str, b: str) -> int:
    """Edit distance with transpositions, between whose letters others may be inserted or dropped."""
    far = len(a) + len(b)
    cost = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        cost[i + 1][1] = i
    for j in range(len(b) + 1):
        cost[1][j + 1] = j
    row_of: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        seen = 0
        for j, y in enumerate(b, 1):
            k, m = row_of.get(y, 0), seen
            same = x == y
            if same:
                seen = j
            swap = cost[k][m] + (i - k - 1) + 1 + (j - m - 1)
            cost[i + 1][j + 1] = min(cost[i][j] + (not same), cost[i + 1][j] + 1, cost[i][j + 1] + 1, swap)
        row_of[x] = i
    return cost[-1][-1]


@F.pandas_udf(IntegerType())
def _distance(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([damerau(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


def suggest(queries: DataFrame, vocab: DataFrame, index: DataFrame) -> DataFrame:
    """(query, word, distance, freq) within two edits: deletes of the query meet deletes of words, then are verified."""
    own = F.array("query")
    one = deletes(own)
    probes = queries.select("query", F.explode(F.array_union(F.array_union(own, one), deletes(one))).alias("variant"))
    pairs = probes.join(index.select("variant", "idx"), "variant").select("query", "idx").distinct().join(vocab, "idx")
    return pairs.withColumn("distance", _distance("query", "word")).where(F.col("distance") <= MAX_DISTANCE).select("query", "word", "distance", "freq")


def write_binary(vocab: DataFrame, index: DataFrame, path: str) -> dict[str, int]:
    """Header, word offsets, frequencies, words, sorted entries, little endian; rows stream in order, one partition at a time."""
    words = [(r["word"].encode(), r["freq"]) for r in vocab.orderBy("idx").toLocalIterator()]
    tier1 = vocab.where("tier1").count()
    offsets, blob = [0], bytearray()
    for word, _ in words:
        blob += word
        offsets.append(len(blob))
    entries = 0
    with open(path, "wb") as out:
        out.write(b"\0" * HEADER_BYTES)
        out.write(struct.pack(f"<{len(offsets)}I", *offsets))
        out.write(struct.pack(f"<{len(words)}I", *(min(f, 0xFFFFFFFF) for _, f in words)))
        out.write(bytes(blob))
        for r in packed(index).orderBy("entry").toLocalIterator():
            out.write(struct.pack("<Q", int(r["entry"])))
            entries += 1
        out.seek(0)
        out.write(struct.pack("<4sHHBBIIIQQ26x", MAGIC, VERSION, 0, MAX_DISTANCE, 0, tier1, len(words), entries, HEADER_BYTES, HEADER_BYTES + 4 * len(offsets) + 4 * len(words) + len(blob)))
    return {"words": len(words), "tier1": tier1, "entries": entries}
