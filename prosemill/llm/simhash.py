"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint has 64 bits.  Two fingerprints that differ in at most three bits, cut into two halves, have a half
that differs in at most one bit.  Each fingerprint is indexed under both of its halves as they are, and under each
half with one set bit cleared; halves that are equal, or that differ in one bit, so meet under an equal key, the
one of the lesser popcount.  Rows are dealt by that key; within a key, the true links (verified on all 64 bits) are
searched breadth first over the members not yet reached, so a cluster of m members gives m - 1 links and no pairs.
Links are merged to components by alternating star contraction, all in DataFrames.

A crowded key is split: fingerprints that are linked and agree in one half, but for one bit, differ in at most three
bits of the other half, so one of its two quarters differs in at most one bit, and the members are indexed once more
by these quarters and their one-wildcard variants.  No link is lost, and what a task holds at a time has a bound: a key that
isn't split has under 33 x `most` + 33 members, a split one's part those that share 48 bits but for two.

Null text: no words, fingerprint zero.  Empty tables give empty results.  A null id is never a representative
unless all ids of its component are null.  Repeated rows come back as often as they came in.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, as_bytes, slices, stored, whole_keys
from .graph import components
from .shingles import majority, measured, near_links, shingle_hashes

DISTANCE = 3
#: A half is crowded if more distinct fingerprints than that have it.
MOST = 512
#: Crowded keys up to this number are broadcast; more of them are joined by a shuffle.
MOST_BROADCAST = 500_000


def simhash(words: list[bytes], shingle: int = 3) -> int:
    """Unsigned fingerprint: a bit is set if it is in over half of the shingles' XXH64."""
    if not words:
        return 0
    hashes = shingle_hashes(words, shingle)
    return int.from_bytes(majority(hashes[:, None]).tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the signed 64-bit fingerprint of each row's whole text, words being runs of anything but ASCII white space."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            values = [simhash((text or b"").translate(LOWER).split(), shingle) for text in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint")


def _halves(fps: DataFrame) -> DataFrame:
    """(fp, h): both halves of each fingerprint, h being (seg, half)."""
    halves = F.array(*(F.struct(F.lit(i).cast("long").alias("seg"), F.expr(f"shiftrightunsigned(fp, {32 * i}) & 4294967295L").alias("half")) for i in (0, 1)))
    return fps.select("fp", F.explode(halves).alias("h"))


#: Of a half, its key as it is and its keys with one set bit cleared.
OWN = "shiftleft(h.seg, 32) | h.half"
VARIANTS = "transform(filter(sequence(0, 31), p -> (h.half & shiftleft(1L, p)) != 0), p -> shiftleft(h.seg, 32) | (h.half ^ shiftleft(1L, p)))"


def signatures(fps: DataFrame) -> DataFrame:
    """(key, fp, own): `own` rows stand under a half as it is, the others under a half with one bit cleared."""
    rows = F.expr(f"concat(array(struct({OWN} as key, true as own)), transform({VARIANTS}, k -> struct(k as key, false as own)))")
    return _halves(fps).select("fp", F.explode(rows).alias("s")).select("s.key", "fp", "s.own")


def crowded(fps: DataFrame, most: int) -> DataFrame:
    """(key): the keys that a half which more than `most` fingerprints have stands under; counted before the variants are made."""
    many = _halves(fps).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > most)
    return many.select(F.explode(F.expr(f"concat(array({OWN}), {VARIANTS})")).alias("key")).distinct()


def split_crowded(rows: DataFrame, keys: DataFrame, broadcast: bool) -> DataFrame:
    """Signatures with their keys 18 bits longer: zeros, or for crowded keys the quarters of the other half, and each
    quarter with one set bit cleared."""
    quarter = "(shiftrightunsigned(fp, cast(32 * (1 - shiftright(key, 32)) as int) + 16 * j) & 65535L)"
    masks = f"concat(array(0L), transform(filter(sequence(0, 15), p -> ({quarter} & shiftleft(1L, p)) != 0), p -> shiftleft(1L, p)))"
    parts = f"flatten(transform(array(0, 1), j -> transform({masks}, m -> 131072L | shiftleft(cast(j as bigint), 16) | ({quarter} ^ m))))"
    marked = rows.join(keys.select("key", F.lit(True).alias("many")).hint("broadcast" if broadcast else "merge"), "key", "left")
    part = F.explode(F.expr(f"if(many is null, array(0L), {parts})"))
    return marked.select("key", "fp", "own", part.alias("part")).select(F.expr("shiftleft(key, 18) | part").alias("key"), "fp", "own")


def _forest(fps: np.ndarray, own: np.ndarray, distance: int) -> tuple[list, list]:
    """Links of a spanning forest of the members that have a link to or from an `own` one, breadth first."""
    left, right = [], []
    rest = np.arange(len(fps))
    for start in np.flatnonzero(own).tolist():
        at = np.searchsorted(rest, start)
        if at >= len(rest) or rest[at] != start:
            continue
        rest, queue = np.delete(rest, at), [start]
        while queue and len(rest):
            node = queue.pop()
            near = np.bitwise_count(fps[rest] ^ fps[node]) <= distance
            if near.any():
                found = rest[near]
                left += [int(fps[node])] * len(found)
                right += fps[found].tolist()
                queue += found.tolist()
                rest = rest[~near]
    return left, right


def links(fps: DataFrame, distance: int = DISTANCE, most: int = MOST) -> DataFrame:
    """(a, b): verified links that connect what lies within `distance` bits, 3 at most, of each other; fps has distinct fingerprints.

    A task holds one key's members at a time, 17 bytes each; crowded keys are split.
    """
    if distance > DISTANCE:
        raise ValueError(f"signatures meet up to {DISTANCE} bits")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fp, own in whole_keys(batches, 3):
            fp = fp.view(np.uint64)
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            end = np.r_[begin[1:], len(key)]
            useful = (end - begin > 1) & (np.add.reduceat(own.astype(np.int64), begin) > 0)
            left, right = [], []
            for i, j in zip(begin[useful].tolist(), end[useful].tolist(), strict=True):
                x, y = _forest(fp[i:j], own[i:j], distance)
                left += x
                right += y
            yield pa.RecordBatch.from_arrays([pa.array(np.array(z, np.uint64).view(np.int64)) for z in (left, right)], names=["a", "b"])

    spark = fps.sparkSession
    keys = stored(crowded(fps, most), "crowded-keys")
    dealt = fps.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))  # few bytes, but each row becomes some 34
    rows = split_crowded(signatures(dealt), keys, keys.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST)
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint").where("a != b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) for every row: component_id is the least id reachable over links of `distance` bits or fewer."""
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(nodes.select("fp"), distance))
    known = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = known.join(lowest, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("id", "fp", "component_id")




def near_texts(docs: DataFrame, shingle: int = 5, least: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, component_id, component_digest) of every row with an id: its text's md5, and the least row, by id and
    digest, that is reachable over links of similarity `least` or more between whole texts' sets of shingles.

    That similarity allows some ten of 64 bits to differ, too many for segments that tell texts apart.  So the
    deletion-variant signatures give the pairs within three bits; wider ones meet under a few shingles, are compared by
    longer SimHashes, and all links are verified on the whole sets: see shingles.  Of pairs of similarity 0.8 one
    in thirty thousand is missed, of nearer ones far fewer.  Null and wordless texts are one set."""
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), digest_of(F.col(text_col)).alias("digest"))
    rows = stored(measured(texts, shingle), "shingle-sets-measured")
    of = stored(rows.select("id", "digest", "node"), "nodes")
    least_row = F.min(F.struct("id", "digest"))
    nodes = stored(rows.groupBy("node").agg(least_row.alias("row"), F.min("fp").alias("fp")).select("node", "row.id", "row.digest", "fp"), "nodes")
    of_fp = nodes.groupBy("fp").agg(F.min("node").alias("low"))
    wide_links = links(of_fp.select("fp"))
    across = wide_links.join(of_fp.select(F.col("fp").alias("a"), F.col("low").alias("x")), "a").join(of_fp.select(F.col("fp").alias("b"), F.col("low").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    within = nodes.join(of_fp, "fp").where("node != low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    roots = components(near_links(rows, nodes, texts, across.unionByName(within), shingle, least)).distinct()
    rooted = nodes.join(roots, "node", "left").select("node", F.struct("id", "digest").alias("row"), F.coalesce("root", "node").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("row").alias("row"))
    classes = rooted.select("node", "root").join(lowest, "root").select("node", F.col("row.id").alias("component_id"), F.col("row.digest").alias("component_digest"))
    return of.join(classes, "node").select("id", "digest", "component_id", "component_digest")


def digest_of(text: Column) -> Column:
    """md5 of a text; '' for null."""
    return F.coalesce(F.md5(text.cast("binary")), F.lit(""))


def deduplicated(docs: DataFrame, shingle: int = 5, least: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of near_texts(): the least by id, then by its text's md5; rows that agree in both are one
    row, the least by its JSON.  Rows that share an id but not a text are told apart.  Rows without an id all stay."""
    classes = stored(near_texts(docs, shingle, least, id_col, text_col).groupBy("id", "digest").agg(F.first("component_id").alias("component_id"), F.first("component_digest").alias("component_digest"), F.count("*").alias("n")), "classes")
    stays = (F.col("id") == F.col("component_id")) & (F.col("digest") == F.col("component_digest"))
    gone = classes.where(~stays).select(F.col("id").alias("_id"), F.col("digest").alias("_digest"))
    marked = docs.withColumns({"_id": F.col(id_col), "_digest": digest_of(F.col(text_col))})
    kept = marked.join(gone.hint("merge"), ["_id", "_digest"], "left_anti")  # one plan at every size
    again = classes.where(stays & (F.col("n") > 1)).select(F.col("id").alias("_id"), F.col("digest").alias("_digest"))
    if again.isEmpty():
        return kept.select(*docs.columns)
    order = Window.partitionBy("_id", "_digest").orderBy(F.to_json(F.struct(*docs.columns)))
    once = kept.join(again, ["_id", "_digest"], "left_semi").withColumn("_rank", F.row_number().over(order)).where("_rank = 1")
    return kept.join(again, ["_id", "_digest"], "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))
