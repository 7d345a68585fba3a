"""Word shingles of whole texts: hashes, SimHash bits, and near pairs by exact Jaccard similarity.

Texts of equal shingle sets are one node.  A node stands under its KEYS shingles of least hash.  Of the KEYS least
shingles of two sets' union each is in both with the sets' similarity as probability, so sets of similarity 0.8 fail to
meet once in ten million.  Nodes that meet are compared by SimHashes of 1,024 bits inside the task, which a pair of that
similarity fails once in thirty thousand, one of 0.83 once in a hundred million; what is left is compared by the whole sets.
That, too, is done inside a task, block by block of a group's sets, and gives links of a forest: texts that are almost near
enough are compared with each other, but no row is made of such a pair.

Of a dense group, as of a passage that many texts share, a task doesn't compare all pairs: members meet under SEGMENTS of
16 bits of their SimHashes and these with one set bit cleared.  A crowded group, too large for one task, is split by the
same keys before it is dealt.  A pair of similarity 0.8 that meets in such groups only meets there with a probability of
0.994 for each of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, as_bytes, drop_stored, slices, stored, whole_keys
from .graph import components

SEED = 42
#: Words of 64 bits in a wide fingerprint; shingles that a node stands under.
WIDE, KEYS = 16, 10
#: From that number of shingles on, the share of differing bits follows the law of many.
LARGE = 64
#: More nodes than that under a shingle make a dense, a crowded group; crowded shingles up to MOST_BROADCAST are broadcast.
DENSE, CROWDED, SEGMENTS, MOST_BROADCAST = 2048, 1 << 20, 16, 500_000
#: Shingles of a block of whole sets, of which a task holds two; pairs that are put in order at a time.
BLOCK, PAIRS = 1 << 20, 1 << 20


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of `size` words, or of the whole sequence if it is shorter; not empty."""
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(words) - size + 1)


def majority(rows: np.ndarray) -> np.ndarray:
    """Of (n, k) words, k words whose bits are set where over half of the rows have them.

    Bits are counted by carry-save adders: three rows of a weight become one of that weight and one of twice it."""
    counts, weight, planes = np.zeros(64 * rows.shape[1], np.int64), 1, rows
    while len(planes):
        carries = []
        while planes.size > 4096:  # fewer are counted faster as they are
            third = len(planes) // 3
            a, b, c = planes[:third], planes[third : 2 * third], planes[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            planes = np.concatenate([half ^ c, planes[3 * third :]])
        bits = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(len(planes), -1), axis=1, bitorder="little")
        counts += weight * bits.sum(axis=0, dtype=np.int64)
        weight, planes = 2 * weight, np.concatenate(carries) if carries else planes[:0]
    return np.packbits(2 * counts > len(rows), bitorder="little").view(np.uint64)


def wide(grams: np.ndarray) -> np.ndarray:
    """A SimHash of 64 x WIDE bits of a set of shingles; its first word is the 64-bit SimHash.  Zero for the empty set."""
    if not len(grams):
        return np.zeros(WIDE, np.uint64)
    out = [grams]
    for k in range(1, WIDE):
        x = grams * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019 & (1 << 64) - 1 | 1)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        out.append(x ^ (x >> np.uint64(32)))
    return majority(np.stack(out, axis=1))


def _differ(n: int, m: int, both: int) -> float:
    """Probability that a bit of the SimHashes of two sets of n and m shingles differs, `both` of which they share."""
    tail = lambda k, least: sum(math.comb(k, x) for x in range(max(0, least), k + 1)) / 2**k
    total = 0.0
    for ones in range(both + 1):
        p, q = tail(n - both, n // 2 + 1 - ones), tail(m - both, m // 2 + 1 - ones)
        total += math.comb(both, ones) / 2**both * (p * (1 - q) + q * (1 - p))
    return total


@lru_cache
def most_bits(least: Fraction) -> np.ndarray:
    """Differing bits of wide fingerprints up to which sets of that similarity may go, by the number of shingles of the
    smaller, LARGE standing for all above: the greatest share of differing bits, counted out for small sets, for large ones
    the angle between them over pi, which is greatest for sets of equal size; and four standard deviations."""
    shares = [1.0]
    for n in range(1, LARGE):
        sizes = [(m, math.ceil(least * (n + m) / (1 + least))) for m in range(n, int(n / least) + 1)]
        shares.append(max([0.0, *(_differ(n, m, both) for m, both in sizes if both <= n)]))
    shares.append(max(shares[-1], math.acos(2 * least / (1 + least)) / math.pi))
    return np.array([math.ceil(64 * WIDE * x + 4 * math.sqrt(64 * WIDE * x * (1 - x))) for x in shares])


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Distinct hashes of a text's shingles, ascending; words are runs of anything but ASCII white space."""
    words = (text or b"").translate(LOWER).split()
    return np.unique(shingle_hashes(words, size)) if words else np.empty(0, np.uint64)


def node_of(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes(), SEED)).view(np.int64))


def measured(docs: DataFrame, size: int) -> DataFrame:
    """(id, digest, node, n, fp, wide, keys) of docs (id, text, digest): a text's set, its size, fingerprints and keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sets = [shingles(t, size) for t in as_bytes(batch.column(1))]
            fps = [wide(s) for s in sets]
            keys = pa.array([s[:KEYS].view(np.int64) for s in sets], pa.list_(pa.int64()))
            columns = [pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(np.array([x[0] for x in fps]).view(np.int64)), pa.array([x.tobytes() for x in fps], pa.binary()), keys]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=["id", "digest", "node", "n", "fp", "wide", "keys"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text", "digest").mapInArrow(run, f"id {kind}, digest string, node bigint, n bigint, fp bigint, wide binary, keys array<bigint>")


def posts(nodes: DataFrame, most: int) -> DataFrame:
    """(gram, node) of nodes (node, wide, keys): the groups in which nodes meet; the groups of crowded keys are split."""
    rows = nodes.select("node", "wide", F.explode("keys").alias("key"))
    crowded = stored(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most).select("key"), "crowded-shingles")
    broadcast = crowded.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    rows = rows.join(crowded.withColumn("many", F.lit(True)).hint("broadcast" if broadcast else "merge"), "key", "left")
    segment = f"transform(sequence(0, {SEGMENTS - 1}), i -> struct(i, cast(conv(hex(substring(wide, 2 * i + 1, 2)), 16, 10) as int) as h))"
    variants = "flatten(transform({0}, s -> transform(concat(array(0), transform(filter(sequence(0, 15), p -> (s.h & shiftleft(1, p)) != 0), p -> shiftleft(1, p))), m -> xxhash64(key, s.i, s.h ^ m))))".format(segment)
    return rows.select("node", F.explode(F.expr(f"if(many, {variants}, array(key))")).alias("gram"))


def sets_of(ends: DataFrame, nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(node, grams) of ends (node), distinct: the whole sets; texts are fetched by a node's least row (id, digest)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sets = [shingles(t, size).view(np.int64) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "grams"])

    asked = ends.join(nodes.select("node", "id", "digest"), "node")
    texts = docs.join(asked, ["id", "digest"]).select("node", "text").dropDuplicates(["node"])
    return stored(texts.mapInArrow(run, "node bigint, grams array<bigint>"), "shingle-sets")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, least: Fraction) -> DataFrame:
    """The pairs (a, b) whose whole sets are near enough."""
    ends = pairs.select(F.col("a").alias("node")).distinct().unionByName(pairs.select(F.col("b").alias("node")).distinct())
    sets = sets_of(ends.distinct(), nodes, docs, size)
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b")
    shared = both.select("a", "b", (F.size("x") + F.size("y")).alias("total"), F.size(F.array_intersect("x", "y")).alias("shared"))
    out = stored(shared.where(F.col("shared") * least.denominator >= (F.col("total") - F.col("shared")) * least.numerator).select("a", "b").distinct(), "near-pairs")
    drop_stored(sets)
    return out


def _may_be_near(n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray, least: Fraction, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether sets of n and m shingles with fingerprints x and y can be near enough, and the bits that differ."""
    low, high = np.minimum(n, m), np.maximum(n, m)
    differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return (low * least.denominator >= high * least.numerator) & (differ <= bits[np.minimum(low, LARGE)]), differ


def _steps(gram: np.ndarray, root: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of all pairs of rows of one group, sorted by group, that lie in different components; no row comes
    twice on either side of a step."""
    at, step = np.arange(len(gram)), 0
    while len(at):  # every row with the one `step` places on, while both are of one group
        step += 1
        at = at[at + step < len(gram)]
        at = at[gram[at] == gram[at + step]]
        apart = at[root[at] != root[at + step]]
        if len(apart):
            yield apart, apart + step


def _meetings(gram: np.ndarray, root: np.ndarray, fp: np.ndarray, dense: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """_steps() of groups up to `dense` rows; of larger ones the pairs that share a segment but for a bit, some repeatedly."""
    begin = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
    size = np.diff(np.r_[begin, len(gram)])
    few = np.flatnonzero(np.repeat(size <= dense, size))
    for i, j in _steps(gram[few], root[few]):
        yield few[i], few[j]
    for at, n in zip(begin[size > dense].tolist(), size[size > dense].tolist(), strict=True):
        for segment in np.ascontiguousarray(fp[at : at + n]).view(np.uint16)[:, :SEGMENTS].T:
            places, keys = [np.arange(n)], [segment]
            for bit in range(16):
                places.append(np.flatnonzero(segment >> bit & 1))
                keys.append(segment[places[-1]] ^ np.uint16(1 << bit))
            place, key = np.concatenate(places), np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            place, key = at + place[order], key[order]
            for i, j in _steps(key, root[place]):
                yield place[i], place[j]


def nearest(groups: DataFrame, least: Fraction, heads: bool, dense: int = DENSE) -> DataFrame:
    """(a, b): for each node b of groups (gram, node, n, root, wide) the node a of another component whose fingerprint is
    nearest, among its groups' members, or with `heads` among its groups' least nodes.  One row a node at most."""
    bits = most_bits(least)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, node, n, root, fp in whole_keys(batches, 5):
            best, partner = np.full(len(gram), 64 * WIDE + 1, np.int64), np.zeros(len(gram), np.int64)

            def met(i: np.ndarray, j: np.ndarray) -> None:
                near, differ = _may_be_near(n[i], n[j], fp[i], fp[j], least, bits)
                near &= (differ < best[i]) | (differ == best[i]) & (node[j] < partner[i])
                i, differ, other = i[near], differ[near], node[j[near]]
                order = np.lexsort((-other, -differ, i))  # of a row that comes twice the nearest is put last
                best[i[order]], partner[i[order]] = differ[order], other[order]

            if heads:
                group = np.cumsum(np.r_[0, gram[1:] != gram[:-1]])
                order = np.lexsort((node, group))
                head = order[np.r_[True, group[order][1:] != group[order][:-1]]][group]
                at = np.flatnonzero(root != root[head])
                met(at, head[at])
            else:
                for i, j in _meetings(gram, root, fp, dense):
                    met(i, j)
                    met(j, i)
            at = np.flatnonzero(best <= 64 * WIDE)
            at = at[np.lexsort((partner[at], best[at], node[at]))]
            at = at[np.r_[True, node[at][1:] != node[at][:-1]][: len(at)]]
            yield pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (node, best, partner)], names=["node", "differ", "other"])

    found = groups.mapInArrow(run, "node bigint, differ bigint, other bigint").groupBy("node").agg(F.min(F.struct("differ", "other")).alias("best"))
    return found.select(F.col("best.other").alias("a"), F.col("node").alias("b"))


def _suspected(gram: np.ndarray, n: np.ndarray, root: np.ndarray, fp: np.ndarray, least: Fraction, bits: np.ndarray, dense: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """_meetings() of rows that can be near enough by size and fingerprint."""
    for i, j in _meetings(gram, root, fp, dense):
        near, _ = _may_be_near(n[i], n[j], fp[i], fp[j], least, bits)
        yield i[near], j[near]


def suspects(groups: DataFrame, least: Fraction, dense: int = DENSE, block: int = BLOCK) -> DataFrame:
    """The rows of groups (gram, node, n, root, wide) that can be near enough to another one of their group and of a
    different component, by size and fingerprint; and `parts`, the blocks that the whole sets of the group's suspects make."""
    bits = most_bits(least)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, node, n, root, fp in whole_keys(batches, 5):
            hit = np.zeros(len(gram), bool)
            for i, j in _suspected(gram, n, root, fp, least, bits, dense):
                hit[i] = hit[j] = True
            at = np.flatnonzero(hit)
            of = np.unique(gram[at], return_inverse=True)[1]
            parts = -(-np.bincount(of, n[at]).astype(np.int64) // block)
            wides = pa.array([x.tobytes() for x in fp[at]], pa.binary())
            yield pa.RecordBatch.from_arrays([*(pa.array(x[at]) for x in (gram, node, n, root)), wides, pa.array(parts[of])], names=["gram", "node", "n", "root", "wide", "parts"])

    return groups.mapInArrow(run, "gram bigint, node bigint, n bigint, root bigint, wide binary, parts bigint")


def _joined(place: np.ndarray, node: np.ndarray, n: np.ndarray, root: np.ndarray, fp: np.ndarray, side: np.ndarray, grams: np.ndarray, least: Fraction, bits: np.ndarray, dense: int) -> tuple[list, list]:
    """Links of a forest that connects all components with near enough rows in one place; grams are the rows' whole sets.
    Rows of sides 0 and 1 meet those of other sides only."""
    values, known = np.unique(np.concatenate(grams), return_inverse=True)
    sets, has = np.split(known, np.cumsum(n)[:-1]), np.zeros(len(values), bool)
    _, first, of = np.unique(root, return_index=True, return_inverse=True)
    up, left, right = first[of], [], []

    def top(at: np.ndarray) -> np.ndarray:
        out = up[at]
        while (up[out] != out).any():
            out = up[out]
        up[at] = out
        return out

    def verify(pairs: np.ndarray) -> None:
        a, b = np.divmod(np.unique(pairs), len(place))
        cut = np.flatnonzero(np.r_[True, a[1:] != a[:-1], True])
        for begin, end in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            i, j = a[begin], b[begin:end]
            j = j[top(j) != top(a[begin : begin + 1])]
            if not len(j):
                continue
            has[sets[i]] = True
            shared = np.add.reduceat(has[np.concatenate([sets[x] for x in j.tolist()])], np.cumsum(n[j]) - n[j], dtype=np.int64)
            has[sets[i]] = False
            near = j[shared * least.denominator >= (n[i] + n[j] - shared) * least.numerator]
            roots, at = np.unique(top(near), return_index=True)
            left.extend([int(node[i])] * len(at))
            right.extend(node[near[at]].tolist())
            up[roots] = top(a[begin : begin + 1])

    held, many = [], 0
    for i, j in _suspected(place, n, root, fp, least, bits, dense):
        meet = (side[i] != side[j]) | (side[i] == 2)
        held.append(np.minimum(i, j)[meet] * len(place) + np.maximum(i, j)[meet])
        many += len(held[-1])
        if many >= PAIRS:
            verify(np.concatenate(held))
            held, many = [], 0
    if many:
        verify(np.concatenate(held))
    return left, right


def linked(rows: DataFrame, sets: DataFrame, least: Fraction, dense: int = DENSE, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect the components of rows, which are suspects(), that have near enough nodes in a group, by
    their whole sets (node, grams).  A task gives one row less than it sees components at most.

    A group whose sets make several blocks meets block by block: a row comes as often as its group has blocks, and a task
    holds two of them at a time, or one batch of smaller groups."""
    bits = most_bits(least)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_keys(batches, 7):
            place, n = whole[0], whole[2]
            begin = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            piece = (np.cumsum(n) - n)[begin] // (2 * block)
            cut = [0, *begin[1:][piece[1:] != piece[:-1]].tolist(), len(place)]
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                left, right = _joined(*(x[i:j] for x in whole), least, bits, dense)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (left, right)], names=["a", "b"])

    met = rows.select("*", F.expr("pmod(xxhash64(node), parts)").alias("own"), F.explode(F.expr("sequence(0L, parts - 1)")).alias("other"))
    met = met.select(F.expr("xxhash64(gram, least(own, other), greatest(own, other))").alias("place"), "node", "n", "root", "wide", F.expr("if(own = other, 2, if(own < other, 0, 1))").alias("side"))
    dealt = met.join(sets, "node").repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "place")
    return dealt.select("place", "node", "n", "root", "wide", "side", "grams").sortWithinPartitions("place").mapInArrow(run, "a bigint, b bigint").distinct()


def near_links(rows: DataFrame, nodes: DataFrame, docs: DataFrame, first: DataFrame, size: int, least: Fraction, dense: int = DENSE, crowded: int = CROWDED, block: int = BLOCK) -> DataFrame:
    """(a, b): verified links that connect all nodes near enough to each other.  rows: measured(), stored, dropped when
    read; nodes: (node, id, digest); first: (a, b), pairs to try before any other.

    Pairs are tried in the order in which they join most nodes for one comparison: `first`, and each node with the nearest
    head of its groups; each with the nearest member of another component; then, inside the tasks, all that can be near and
    still lie in different components."""
    deal = lambda df: df.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "gram")
    of_node = stored(rows.join(nodes.select("node", "id", "digest"), ["node", "id", "digest"], "left_semi").select("node", "n", "wide", "keys").dropDuplicates(["node"]), "node-sets")
    drop_stored(rows)
    group = Window.partitionBy("gram")
    met = deal(posts(of_node, crowded)).select("gram", "node", F.min("node").over(group).alias("low"), F.max("node").over(group).alias("high"))
    shared = stored(met.where("low != high").select("gram", "node"), "shared-shingles")

    def groups(links: DataFrame | None) -> DataFrame:
        """(gram, node, n, root, wide), dealt and sorted by gram; with links only of groups that span several components."""
        if links is None:
            full = deal(shared.join(of_node.select("node", "n", F.col("node").alias("root"), "wide"), "node"))
        else:
            rooted = of_node.drop("keys").join(components(links).distinct(), "node", "left").withColumn("root", F.coalesce("root", "node"))
            full = deal(shared.join(rooted, "node")).select("*", F.min("root").over(group).alias("low"), F.max("root").over(group).alias("high")).where("low != high")
        return full.select("gram", "node", "n", "root", "wide").sortWithinPartitions("gram")

    links = None
    for found in (lambda: first.unionByName(nearest(groups(None), least, heads=True)), lambda: nearest(groups(links), least, heads=False, dense=dense)):
        tried = stored(found(), "tried-pairs")
        near = verified(tried, nodes, docs, size, least)
        links = near if links is None else stored(links.unionByName(near), "near-pairs")
    left = stored(suspects(groups(links), least, dense, block), "suspected-rows")
    sets = sets_of(left.select("node").distinct(), nodes, docs, size)
    links = stored(links.unionByName(linked(left, sets, least, dense, block)), "near-pairs")
    drop_stored(sets)
    drop_stored(left)
    drop_stored(shared)
    drop_stored(of_node)
    return links
