"""Near-dedup by whole texts' sets of 5-word shingles, against all pairs."""

import itertools
import random
from fractions import Fraction

import corpus_pipeline as pipeline
import numpy as np
from prosemill.llm import common, graph, shingles, simhash
from prosemill.llm.common import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def brute_force(texts):
    """Ids left, and the number of pairs of different sets with similarity 0.8 or more."""
    sets = {}
    for i, text in sorted(texts.items()):
        w = (text or "").encode().lower().split()
        sets.setdefault(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset(), []).append(i)
    root = {s: s for s in sets}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    n = 0
    for x, y in itertools.combinations(sets, 2):
        if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
            root[find(x)] = find(y)
            n += 1
    least = {}
    for s, ids in sets.items():
        least[find(s)] = min([*ids, *([least[find(s)]] if find(s) in least else [])])
    return set(least.values()), n


def test_stage_finds_every_near_pair(spark):
    docs = table(spark, SF, "documents")
    left, n = brute_force({r["doc_id"]: r["text"] for r in docs.collect()})
    assert n
    assert {r["doc_id"] for r in pipeline.STAGES[2][1](spark, docs, SF).collect()} == left


def test_stage_joins_edited_copies(spark):
    words = [f"w{i}" for i in range(200)]
    edited = lambda *at: " ".join("x" if i in at else w for i, w in enumerate(words))
    rows = [(1, edited()), (2, edited(20, 90)), (3, edited(50, 120, 180)), (4, edited(*range(0, 200, 9))), (5, None), (6, ""), (7, "a b c"), (None, edited()), (8, edited(30)), (8, "other words")]
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string")
    got = pipeline.STAGES[2][1](spark, docs, SF).collect()
    assert sorted((r["doc_id"] for r in got if r["doc_id"]), key=int) == [1, 4, 5, 7, 8] and {r["text"] for r in got if r["doc_id"] == 8} == {"other words"} and sum(r["doc_id"] is None for r in got) == 1


def test_rows_that_share_an_id_or_a_text(spark):
    """Texts are told apart by what they are, not by their id; of rows alike in both one stays, the least by its JSON."""
    rows = [(5, "text A " * 9, "x"), (5, "text B " * 9, "y"), (3, "text A " * 9, "z"), (4, "text C " * 9, "q"), (4, "text C " * 9, "p"), (None, "text A " * 9, "n"), (None, "text A " * 9, "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string")
    got = sorted(map(tuple, simhash.deduplicated(docs).collect()), key=repr)
    assert got == sorted([(3, "text A " * 9, "z"), (5, "text B " * 9, "y"), (4, "text C " * 9, "p"), (None, "text A " * 9, "n"), (None, "text A " * 9, "n")], key=repr)
    assert simhash.deduplicated(docs.limit(0)).count() == 0


def test_random_edits_against_all_pairs(spark):
    """Clusters of copies with few and many edits, short and long, and a passage that all of them share."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    texts, n = {}, 0
    for size in (4, 5, 9, 30, 80, 400):
        for _ in range(6):
            base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(500)) for _ in range(size)]
            for _ in range(8):
                words = list(base)
                for _ in range(rng.choice([0, 1, 2, 4, size // 12])):
                    words[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
                texts[n] = " ".join(words + passage * rng.choice([0, 0, 1]))
                n += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    left, pairs = brute_force(texts)
    assert pairs > 200
    assert {r["doc_id"] for r in simhash.deduplicated(docs).collect()} == left


def test_crowded_shingles_are_split(spark):
    """A passage in every text makes its shingles crowded; near pairs still meet, few others do."""
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(120)]
    texts = {}
    for n in range(0, 120, 2):
        words = [f"u{rng.randrange(10**9)}" for _ in range(120)]
        texts[n] = " ".join(words + passage)
        texts[n + 1] = " ".join(words[:110] + passage)
    docs = spark.createDataFrame([(i, t, "") for i, t in texts.items()], "id bigint, text string, digest string")
    nodes = shingles.measured(docs, 5).select("node", "wide", "keys")
    sizes = lambda most: [r["n"] for r in shingles.posts(nodes, most).groupBy("gram").agg(F.count("*").alias("n")).collect()]
    assert max(sizes(1000)) > 40 > 20 > max(sizes(16))
    for split in ({"dense": 16}, {"crowded": 16}):
        rows = common.stored(shingles.measured(docs, 5), "measured")
        known = common.stored(rows.select("node", "id", "digest"), "nodes")
        none = known.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
        found = shingles.near_links(rows, known, docs, none, 5, Fraction(4, 5), **split)
        roots = {r["node"]: r["root"] for r in graph.components(found).collect()}
        of = {r["id"]: roots.get(r["node"]) for r in known.collect()}
        assert all(of[n] is not None and of[n] == of[n + 1] for n in range(0, 120, 2)) and len(set(of.values())) == 60


def family(rng, number, words=480, changed=7):
    """Texts of one base, each with its own words at `changed` places; with 7 of 480 mostly of similarity 0.74 to each other."""
    base = [f"b{i}" for i in range(words)]
    texts = []
    for _ in range(number):
        own = list(base)
        for at in rng.sample(range(0, words, 6), changed):
            own[at] = f"e{rng.randrange(10**9)}"
        texts.append(" ".join(own))
    return texts


def test_almost_near_texts_make_no_rows_of_pairs(spark, monkeypatch):
    """No table of the stage has more rows than texts have shingles that they meet under; it is still what all pairs give."""
    texts = dict(enumerate(family(random.Random(14), 300)))
    made = {}

    def counted(df, tag, *rest):
        out = common.stored(df, tag, *rest)
        made[tag] = max(made.get(tag, 0), out.count())
        return out

    monkeypatch.setattr(shingles, "stored", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    left, pairs = brute_force(texts)
    kept = {r["doc_id"] for r in simhash.deduplicated(docs).collect()}
    assert kept == left and 150 < len(left) < 300 and pairs
    assert max(made.values()) <= shingles.KEYS * len(texts), made


def test_whole_sets_meet_block_by_block(spark, monkeypatch):
    """The last step alone finds every component, in one block or in many, dense or not, and gives a forest in each task."""
    rng = random.Random(15)
    texts = dict(enumerate([*family(rng, 80, changed=5), *family(rng, 40, 120, 1), *family(rng, 30)]))
    docs = spark.createDataFrame([(i, t, "") for i, t in texts.items()], "id bigint, text string, digest string")
    left, pairs = brute_force(texts)
    assert pairs > 4 * len(texts)
    monkeypatch.setattr(shingles, "nearest", lambda groups, *_, **__: groups.selectExpr("node as a", "node as b").limit(0))
    for how in ({}, {"block": 9000}, {"block": 3000, "dense": 16}):
        rows = common.stored(shingles.measured(docs, 5), "measured")
        known = common.stored(rows.groupBy("node").agg(F.min("id").alias("id"), F.lit("").alias("digest")), "nodes")
        none = known.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
        found = shingles.near_links(rows, known, docs, none, 5, Fraction(4, 5), **how)
        roots = {r["node"]: r["root"] for r in graph.components(found).collect()}
        of = {}
        for r in known.collect():
            of.setdefault(roots.get(r["node"], r["node"]), []).append(r["id"])
        assert {min(ids) for ids in of.values()} == left
        if not how:
            assert found.count() < shingles.KEYS * 4 * len(texts)


def test_pairs_of_a_dense_group_meet_in_a_small_one(spark):
    """Two nodes whose least key is a dense group's, where they share no segment, are suspects under another key."""
    rng = np.random.default_rng(16)
    wides = [rng.integers(0, 1 << 64, shingles.WIDE, dtype=np.uint64) for _ in range(5)]
    wides[1] = wides[0].copy()
    wides[1].view(np.uint16)[: shingles.SEGMENTS] ^= np.uint16(0b111)
    rows = [(gram, i, 1000, i, wides[i].tobytes()) for gram, i in [(1, 0), (1, 1), (1, 2), (1, 3), (1, 4), (2, 0), (2, 1)]]
    groups = spark.createDataFrame(rows, "gram bigint, node bigint, n bigint, root bigint, wide binary").coalesce(1).sortWithinPartitions("gram")
    got = shingles.suspects(groups, Fraction(4, 5), dense=3).collect()
    assert sorted((r["gram"], r["node"], r["parts"]) for r in got) == [(2, 0, 1), (2, 1, 1)]


def test_majority_counts_every_row():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 10, 1000, 9001):
        rows = rng.integers(0, 1 << 64, size=(n, 8), dtype=np.uint64)
        bits = np.unpackbits(rows.view(np.uint8).reshape(n, -1), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        assert (shingles.majority(rows) == np.packbits(2 * bits > n, bitorder="little").view(np.uint64)).all()


def test_wide_fingerprints_of_near_sets_stay_within_the_bound():
    rng = np.random.default_rng(4)
    most = shingles.most_bits(Fraction(4, 5))
    tried = 0
    for n in (4, 5, 12, 13, 20, 32, 63, 64, 100, 1000):
        for m in range(n, n * 5 // 4 + 1):
            both = -(-4 * (n + m) // 9)
            if both > n or m > n + 30:
                continue
            for _ in range(20):
                grams = rng.integers(0, 1 << 64, size=n + m - both, dtype=np.uint64)
                tried += 1
                assert np.bitwise_count(shingles.wide(grams[:n]) ^ shingles.wide(grams[n - both :])).sum() <= most[min(n, shingles.LARGE)]
    assert tried > 1000
