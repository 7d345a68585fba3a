"""Merkle fingerprints of documents: leaves under paragraphs under sections under a root, hashed at every node.

Sections are parted by an empty line, paragraphs by a line end, leaves by what stands in the paragraph: a leaf goes on for
two words and then to the next word that ends in one of CUTS.  So cuts depend on the words around them alone, and an
edit changes the leaves it touches and, after a word or two, no others, wherever in a text it lies.  A leaf's node is the
MD5 of its characters, the others' the SHA-256 of their children's; the leaves of a text joined again are the text, so
equal roots mean equal texts, and where two trees differ, the differing branches name the sections and paragraphs that were
edited.  The likeness of two trees is 1 for equal roots, else Dice's coefficient of their distinct leaf nodes.

All of it is DataFrame expressions.  Null text: as the empty text, one paragraph without a leaf.  Texts without any leaf
have likeness 0 to others.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Last characters of the words that end a leaf.
CUTS = "es.,"
#: Two words, words that end in no cut, one that does and its space; or what is left of the paragraph.
LEAF = rf"(?s)(?:[^ ]* ){{2}}(?:(?:[^ ]*[^ {CUTS}])? )*+[^ ]*[{CUTS}] |.+"
CELLS = 64


def _sha(parts: Column) -> Column:
    return F.sha2(F.concat_ws(",", parts), 256)


def tree(text: Column) -> Column:
    """array<struct<hash, paragraphs: array<struct<hash, leaves: array<string>>>>>: the sections of a text that isn't null."""
    leaves = lambda p: F.transform(F.regexp_extract_all(p, F.lit(LEAF), F.lit(0)), lambda x: F.md5(x.cast("binary")))
    paragraph = lambda found: F.struct(_sha(found).alias("hash"), found.alias("leaves"))
    below = F.transform(F.split(text, "\n\n"), lambda s: F.transform(F.transform(F.split(s, "\n"), leaves), paragraph))
    return F.transform(below, lambda ps: F.struct(_sha(F.transform(ps, lambda p: p["hash"])).alias("hash"), ps.alias("paragraphs")))


def root(tree_: Column) -> Column:
    """Lower-case hex."""
    return _sha(F.transform(tree_, lambda s: s["hash"]))


def leaves(tree_: Column) -> Column:
    """Distinct leaf nodes."""
    return F.array_distinct(F.flatten(F.flatten(F.transform(tree_, lambda s: F.transform(s["paragraphs"], lambda p: p["leaves"])))))


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    total = F.size(leaves_a) + F.size(leaves_b)
    return F.when(root_a == root_b, 1.0).when(total == 0, 0.0).otherwise(2.0 * F.size(F.array_intersect(leaves_a, leaves_b)) / total)


def differing(tree_a: Column, tree_b: Column) -> Column:
    """array<struct<section, paragraph>>: the places, from 0, at which the trees' paragraphs differ or one has none.  Only
    sections whose nodes differ are opened."""
    null = F.lit(None).cast("struct<section:int,paragraph:int>")

    def opened(section: Column, i: Column) -> Column:
        x, y = section["a"], section["b"]
        both = F.zip_with(F.coalesce(x["paragraphs"], F.array()), F.coalesce(y["paragraphs"], F.array()), lambda p, q: p["hash"].eqNullSafe(q["hash"]))
        found = F.transform(both, lambda same, j: F.when(~same, F.struct(i.alias("section"), j.alias("paragraph"))).otherwise(null))
        return F.when(x["hash"].eqNullSafe(y["hash"]), F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(F.filter(found, lambda f: f.isNotNull()))

    return F.flatten(F.transform(F.zip_with(tree_a, tree_b, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), opened))


def nodes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, section, paragraph, hash): the tree as rows; paragraph null for a section's node, both null for the root."""
    rows = docs.select(F.col(id_col).alias("id"), tree(F.coalesce(F.col(text_col), F.lit(""))).alias("tree"))
    sections = rows.select("id", F.posexplode("tree").alias("section", "s"))
    paragraphs = sections.select("id", "section", F.posexplode("s.paragraphs").alias("paragraph", "p")).select("id", "section", "paragraph", "p.hash")
    null = F.lit(None).cast("int")
    return rows.select("id", null.alias("section"), null.alias("paragraph"), root(F.col("tree")).alias("hash")).unionByName(sections.select("id", "section", null.alias("paragraph"), "s.hash")).unionByName(paragraphs)


def edits(left: DataFrame, right: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, section, paragraph): the paragraphs by place in which two versions of the documents, matched by id, differ; a
    document that one side lacks differs everywhere.  Ids are unique on each side."""
    empty = F.array().cast("array<struct<hash:string,paragraphs:array<struct<hash:string,leaves:array<string>>>>>")
    side = lambda df, name: df.select(F.col(id_col).alias("id"), tree(F.coalesce(F.col(text_col), F.lit(""))).alias(name))
    both = side(left, "a").join(side(right, "b"), "id", "full")
    return both.select("id", F.inline(differing(F.coalesce("a", empty), F.coalesce("b", empty))))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, next_text): next is the document that follows by descending id, after the last the first.

    Rows of one id follow each other by the hash of their text, then the text; null ids come last.  Ids are whole numbers.

    The ids' quantiles cut the range into CELLS parts, each cut evenly, so that a bucket is a stretch of ids and there are
    four for each shuffle partition.  Texts are shuffled once, by bucket; the first row of each bucket goes to the
    bucket before it too, so that every row finds its successor there.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    inner = [i / CELLS for i in range(1, CELLS)]
    ends = rows.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.percentile_approx("id", inner, F.lit(10000)).alias("inner")).first()
    edges = sorted({ends["low"], *ends["inner"], ends["high"] + 1}) if ends["low"] is not None else [0, 1]
    parts = -(-4 * int(spark.conf.get("spark.sql.shuffle.partitions")) // CELLS)
    at = F.array(*(F.lit(x).cast("long") for x in edges))
    cell = F.size(F.filter(at, lambda e: e <= F.col("id")))  # from 1
    placed = rows.withColumn("cell", cell).withColumn("low", F.get(at, F.col("cell") - 1)).withColumn("high", F.get(at, F.col("cell")))
    within = F.floor((F.col("id") - F.col("low")).cast("double") / (F.col("high") - F.col("low")).cast("double") * parts).cast("int")
    bucket = F.when(F.col("id").isNull(), -1).otherwise(F.col("cell") * parts + F.least(within, F.lit(parts - 1)))
    placed = placed.select("id", "text", bucket.cast("int").alias("bucket"))

    heads = placed.groupBy("bucket").agg(F.max("id").alias("head"))  # as many rows as buckets at most
    order = Window.orderBy(F.col("bucket").desc())
    before = F.lag("bucket").over(order)
    last = F.last("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("head", F.coalesce(before, last).alias("to"))
    mark = F.struct(F.xxhash64("text"), F.col("text"))
    first = rows.join(F.broadcast(heads), rows["id"].eqNullSafe(heads["head"])).groupBy("to").agg(F.min_by("text", mark).alias("text"))
    follow = first.select(F.lit(None).cast("long").alias("id"), "text", F.col("to").alias("bucket"), F.lit(1).alias("extra"))

    dealt = placed.withColumn("extra", F.lit(0)).unionByName(follow).withColumn("mark", F.xxhash64("text"))
    order = Window.partitionBy("bucket").orderBy("extra", F.col("id").desc_nulls_last(), "mark", "text")
    return dealt.withColumn("next_text", F.lead("text").over(order)).where("extra = 0").select("id", "text", "next_text")


def edited(text: Column, following: Column) -> Column:
    """The last half, rounded down, replaced by the first as many code points of the following text."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(text.substr(F.lit(1), n - half), following.substr(F.lit(1), half))
