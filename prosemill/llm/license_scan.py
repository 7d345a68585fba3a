"""License scans: TF-IDF cosine of headers, licence files and notices to templates, then inheritance along directories.

What is compared of a file: each line that holds an anchor; each block of two lines or more between empty lines
that holds one, as headers are; and of licence files (base name LICENSE, LICENCE or COPYING, any extension) with an anchor
the whole text.  Tokens are runs of letters, digits and dots inside, lower-cased, weighted by their number times
ln(1 + N / (1 + df)), with N and df counted over all whole texts of all files.  Licences have several templates: whole
texts, headers and one-line notices.  A file's own licence is the one of the template with the greatest cosine, if that is
`least` or more; ties go to the licence of least name.

A directory's licence is that of its licence file (of several the greatest cosine, then the least path).  A file without a
licence of its own takes that of the nearest directory above it, by equality joins of directories with their ancestors.

Rows are told apart by id, path and text, so a null or repeated id mixes nothing; rows alike in all three have one result,
each its row.  Null text: nothing to compare.  Null path: as the root's file ''.  An empty table gives none.  DataFrame
expressions only.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored
from .licence_texts import TEMPLATES

#: A line or block is compared if it holds one of these words; names that are words of some language only as written.
ANCHORS = ("licensed", "license", "licence", "licenses", "copyright", "spdx", "gnu", "mozilla", "redistribution", "warranty", "warranties", "gpl", "lgpl", "agpl", "cc0", "public domain")
NAMES = ("MIT", "BSD", "ISC", "CC", "MPL", "EPL")
ANCHOR = "(?:^|[^\\p{L}\\p{N}])(?:(?i:" + "|".join(ANCHORS) + ")|" + "|".join(NAMES) + ")(?:$|[^\\p{L}\\p{N}])"
TOKEN = r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*"
LICENCE_FILE = r"(?:^|/)(?i:licen[cs]e|copying)(?:\.[^./]*)?$"
BLANK = r"\n[ \t]*\n"


def template_counts(templates: dict[str, tuple[str, ...]]) -> list[tuple[str, int, str, float]]:
    """(licence, variant, token, number)."""
    import regex

    return [(name, i, token, float(n)) for name, texts in templates.items() for i, text in enumerate(texts) for token, n in Counter(regex.findall(TOKEN, text.lower())).items()]


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def units(files: DataFrame) -> DataFrame:
    """(file, unit, said): what is compared of files (file, path, text)."""
    rows = files.where(F.col("text").rlike(ANCHOR))
    pieces = lambda kind, parts: F.transform(parts, lambda said, i: F.struct(F.concat(F.lit(kind), i).alias("unit"), said.alias("said")))
    lines = pieces("l", F.split("text", "\n"))
    blocks = F.filter(pieces("b", F.split("text", BLANK)), lambda u: F.contains(u["said"], F.lit("\n")))
    whole = F.when(F.col("path").rlike(LICENCE_FILE), F.array(F.struct(F.lit("w").alias("unit"), F.col("text").alias("said")))).otherwise(F.array().cast("array<struct<unit:string,said:string>>"))
    found = F.filter(F.concat(lines, blocks, whole), lambda u: u["said"].rlike(ANCHOR))
    return rows.select("file", F.inline(found))


def own_licences(files: DataFrame, templates: dict[str, tuple[str, ...]], least: float) -> DataFrame:
    """(file, licence, cosine) of the files that have one; files: (file, path, text)."""
    spark = files.sparkSession
    rows = spark.createDataFrame(template_counts(templates), "licence string, variant int, token string, tf double")
    said = units(files).distinct()  # rows alike in id, path and text are compared once
    counted = stored(said.select("file", "unit", F.explode(tokens(F.col("said"))).alias("token")).groupBy("file", "unit", "token").agg(F.count("*").cast("double").alias("tf")), "licence-tokens")
    total = files.agg(F.count("*")).scalar()
    df = stored(files.select(F.explode(F.array_distinct(tokens(F.col("text")))).alias("token")).groupBy("token").agg(F.count("*").alias("df")), "token-files")
    idf = F.log(1 + total / (1 + F.coalesce("df", F.lit(0))))
    vectors = stored(rows.join(df, "token", "left").select("licence", "variant", "token", (F.col("tf") * idf).alias("tw")), "licence-vectors")  # as many rows as the templates have tokens
    norms = vectors.groupBy("licence", "variant").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("norm"))
    weighted = stored(counted.join(df, "token").select("file", "unit", "token", (F.col("tf") * idf).alias("w")), "licence-weights")
    dealt = weighted.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "unit")
    unit_norms = dealt.groupBy("file", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("unit_norm"))
    products = dealt.join(F.broadcast(vectors), "token").groupBy("file", "unit", "licence", "variant").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    scored = products.join(unit_norms, ["file", "unit"]).join(F.broadcast(norms), ["licence", "variant"]).withColumn("cosine", F.round(F.col("dot") / (F.col("unit_norm") * F.col("norm")), 9))
    best = scored.where(F.col("cosine") >= least).groupBy("file").agg(F.min(F.struct((-F.col("cosine")).alias("minus"), F.col("licence"))).alias("best"))
    out = stored(best.select("file", F.col("best.licence").alias("licence"), (-F.col("best.minus")).alias("cosine")), "licences")
    for table in (counted, df, weighted, vectors):
        drop_stored(table)
    return out


def directory(path: Column) -> Column:
    """'' for a file of the root."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan(files: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, least: float = 0.6, id_col: str = "file_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(id, path, licence, basis, cosine, licence_dir): basis is own, inherited or none."""
    id_, path, text = F.col(id_col), F.coalesce(F.col(path_col), F.lit("")), F.col(text_col)
    mark = F.md5(F.concat_ws("\n", F.coalesce(id_.cast("string"), F.lit("?")), F.concat(F.length(path).cast("string"), path), F.coalesce(F.md5(text.cast("binary")), F.lit("?"))))
    rows = files.select(mark.alias("file"), id_.alias("id"), path.alias("path"), text.alias("text"))
    own = own_licences(rows, templates, least)
    thin = rows.select("file", "id", "path", directory(F.col("path")).alias("dir"))
    named = thin.where(F.col("path").rlike(LICENCE_FILE)).join(own, "file")
    of_dir = named.groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("minus"), F.col("path"), F.col("licence"))).alias("best")).select(F.col("dir").alias("licence_dir"), F.col("best.licence").alias("licence"))
    parts = F.split("dir", "/")
    above = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))))
    nearest = thin.select("dir").distinct().select("dir", F.explode(F.array_distinct(above)).alias("licence_dir")).join(of_dir, "licence_dir").groupBy("dir").agg(F.max(F.struct(F.length("licence_dir").alias("depth"), F.col("licence_dir"), F.col("licence"))).alias("near")).select("dir", F.col("near.licence").alias("inherited"), F.col("near.licence_dir").alias("licence_dir"))
    out = thin.join(own, "file", "left").join(nearest, "dir", "left")
    basis = F.when(F.col("licence").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    return out.select("id", "path", F.coalesce("licence", "inherited").alias("licence"), basis.alias("basis"), "cosine", F.when(basis == "inherited", F.col("licence_dir")).alias("licence_dir"))
