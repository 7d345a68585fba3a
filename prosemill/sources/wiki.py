"""Sources of pages (page_id, part, title, raw): XML dumps, extracted text files, and the adapter over plain documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

#: Elements whose content is no text of a page.
NO_TEXT = ("ref", "references", "gallery", "timeline", "math", "chem", "score", "graph")
DUMP_FILES = "*-pages-articles*"
#: How deep elements of one name within each other are cut out.
NESTING = 4


def spread(rows: DataFrame) -> DataFrame:
    """Rows of few unsplittable files dealt to all cores; where there are partitions enough nothing moves."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def parts(spark: SparkSession, path: str, glob: str = DUMP_FILES) -> list[str]:
    """The dump's files by name, with their full paths."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path")
    return sorted((r["path"] for r in rows.collect()), key=lambda p: (p.rpartition("/")[2], p))


def _pages(spark: SparkSession, path: str | list[str], glob: str | None) -> DataFrame:
    """(file, xml): a row per page, as it stands in the file; files are cut at the end tags of pages, so bz2 files too are
    read by as many tasks as they have splits."""
    reader = spark.read.option("lineSep", "</page>")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("xml"))
    return rows.where(F.col("xml").rlike(r"<page[\s>]"))


def _element(xml: Column, name: str) -> Column:
    """Content of the first element of that name, '' for an empty one, null for none."""
    found = F.regexp_extract(xml, rf"(?s)<{name}(?:\s[^>]*+)?(?:/>|(?<!/)>(.*?)</{name}\s*>)", 1)
    return F.when(xml.rlike(rf"<{name}[\s>/]"), found)


def _whole(xml: Column) -> Column:
    """Whether a page has its title and, if it has revisions, the first one's end."""
    return xml.rlike(r"</title\s*>|<title\s*/>") & (~xml.rlike(r"<revision[\s>]") | xml.rlike(r"</revision\s*>"))


def unescaped(text: Column) -> Column:
    """The five entities of XML and character references."""
    code = lambda r: F.when(F.startswith(r, F.lit("x")), F.conv(F.substring(r, 2, 8), 16, 10)).otherwise(r).cast("bigint")
    char = lambda r: F.decode(F.unhex(F.lpad(F.hex(code(r)), 8, "0")), "UTF-32")
    refs = F.array_distinct(F.regexp_extract_all(text, F.lit("&#(x[0-9A-Fa-f]{1,6}|[0-9]{1,7});"), F.lit(1)))
    text = F.aggregate(refs, text, lambda t, r: F.replace(t, F.concat(F.lit("&#"), r, F.lit(";")), char(r)))
    for name, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        text = F.replace(text, F.lit(f"&{name};"), F.lit(sign))
    return text


def unreadable(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(part, n): the pages of each file that were cut off; dump() leaves them out."""
    return _pages(spark, path, glob).where(~_whole(F.col("xml"))).groupBy(F.col("file").alias("part")).agg(F.count("*").alias("n"))


def dump(spark: SparkSession, path: str | list[str], glob: str | None = None, missing_is_main: bool = True, drop_nested: bool = True) -> DataFrame:
    """Main-namespace pages of XML dumps, bz2 or plain; part is the file's path.  A missing <ns> counts as main, or with
    missing_is_main false drops the page.  The first revision's text is taken.  In malformed dumps elements stand inside
    the text: those that hold no text of a page are cut out, from the innermost on, of others the content stays; markup
    that is escaped, as it should be, is text.  Pages that were cut off are left out, see unreadable().

    A link pass takes missing_is_main=False and drop_nested=False."""
    xml = F.col("xml")
    rows = _pages(spark, path, glob).where(_whole(xml))
    ns = F.coalesce(strip(_element(xml, "ns")), F.lit("0" if missing_is_main else ""))
    text = F.coalesce(_element(_element(xml, "revision"), "text"), F.lit(""))
    if drop_nested:
        for _ in range(NESTING):
            text = F.regexp_replace(text, rf"(?s)<({'|'.join(NO_TEXT)})(?:\s[^>]*+)?(?:(?<=/)>|(?<!/)>(?:(?!<\1[\s>]).)*?</\1\s*>)", "")
    raw = unescaped(F.regexp_replace(text, r"</?[A-Za-z][^>]*+>", ""))
    title = strip(unescaped(F.coalesce(_element(xml, "title"), F.lit(""))))
    rows = rows.where(ns == "0").select(_element(xml, "id").cast("bigint").alias("page_id"), F.col("file").alias("part"), title.alias("title"), raw.alias("raw"))
    return spread(rows)


def extracted(spark: SparkSession, path: str) -> DataFrame:
    """Documents of extracted text files, from a line <doc ... title="..."> to a line </doc>; without a title the file's
    stem; part is the file's path, as base names repeat from folder to folder.  Every line of a body is its own
    paragraph, as in the format's reading."""
    files = spark.read.option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    docs = files.select("file", F.posexplode(F.regexp_extract_all("value", F.lit(r"(?dms)^(<doc[^>]*>.*?)^</doc"), F.lit(1))).alias("at", "doc"))
    head = F.regexp_extract("doc", r"<doc[^>]*>", 0)
    title = F.regexp_extract(head, r'title="([^"]*)"', 1)
    stem = F.regexp_replace(F.regexp_extract("file", r"([^/]*)$", 1), r"\.[^.]*$", "")
    body = F.regexp_replace(F.regexp_replace("doc", r"^<doc[^>]*>\n?", ""), "\n", "\n\n")
    return docs.select(F.col("at").cast("long").alias("page_id"), F.col("file").alias("part"), F.when(title != "", title).otherwise(stem).alias("title"), body.alias("raw"))


def sample(pages: DataFrame, n: int, least_chars: int = 200) -> DataFrame:
    """The first n pages by part and id whose prose has least_chars characters: a bench corpus."""
    from ..functions.sanitize import sanitize
    from ..operators.classify import once

    rows = once(pages.where(strip(F.col("title")) != ""), "text", sanitize(F.coalesce("raw", F.lit("")))).where(F.length("text") >= least_chars)
    return rows.orderBy("part", "page_id").limit(n).select("page_id", strip(F.col("title")).alias("title"), "text")


