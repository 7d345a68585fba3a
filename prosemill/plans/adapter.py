"""Wikitext pages out of the plain `documents` table: one SQL text that Spark and DuckDB both run.

Titles and markup are chosen by residues of doc_id so that every rule of the classifier fires and every step of
the sanitizer has work; page_id % 4 stands for the dump part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..sources.wiki import spread
from .stage import stage_root

ID = "CAST(doc_id AS STRING)"
NL = "chr(10)"


def _case(key: str, branches: dict[int, str], other: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN {v}" for k, v in branches.items()) + f" ELSE {other} END"


def _pick(modulus: int, *values: str) -> str:
    """SQL: the expressions in turn over the ids that share a residue of `modulus`."""
    span = modulus * len(values)
    return f"CASE doc_id % {span} - doc_id % {modulus} " + " ".join(f"WHEN {modulus * i} THEN {x}" for i, x in enumerate(values)) + " END"


def _turn(modulus: int, *terms: str) -> str:
    return _pick(modulus, *(f"'{x}'" for x in terms))


LISTS = [f"{head} {link}" for head in P.LIST_HEADS for link in P.LIST_LINKS]
MONTHS = [m.capitalize() for m in P.MONTHS]
PROMO = ("Reality-Show-Teilnehmerin", "Realitystar", "Reality-TV-Star", "Webvideoproduzent", "Influencer", "Keyaccounter", "Tokio Hotel", "Playmate", "Gogo-Tänzerin", "Escort", "Internetphänomen", "Meme")
ROLES = ("Realityshow-Teilnehmer", "Reality-Star", "Webvideoproduzentin", "Influencerin", "Tiktoker", "Streamerin", "Sänger", "Band", "Musikerin", "Schauspieler", "Modell", "Model", "Tänzerin", "Synchronsprecher", "Rapper")
FICTION = ("Figur", "Figuren", "Person", "Charaktere", "Orte", "Schauplätze", "Handlung", "Welten", "Universum")
SHOWS = ("Reality-Show-Teilnehmer", "Realitytv-Teilnehmer", "Reality-Show-Kandidat", "Teilnehmer einer Reality-Show", "Big-Brother-Teilnehmer", "Dschungelcamp", "Internetphänomen", "Webvideoproduzent")
TITLES = {
    1: f"{_turn(40, *LISTS)} || ' Dingen ' || {ID}",
    2: _pick(40, "CAST(1000 + doc_id % 1000 AS STRING)", "CAST(1 + doc_id % 99 AS STRING) || ' v. Chr.'"),
    4: f"CAST(1 + doc_id % 28 AS STRING) || '. ' || {_turn(40, *MONTHS)}",
    5: _pick(40, *(f"'Serie {w.capitalize()} ' || {ID}" for w in P.EPISODE_WORDS), *(f"CAST(1 + doc_id % 9 AS STRING) || '. {w.capitalize()}'" for w in P.EPISODE_WORDS), f"'Doc ' || {ID} || ' (Episode)'", "'Folgenliste'", "'Staffelliste'"),
    6: f"'Doc ' || {ID} || ' (' || {_turn(40, *FICTION)} || ')'",
    7: f"'Doc ' || {ID} || ' (' || {_turn(40, *PROMO)} || ')'",
    8: f"{_turn(40, *P.NAMESPACES)} || ':Doc ' || {ID}",
    9: f"'Person ' || {ID} || ' (' || {_turn(40, *ROLES)} || ', *' || {_turn(40, '1950', '1999', '2000', '2019', '1949')} || ')'",
    11: "'Doc ' || CAST(doc_id - 1 AS STRING)",
    12: "'   '",
    14: "'Episodenliste'",
    15: _turn(40, "19. Jahrhundert", "3. Jahrhundert v. Chr."),
    16: f"'  doc_' || {ID} || '  x '",
}
BANNERS = {
    16: f"'{{{{' || {_turn(50, 'Stub', 'Substub|x')} || '}}}}'",
    17: f"'{{{{' || {_turn(50, *(w.capitalize() for w in P.QUALITY_TEMPLATES))} || '}}}}'",
    18: "'{{Werbung}}{{Veraltet}}'",
    19: f"'{{{{' || {_turn(50, 'SLA|x', 'Löschantrag|x', 'Löschantragstext|x', 'URV')} || '}}}}'",
    20: f"{NL} || '{{{{' || {_turn(50, 'Zukunft', 'Zukunft2', 'Zukunftsmusik|x')} || '}}}}' || {NL}",
    21: "'Plan: 2031{{Zukunft|2031}}'",
    22: f"'{{{{' || {_turn(50, 'Belege fehlen', 'Belegt nicht')} || '}}}}'",
    24: f"{NL} || '== Teil ==' || {NL} || '{{{{Belege fehlen}}}}' || {NL}",
    25: f"'{{{{Belege fehlen|x|' || {_turn(50, 'Dieser Abschnitt', 'die beiden Absätze', 'Nur ein Absatz', 'diese Tabelle')} || '}}}}'",
    26: "'[[Kategorie:Begriffsklärung]]'",
    27: f"'[[Kategorie:' || {_turn(50, *SHOWS)} || ']]'",
    28: "'Doc steht für: '",
    29: "'{{Taxobox | x}}'",
    30: f"'[[Kategorie:' || {_turn(50, 'Figur in Serien', 'Figuren aus Serien', 'Person aus Serien', 'Fernsehserien-Episode', 'Episodenliste')} || ']]'",
    31: "repeat('[[Doc 1|D]]', 1500)",
    34: f"{NL} || '== Teil ==' || {NL} || '{{{{Belege fehlen|x|2=' || {_turn(50, 'Dieser Artikel', 'Der ganze Text')} || '}}}}' || {NL}",
    35: "'{{Infobox|a={{b}}|c}}'",
    36: "'http://x.example/a?b=1 '",
}
MARKUP = " || ".join(
    [
        "'[[Doc ' || CAST((3 * doc_id) % 97 AS STRING) || ']] und [[doc_' || CAST((5 * doc_id) % 89 AS STRING) || '#Teil|das andere]] '",
        "chr(39) || chr(39) || chr(39) || 'fett' || chr(39) || chr(39) || chr(39) || ' &amp;amp; Co. &ouml;&nbsp;&#8211; &#x41;&copy;&amp;uuml;<!-- weg --><ref name=a>Quelle</ref><ref name=b/> <b>b</b> '",
        "'[http://x.example Label] [http://x.example] [ˈmɪlə] 47° 5′ N, 15° 27′ O [[Kategorie:Thema]] [[Datei:x.jpg|mini|Bild]] {{Vorlage|a}} '",
        f"{NL} || '{{| class=x' || {NL} || '|-' || {NL} || '| a || b' || {NL} || '|}}' || {NL} || '| rest | zelle |' || {NL} || '|-' || {NL}",
    ]
)
TAIL = " || ".join([NL, "'== Literatur =='", NL, "'* Buch eins'", NL, "'=== Band ==='", NL, "'* Buch zwei'", NL, "'== Ende =='", NL, "'Schluss.'", NL, "'== '", _turn(1, "Weblinks", "Einzelnachweise", "Siehe auch"), "' =='", NL, "'* [http://x.example y]'"])
SHORT = "CASE WHEN doc_id % 50 = 32 THEN 'Kurz.' ELSE coalesce(text, '') END"
RAW = f"CASE WHEN doc_id % 10 = 3 THEN ' #WEITERLEITUNG [[Doc ' || CAST((7 * doc_id + 1) % 150 AS STRING) || ']]' WHEN doc_id % 50 = 37 THEN '#redirect kaputt [[' WHEN doc_id % 50 = 32 THEN 'Kurz.' ELSE {_case('doc_id % 50', BANNERS, chr(39) * 2)} || {SHORT} || {NL} || {MARKUP} || {TAIL} END"
TITLE = _case("doc_id % 40", TITLES, f"'Doc ' || {ID}")


def pages_sql(documents: str) -> str:
    return f"SELECT doc_id AS page_id, doc_id % 4 AS part, {TITLE} AS title, {RAW} AS raw FROM {documents}"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    text = pages_sql("DOCUMENTS").replace("{", "{{").replace("}", "}}").replace("DOCUMENTS", "{documents}")
    rows = spark.sql(text, documents=documents)
    # computed once: the long CASE expressions aren't copied into every rule that reads a title or a text
    return rows.select("page_id", "part", F.explode(F.array(F.struct("title", "raw"))).alias("p")).select("page_id", "part", "p.title", "p.raw")


#: Namespaces of the dump by residue of the id: another one, none said, else the main one.
NS = "CASE page_id % 9 WHEN 1 THEN '<ns>1</ns>' WHEN 2 THEN '' ELSE '<ns>0</ns>' END"


def dump_files(spark: SparkSession, sf_dir: str) -> str:
    """The pages as XML dump files; the folder's path."""
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(F.lit("<page>\n<title>"), escaped(F.col("title")), F.lit("</title>"), F.expr(NS), F.lit("<id>"), F.col("page_id").cast("string"), F.lit('</id><revision><text bytes="1">'), escaped(F.col("raw")), F.lit("</text></revision></page>"))
    return _written(pages(spark, sf_dir).select(page), "dump")


def text_files(spark: SparkSession, sf_dir: str) -> str:
    """The documents as extracted text files; the folder's path."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return _written(rows.select(F.concat(F.lit('<doc id="'), F.col("doc_id"), F.lit('" title="Doc '), F.col("doc_id"), F.lit('">\n'), F.coalesce("text", F.lit("")), F.lit("\n</doc>\n"))), "extracted")


def _written(lines: DataFrame, tag: str) -> str:
    path = f"{stage_root(lines.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    lines.write.option("maxRecordsPerFile", 1000).text(path)
    return path
