"""Rules, sanitizer, link graph, tiers, store and spelling on small fixtures."""

import bz2
import struct
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prosemill.functions import sanitize as san
from prosemill.functions import text as tx
from prosemill.operators import audit, classify, linkgraph, search, spelling, store, tiering
from prosemill.options import Options
from prosemill.plans import build, stage
from prosemill.sources import wiki
from prosemill.streaming import ingest

PROSE = " ".join(f"Wort{i}" for i in range(60))


def pages(spark, rows):
    return spark.createDataFrame([(i, 0, t, r) for i, (t, r) in enumerate(rows)], "page_id bigint, part bigint, title string, raw string")


CASES = [
    ("   ", PROSE, "empty-title"), ("Datei:Foo.jpg", PROSE, "namespace-title"), ("wikipedia:X", PROSE, "namespace-title"),
    ("Liste von Bergen", PROSE, "list-article"), ("Übersicht der Orte", PROSE, "list-article"), ("Listenplatz", PROSE, "accepted"),
    ("A", " # WEITERLEITUNG [[X]]", "redirect"), ("A", "#redirect ohne Ziel", "redirect"), ("A", PROSE + "[[ Kategorie : Begriffsklärung]]", "disambiguation"),
    ("A", "{{Stub}}" + PROSE, "stub"), ("A", "{{Substub|x}}" + PROSE, "stub"), ("A", "{{Stubb}}" + PROSE, "accepted"),
    ("A", "{{Werbung}}" + PROSE, "quality-template"), ("A", "{{Werbung}}{{Veraltet}}" + PROSE, "accepted"),
    ("A", "Plan: 2031{{Zukunft|2031}} " + PROSE, "accepted"), ("A", "x\n {{Zukunft}} " + PROSE, "quality-template"),
    ("A", "{{Belege fehlen}}" + PROSE, "quality-template"), ("A", PROSE + "\n== H ==\n{{Belege fehlen}}", "accepted"),
    ("A", "{{Belege fehlen|x|Dieser Abschnitt}}" + PROSE, "accepted"), ("A", "{{Belege fehlen|x|die folgenden beiden Absätze}}" + PROSE, "accepted"),
    ("A", PROSE + "\n== H ==\n{{Belege fehlen|x|2=Dieser Artikel}}", "quality-template"), ("A", "{{Belege fehlen|x " + PROSE, "accepted"),
    ("A", PROSE + "[[Kategorie:Teilnehmer einer Reality-Show]]", "promo-category"), ("Max (Influencer)", PROSE, "promo-title"),
    ("Max (Sänger, *1999)", PROSE, "promo-title"), ("Max (Sänger)", PROSE, "accepted"), ("Max (Sänger, * 1999)", PROSE, "accepted"), ("Max (Sänger, *1949)", PROSE, "accepted"),
    ("1954", PROSE, "year-title"), ("44 v. Chr.", PROSE, "year-title"), ("12345", PROSE, "accepted"), ("3. Oktober", PROSE, "date-title"),
    ("19. Jahrhundert", PROSE, "date-title"), ("1. MÄRZ", PROSE, "date-title"), ("X Folge 3", PROSE, "episode-title"), ("2. Staffel", PROSE, "episode-title"),
    ("Episodenliste", PROSE, "episode-title"), ("Pilot (Episode)", PROSE, "episode-title"), ("Episode IV", PROSE, "accepted"),
    ("A", "{{SLA}}" + PROSE, "deletion-banner"), ("A", "{{Löschantragstext|x}}" + PROSE, "deletion-banner"), ("A", "{{URV|x}}" + PROSE, "deletion-banner"),
    ("Mond", "Mond steht für: " + PROSE, "disambiguation"), ("ADSL", "ADSL steht für Asymmetric " + PROSE, "accepted"),
    ("A", " ".join(["w"] * 49), "too-short"), ("A", " ".join(["w"] * 50), "accepted"), ("A", None, "too-short"), (None, PROSE, "empty-title"),
    ("A", "[[a]] " * 26 + "w " * 24, "link-heavy"), ("A", "[[a]] " * 25 + "w " * 25, "accepted"), ("1954", "{{Werbung}}" + PROSE, "quality-template"),
]


def test_rules(spark):
    got = {r["page_id"]: r["reason"] for r in classify.reasons(pages(spark, [(t, r) for t, r, _ in CASES])).collect()}
    assert [(c, got[i]) for i, c in enumerate(CASES) if got[i] != c[2]] == []


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("[[Berlin|Hauptstadt]] und [[Bonn]]", "Hauptstadt und Bonn"), ("'''A''' ''b''", "A b"), ("&amp;amp;", "&"), ("a&lt;ref&gt;x&lt;/ref&gt;b", "ab"),
        ("&lt;!-- x --&gt;", "<!-- x -->"), ("{{A|{{b}}|c}}", "{{A c}}"), ("[[Datei:x.jpg|mini|Bild von [[Berlin]] heute]]", "heute]]"),
        ("[http://x.de Label]", "Label"), ("[http://x.de http://y.de]", ""), ("[http://x.de]", ""), ("a\n\n\n\nb", "a\n\nb"), ("A\xa0\xa0B", "A B"),
        ("== X ==\nt1\n== Literatur ==\nt2\n=== Sub ===\nt3\n== Y ==\nt4", "== X ==\nt1\n== Y ==\nt4"), ("=== Weblinks ===\nx\n=== Weblinks ===\ny\n== Z ==", "== Z =="),
        ("52° 31′ N, 13° 24′ O x", "x"), ("a [ˈʔaːbə] b", "a b"), ("{|\n|-\n| a\n|}\nb", "b"), ("", ""), ("  \n ", ""), ("a\r\nb\x0bc", "a\nb\nc"),
    ],
)
def test_sanitize(spark, raw, clean):
    assert spark.createDataFrame([(raw,)], "raw string").select(san.sanitize(F.col("raw"))).first()[0] == clean


def test_long_template(spark):
    raw = "{{" + "x|y=z " * 60_000 + "}}ok"
    assert spark.createDataFrame([(raw,)], "raw string").select(san.sanitize(F.col("raw"))).first()[0] == "ok"


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="ab \n\t\xa0\x1f=[]{}|' ", max_size=60))
def test_sanitize_shape(spark, raw):
    clean = spark.createDataFrame([(raw,)], "raw string").select(san.sanitize(F.col("raw"))).first()[0]
    assert "\n\n\n" not in clean and clean == clean.strip() and "\xa0" not in clean


def test_scalars(spark):
    one = lambda x, f: spark.createDataFrame([(x,)], "s string").select(f(F.col("s"))).first()[0]
    assert [one(x, tx.fnv1a32) for x in ("", "a", "foobar", "ä")] == [2166136261, 3826002220, 3214735720, 429777122]
    assert one("foo_bar  x", tx.norm_title) == "Foo bar x" and one("ßa", tx.norm_title) == "SSa" and one("", tx.norm_title) == ""
    assert one("MX-5 in Köln_1 -abc- 123 ²³¹ " + "x" * 29, tx.tokens) == ["mx-5", "köln_1", "abc"]
    text = "a\xa0b\x1cc　d\x85e​f"
    assert one(text, tx.word_count) == len(text.split())
    assert one("[[Datei:x]] [[:Kategorie:y]] [[ a|b]] [[c]]", tx.content_links) == 2


def test_linkgraph(spark):
    rows = [("A", "[[b]] [[B|x]] [[B#y]] [[A]] [[R]] [[Star Trek: X]] [[#z]] [[Foo_Bar#x|y]]"), ("R", "#redirect [[A]]"), ("P", "#redirect [[Q]]"), ("Q", "#redirect [[P]]"), ("Z", "[[P]] [[T0]] [[S]]"), ("S", "#redirect [[S]]")]
    rows += [(f"T{i}", f"#redirect [[T{i + 1}]]") for i in range(17)]
    got = {r["target"]: r["indegree"] for r in linkgraph.indegrees(pages(spark, rows)).collect()}
    assert got == {"B": 3, "A": 1, "Foo Bar": 1, "Q": 1, "T16": 1, "S": 1}
    degrees = spark.createDataFrame([(str(i), i) for i in range(1, 11)], "target string, indegree bigint")
    assert {r["p"]: r["indegree"] for r in linkgraph.percentiles(degrees).collect()} == {10: 2, 50: 6, 90: 10, 99: 10}


def test_tiers(spark):
    rows = [(2000, "A (Figur)", "", 1), (1999, "B (Figur)", "", 2), (149, "C", "{{Taxobox", 2), (150, "D", "{{Taxobox|", 1), (299, "E", "", 2), (299, "F", "", 1), (300, "G", "", 1), (149, "H", "{{Taxobox|", 2)]
    articles = spark.createDataFrame([(w, t, r) for w, t, r, _ in rows], "words bigint, title string, raw string")
    degrees = spark.createDataFrame([("B (Figur)", 100), ("C", 3), ("D", 10), ("E", 3), ("F", 4), ("H", 10)], "target string, indegree bigint")
    got = {r["title"]: r["tier"] for r in tiering.tiers(articles, degrees).collect()}
    assert [got[t] for _, t, _, _ in rows] == [x for *_, x in rows]
    assert tiering.tiers(articles.where("title = 'E'"), None).first()["tier"] == 1


def test_store(spark):
    articles = spark.createDataFrame([(0, 0, "a", "ä"), (0, 1, "b", "bc"), (0, 2, "c", "d"), (1, 9000, "d", "e"), (1, 9001, "a", "zweites"), (1, 3, "e", "f\ng")], "part bigint, page_id bigint, title string, text string")
    options = Options(chunk_size=2)
    table = store.build(articles, options)
    got = {r["title"]: (r["id"], r["chunk_id"], r["offset"], r["length"]) for r in table.collect()}
    assert got == {"a": (1, 1, 0, 2), "b": (2, 1, 2, 2), "c": (3, 2, 0, 1), "e": (4, 3, 0, 3), "d": (5, 3, 3, 1)}
    store.check(table)
    back = {r["title"]: r["text"] for r in store.fetch(table, store.chunks(table, options)).collect()}
    assert back == {"a": "ä", "b": "bc", "c": "d", "d": "e", "e": "f\ng"}
    with pytest.raises(ValueError):
        store.check(table.where("id > 100"))
    with pytest.raises(ValueError):
        Options(chunk_size=0)


def test_spelling(spark, tmp_path):
    assert [spelling.damerau(*x) for x in (("teh", "the"), ("ca", "abc"), ("", "ab"), ("köln", "koln"))] == [1, 2, 2, 1]
    freqs = spark.createDataFrame([("abc", 9), ("aab", 8), ("the", 3), ("rar", 1)], "word string, freq bigint")
    vocab = spelling.vocabulary(freqs, Options(tier1_words=1))
    index = spelling.delete_index(vocab)
    count = {r["idx"]: r["n"] for r in index.groupBy("idx").agg(F.count("*").alias("n")).collect()}
    assert count == {0: 7, 1: 3, 2: 4}
    got = {(r["query"], r["word"]) for r in spelling.suggest(spark.createDataFrame([("teh",), ("acb",)], "query string"), vocab, index).collect()}
    assert ("teh", "the") in got and ("acb", "abc") in got
    path = tmp_path / "words.bin"
    stats = spelling.write_binary(vocab, index, str(path))
    data = path.read_bytes()
    magic, version, _, distance, _, tier1, words, entries, at, deletes = struct.unpack_from("<4sHHBBIIIQQ", data)
    assert (magic, version, distance, tier1, words, entries, at) == (b"OSSD", 1, 2, 1, 3, stats["entries"], 64)
    table = struct.unpack_from(f"<{entries}Q", data, deletes)
    assert list(table) == sorted(table) and len(data) == deletes + 8 * entries


def test_search(spark):
    table = spark.createDataFrame([(1, "Quantenphysik", "x", 1), (2, "Physik", "die quantenPHYSIK", 2), (3, "Mond", "x", 1)], "id bigint, title string, content_sample string, tier int")
    index = search.postings(table)
    hits = search.match(table, index, "QUANTEN")
    assert sorted(r["id"] for r in hits.collect()) == [1, 2]
    assert [r["id"] for r in search.top(hits).collect()] == [1]
    assert search.match(table, index, "qu").count() == 0
    assert [r["id"] for r in search.bm25(table, "quanten").collect()] == [1, 2]


def test_resume(spark, tmp_path):
    source, work = str(tmp_path / "pages"), str(tmp_path / "work")
    pages(spark, [(f"Seite {i}", PROSE + f" [[Seite {i // 2}]] mehr{i}") for i in range(20)]).write.parquet(source)
    seen = lambda: {p.name: p.stat().st_mtime_ns for p in (tmp_path / "work").iterdir()}
    build.corpus(spark.read.parquet(source), Options(chunk_size=7), work=work)
    before = seen()
    assert {n.rpartition("-")[0] for n in before} == {"degrees", "accepted", "articles", "vocabulary"}
    again = build.corpus(spark.read.parquet(source), Options(chunk_size=7), work=work)
    assert seen() == before and again.articles.count() == 20
    other = build.corpus(spark.read.parquet(source), Options(chunk_size=8), work=work)
    assert len(seen()) == 4 and not set(seen()) & set(before) and other.articles.count() == 20
    links = pages(spark, [("Nur", "[[Seite 3]]")])
    assert [r["target"] for r in build.corpus(spark.read.parquet(source), link_pages=links).degrees.collect()] == ["Seite 3"]


def test_stages_need_a_shared_folder(spark):
    kept = stage.staged(spark.range(3), "x")
    assert kept.count() == 3
    stage.drop_staged(kept)
    session = lambda folder, master: SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=SimpleNamespace(master=master, applicationId="a"))
    assert stage.shared_dir(session("hdfs://x/y/", "yarn")) == "hdfs://x/y"
    assert stage.shared_dir(session(None, "local[4]")) == stage.shared_dir(session(None, "local")).rstrip("/")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://x:7077"):
        with pytest.raises(RuntimeError):
            stage.shared_dir(session(None, master))


def test_reports(spark):
    rows = spark.createDataFrame([("b", 9, 1, False), ("a", 9, 1, False), ("c", 99, 1, True)], "title string, words bigint, chars bigint, in_store boolean")
    assert [r["text"] for r in audit.text_report(rows).orderBy("line").collect()] == ["3 rescued, 2 of them missing", "      9  a", "      9  b"]
    assert [r["text"] for r in audit.text_report(rows.limit(0)).collect()] == ["0 rescued, 0 of them missing"]
    speed = store.sweep(spark.createDataFrame([(1, "wort " * 50)], "page_id bigint, text string"), levels=(3, 22)).collect()
    assert {r["level"] for r in speed} == {3, 22} and all(r["mb_per_s"] > 0 and r["ratio"] > 5 for r in speed)
    with pytest.raises(ValueError):
        Options(level=20)


DUMP = """<mediawiki><page><title>007</title><ns>0</ns><id>7</id><revision><text bytes="1">  eins &amp; zwei </text></revision><revision><text>alt</text></revision></page>
<page><title>Ohne</title><id>8</id><revision><text>vor <ref>geheim</ref> nach</text></revision></page><page><title>Disk</title><ns>1</ns><id>9</id><revision><text>x</text></revision></page></mediawiki>"""


def test_sources(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x-pages-articles1.xml.bz2").write_bytes(bz2.compress(DUMP.encode()))
    (tmp_path / "d" / "other.xml").write_text("<page><title>no</title></page>")
    rows = {r["title"]: r["raw"] for r in wiki.dump(spark, str(tmp_path / "d"), "*pages-articles*").collect()}
    assert rows == {"007": "  eins & zwei ", "Ohne": "vor  nach"}
    assert [r["title"] for r in wiki.dump(spark, str(tmp_path / "d"), "*pages-articles*", missing_is_main=False).collect()] == ["007"]
    assert [p.rpartition("/")[2] for p in wiki.parts(spark, str(tmp_path / "d"))] == ["x-pages-articles1.xml.bz2"]
    odd = "<page><title>Innen</title><id>1</id><revision><text>a <ref>b <ref>c</ref> d</ref> e <b>f</b> &lt;ref&gt;g&lt;/ref&gt; &#228;&#x1F600; <ref name='x'/>h</text></revision></page>\n<page><title>Leer</title><id>2</id><revision><text/></revision></page><page><title>Ab</title><id>3</id><revision><text>halb"
    (tmp_path / "odd.xml").write_text(odd)
    got = {r["title"]: r["raw"] for r in wiki.dump(spark, str(tmp_path / "odd.xml")).collect()}
    assert got == {"Innen": "a  e f <ref>g</ref> ä😀 h", "Leer": ""}
    assert [r["n"] for r in wiki.unreadable(spark, str(tmp_path / "odd.xml")).collect()] == [1]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "wiki_00.txt").write_text('<doc id="1" title="T &amp; U">\nA\nB\n</doc>\n<doc id="2">\nC </doc> <doc>\n</doc>\n')
    got = {r["title"]: r["raw"].split() for r in wiki.extracted(spark, str(tmp_path / "e")).collect()}
    assert got == {"T &amp; U": ["A", "B"], "wiki_00": ["C", "</doc>", "<doc>"]}


def test_build_and_stream(spark, tmp_path):
    rows = pages(spark, [(f"Seite {i}", f"[[Seite {i // 2}]] " + PROSE + f" mehr{i}") for i in range(30)])
    built = build.corpus(rows, Options(chunk_size=7))
    out = str(tmp_path / "out")
    build.publish(built, out)
    first = build.published(spark, out)
    assert first and not build.published(spark, str(tmp_path / "none"))
    (tmp_path / "out" / "v000002" / "articles").mkdir(parents=True)  # a publish that stopped half way
    assert build.published(spark, out) == first and build.opened(spark, out)["articles"].count() == 30
    build.publish(built, out)
    assert build.published(spark, out).endswith("v000003") and set(build.opened(spark, out)) == {"articles", "chunks", "postings", "vocabulary", "deletes", "degrees"}
    with pytest.raises(FileNotFoundError):
        build.opened(spark, str(tmp_path / "none"))
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second call finds nothing new
        ingest.ingest(ingest.pages(spark, str(tmp_path / "in")), str(tmp_path / "stream"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "stream")).count() == 30
    ingest.reason_counts(ingest.pages(spark, str(tmp_path / "in")), "reasons").awaitTermination()
    assert spark.table("reasons").collect()[0]["n"] == 30
