"""The training-data operators against brute force, exact round trips and held-out accuracy."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prosemill.llm import chat, common, compression, decontam, graph, hmm, langid, license_scan, merkle, mixing, quality, queries, simhash, url_filter

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def documents(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def table(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# 1: url filters


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/"), ("http://example.net/de/x", "example.net", "/de/x", "net/"), ("x://notexample.net", "notexample.net", "", None),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/"), ("http://badexample.com/de/", "badexample.com", "/de/", None), ("https://b.org/fr/1", "b.org", "/fr/1", "org/fr/"),
        ("https://b.org?x=/fr/", "b.org", "", None), (None, "", "", None), ("no scheme/a", "", "", None), ("http://x.net/a://b", "x.net", "/a://b", "net/"), ("http://ÄB.net/", "Äb.net", "/", "net/"),
    ],
)
def test_url_rules(spark, url, host, path, rule):
    pages = spark.createDataFrame([(1, url)], "page_id bigint, url string")
    outcomes = spark.createDataFrame([], "page_id bigint, good int")
    r = url_filter.filter_urls(pages, outcomes).first()
    assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
    assert r["verdict"] == ({v[1] + v[2]: v[0] for v in url_filter.RULES}[rule] if rule else "block")


def test_url_reputation(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 4}.d{i % 2}.com/a") for i in range(400)] + [(1000, "http://new.d1.com/")], "page_id bigint, url string")
    outcomes = spark.createDataFrame([(i, int(i % 2 == 1)) for i in range(400)] + [(None, 1), (5, None)], "page_id bigint, good int")
    got = {r["host"]: r["verdict"] for r in url_filter.filter_urls(pages, outcomes).collect()}
    assert got["h1.d1.com"] == "allow" and got["h0.d0.com"] == "block" and len(got) == 5
    longest = url_filter.filter_urls(pages, outcomes, rules=()).where("rule is not null").count()
    assert longest == 0


@pytest.mark.parametrize(
    ("host", "name", "domain", "suffix"),
    [("a.b.co.uk", "a.b.co.uk", "b.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk", "co.uk"), ("u:p@x.example.com:8080", "x.example.com", "example.com", "com"), ("x.example.com.", "x.example.com", "example.com", "com"), ("10.0.0.1:80", "10.0.0.1", "10.0.0.1", "10.0.0.1"), ("[::1]:80", "[::1]", "[::1]", "[::1]"), ("localhost", "localhost", "localhost", "localhost"), ("", "", "", "")],
)
def test_host_levels(spark, host, name, domain, suffix):
    rows = spark.createDataFrame([(host,)], "h string").select(url_filter.name_of(F.col("h")).alias("host"))
    assert tuple(url_filter.with_levels(rows).first()) == (name, domain, suffix)


def test_reputation_without_own_outcomes(spark):
    """Posterior means of hosts, recomputed level by level with the host's and the domain's own outcomes taken out."""
    hosts = {"a.x.com": (10, 9), "b.x.com": (4, 0), "c.y.com": (6, 6), "d.z.org": (20, 3), "e.z.org": (1, 1), "f.shop.co.uk": (8, 2), "new.x.com": (0, 0), "new.q.net": (0, 0)}
    level = lambda h, n: ".".join(h.split(".")[-n:])
    suffix = {h: level(h, 2) if h.endswith("co.uk") else level(h, 1) for h in hosts}
    domain = {h: level(h, 3) if h.endswith("co.uk") else level(h, 2) for h in hosts}
    total = lambda of, key: tuple(sum(hosts[h][i] for h in hosts if of[h] == key) for i in (0, 1))

    def strength(groups):
        groups = [g for g in groups if g[0]]
        n, k, m = sum(g[0] for g in groups), sum(g[1] for g in groups), len(groups)
        p = (k + 1) / (n + 2)
        below = p * (1 - p) * (n - sum(g[0] ** 2 for g in groups) / n - (m - 1))
        rho = (sum(g[0] * (g[1] / g[0] - p) ** 2 for g in groups) - p * (1 - p) * (m - 1)) / below if below > 0 else 0.1
        return 1 / max(0.001, min(0.9, rho)) - 1

    s0, s1, s2 = strength([total(suffix, x) for x in set(suffix.values())]), strength([total(domain, x) for x in set(domain.values())]), strength(list(hosts.values()))
    n, k = (sum(v[i] for v in hosts.values()) for i in (0, 1))
    want = {}
    for h, (hn, hk) in hosts.items():
        (dn, dk), (sn, sk) = total(domain, domain[h]), total(suffix, suffix[h])
        up = (sk - dk + s0 * (k + 1) / (n + 2)) / (sn - dn + s0)
        up = (dk - hk + s1 * up) / (dn - hn + s1)
        want[h] = (hk + s2 * up) / (hn + s2)
    names = spark.createDataFrame([(h,) for h in hosts], "host string")
    labelled = spark.createDataFrame([(h, *v) for h, v in hosts.items() if v[0]], "host string, n bigint, k bigint")
    got = {r["host"]: r["posterior_mean"] for r in url_filter.reputation(names, labelled, 1.645).collect()}
    assert got == pytest.approx(want)


# 2: licence scans


HEADER = """/*
 * Copyright 2020 Someone
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */

int main(void) { return 0; }
"""


def wrapped(name, i, head):
    """A template as a licence file has it: a heading, a copyright line, paragraphs of short lines."""
    words = license_scan.TEMPLATES[name][i].split()
    return f"{head}\n\nCopyright (c) 2021 Some Body\n\n" + "\n".join(" ".join(words[k : k + 11]) for k in range(0, len(words), 11))


def test_licences(spark):
    prose = [(100 + i, f"t/f{i}.txt", f"of the in and to is software copy any use this file may not be {i} " * 3) for i in range(40)]
    files = [(1, "a/LICENSE", wrapped("MIT", 5, "")), (2, "a/b/c.txt", "nothing"), (3, "a/b/d.txt", "x\nLicensed under CC BY-NC 4.0.\ny"), (4, "z/e.txt", None), (5, "a/b/COPYING", wrapped("BSD-3-Clause", 1, "BSD 3-Clause License")), (6, "a/b/q/r.txt", ""), (7, "ab/x.txt", "license plate of my car and so on"),
             (8, None, "MIT"), (9, "s/m.c", HEADER), (10, "s/n.py", "# SPDX-License-Identifier: GPL-3.0-or-later\nimport os"), (11, "s/u.txt", "ich gehe mit dem Hund"), (12, "s/LICENSE.md", wrapped("ISC", 1, "ISC License"))]
    got = {r["id"]: (r["licence"], r["basis"]) for r in license_scan.scan(spark.createDataFrame(files + prose, "file_id bigint, path string, text string")).collect()}
    own, inherited, none = (lambda x: (x, "own")), (lambda x: (x, "inherited")), (None, "none")
    assert {i: got[i] for i in range(1, 13)} == {1: own("MIT"), 2: inherited("BSD-3-Clause"), 3: own("CC-BY-NC-4.0"), 4: none, 5: own("BSD-3-Clause"), 6: inherited("BSD-3-Clause"), 7: none, 8: own("MIT"), 9: own("Apache-2.0"), 10: own("GPL-3.0"), 11: inherited("ISC"), 12: own("ISC")}
    assert got[100] == none


def test_licences_of_null_and_repeated_ids(spark):
    line = "Released under the MIT License."
    rows = [(None, "a/x", line), (None, "a/y", "nichts"), (7, "b/x", "eins\n" + line), (7, "b/y", "zwei\nLicensed under CC BY-NC 4.0."), (7, "b/y", "zwei\nLicensed under CC BY-NC 4.0."), (8, None, None), (None, None, None)]
    files = spark.createDataFrame([(*r, "z") for r in rows], "file_id bigint, path string, text string, token string")
    got = sorted(((r["id"], r["path"], r["licence"]) for r in license_scan.scan(files).collect()), key=repr)
    assert got == sorted([(None, "a/x", "MIT"), (None, "a/y", None), (7, "b/x", "MIT"), (7, "b/y", "CC-BY-NC-4.0"), (7, "b/y", "CC-BY-NC-4.0"), (8, "", None), (None, "", None)], key=repr)
    assert license_scan.scan(files.limit(0)).count() == 0


# 3: mixing


def test_rake_meets_targets():
    rng = np.random.default_rng(1)
    places = [np.repeat(np.arange(3), 8), np.tile(np.repeat(np.arange(2), 4), 3), np.tile(np.arange(4), 6)]
    targets = [np.array([0.2, 0.3, 0.5]), np.array([0.6, 0.4]), np.array([0.1, 0.2, 0.3, 0.4])]
    weight = mixing.rake(rng.random(24), places, targets)
    for place, target in zip(places, targets, strict=True):
        assert np.allclose(np.bincount(place, weights=weight), target, atol=1e-9)


def test_mixing_query(spark):
    """The query's rows, recomputed in plain Python."""
    rows = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text", "source", "lang", mixing.topic_of(F.col("text")).alias("topic")).collect()
    cells = collections.Counter()
    for r in rows:
        cells[r["source"], r["lang"], r["topic"]] += len(r["text"].encode().split())
    weight = {c: n / sum(cells.values()) for c, n in cells.items()}
    share = [{v: (n / sum(cells.values())) ** queries.TARGETS["source"] for v, n in _marginal(cells, 0).items()}, queries.TARGETS["lang"], queries.TARGETS["topic"]]
    for i in range(3):
        live = _marginal(cells, i)
        share[i] = {v: share[i].get(v, 0) for v in live}
        share[i] = {v: x / sum(share[i].values()) for v, x in share[i].items()}
    for _ in range(300):
        for i in range(3):
            now = _marginal(weight, i)
            weight = {c: w * share[i][c[i]] / now[c[i]] for c, w in weight.items()}
    total = sum(cells.values())
    factor = {c: weight[c] / sum(weight.values()) * total / cells[c] for c in cells}
    low, high = 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(n * min(1, mid * factor[c]) for c, n in cells.items()) <= total / 2 else (low, mid)
    keep = {r["doc_id"] for r in rows if int(hashlib.md5(f"mix-1{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52 < min(1, low * factor[r["source"], r["lang"], r["topic"]])}
    got = table(queries.op3_mixing(spark, MEDIUM))
    assert set(got) == keep and all(got[r["doc_id"]]["n_tokens"] == len(r["text"].encode().split()) for r in rows if r["doc_id"] in keep)


def _marginal(cells, i):
    out = collections.Counter()
    for c, n in cells.items():
        out[c[i]] += n
    return out


# 4: decontamination


def brute_spans(text, items, window=10):
    words = decontam.words_of(text.encode())
    hit, found = set(), set()
    for item, said in items:
        w = decontam.words_of(said.encode())
        for i in range(max(min(1, len(w)), len(w) - window + 1)):
            phrase = w[i : i + window]
            for j in range(len(words) - len(phrase) + 1):
                if words[j : j + len(phrase)] == phrase:
                    hit |= set(range(j, j + len(phrase)))
                    found.add(item)
    return len(words), len(hit), sorted(found)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab c", max_size=40), max_size=4), st.lists(st.text(alphabet="abc ", max_size=14), max_size=4), st.integers(1, 4))
def test_fm_index_against_brute_force(texts, items, window):
    items = [(str(i), t) for i, t in enumerate(items)]
    phrases = decontam.Phrases([(i, t.encode()) for i, t in items], window)
    symbols = [[phrases.vocabulary.get(w, 0) for w in decontam.words_of(t.encode())] for t in texts]
    got = [(n, h, i) for n, h, _, _, i in decontam.scan_shard(symbols, phrases)]
    assert got == [brute_spans(t, items, window) for t in texts]


def test_decontamination_blocks_and_spans(spark):
    docs = spark.createDataFrame([(1, "x A-b, c d e f g h i j k y"), (2, "nichts"), (3, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "b c d e f g h i j k"), (3, "kurz"), (4, None), (5, "")], "item_id bigint, text string")
    for block, blocks in ((1, 1), (1, 2), (1, 9), (1 << 20, 1)):
        r = table(decontam.decontaminate(docs, bench, block_bytes=block, pass_blocks=blocks), "id")
        assert (r[1]["n_words"], r[1]["n_hit"], r[1]["span_starts"], r[1]["span_ends"], r[1]["items"]) == (13, 11, [1], [12], ["1", "2"])
        assert r[2]["n_hit"] == r[3]["n_words"] == 0
        assert r[3]["n_hit"] == 0 and r[3]["items"] == []
        assert sorted(x["doc_id"] for x in decontam.clean(docs, bench, block_bytes=block, pass_blocks=blocks).collect()) == [2, 3]
    assert decontam.without_spans("x A-b, c d e f g h i j k y", [1], [12]) == "x  y"


def test_decontamination_passes_agree(spark):
    """Of the whole tables, one pass and many give the same rows."""
    docs, bench = (spark.read.parquet(f"{SMALL}/{x}.parquet") for x in ("documents", "benchmark"))
    one, many = (sorted(map(tuple, decontam.decontaminate(docs, bench, block_bytes=size, pass_blocks=2).collect()), key=repr) for size in (1 << 20, 1000))
    assert one == many and any(r[2] for r in one)
    size = bench.select(F.sum(F.length("text"))).first()[0]
    assert size > 4 * 1000  # so that there are several passes


def test_long_items_and_blocks_of_phrases(spark, monkeypatch):
    """Pieces of an item, and blocks of phrases, give what the whole does."""
    docs, bench = (spark.read.parquet(f"{SMALL}/{x}.parquet") for x in ("documents", "benchmark"))
    whole = sorted(map(tuple, decontam.decontaminate(docs, bench).collect()), key=repr)
    monkeypatch.setattr(decontam, "PIECE", 7)
    monkeypatch.setattr(decontam, "PHRASES", 50)
    items = collections.defaultdict(list)
    for r in decontam.pieces_of(bench, "item_id", "text", 10).collect():
        items[r["i"]].append(r["t"].split())
    windows = lambda w: {tuple(w[k : k + 10]) for k in range(max(min(1, len(w)), len(w) - 9))}
    for r in bench.collect():
        words = [w.decode() for w in decontam.words_of((r["text"] or "").encode())]
        assert set().union(*map(windows, items[str(r["item_id"])])) == windows(words)
    few = [(r["i"], r["t"].encode()) for r in decontam.pieces_of(bench, "item_id", "text", 10).collect()]
    phrases = decontam.Phrases(few)
    assert len(phrases.blocks) > 3
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    got = decontam.scan_shard([np.array([phrases.vocabulary.get(w, 0) for w in decontam.words_of((t or "").encode())]) for t in texts], phrases)
    assert sorted(got) == sorted(x[1:] for x in [(r[0], r[1], r[2], r[3], r[4], r[5]) for r in whole])


def test_sampled_positions_are_an_eighth():
    rng = np.random.default_rng(2)
    runs = rng.integers(1, 50, 20_000)
    runs[::500] = 0
    runs[-1] = 0
    index = decontam.FMIndex(runs, 50)
    assert len(index.places) < len(runs) / 8 + 2 * (runs == 0).sum()
    rows = np.arange(len(runs))
    assert sorted(index.locate(rows).tolist()) == rows.tolist()


# 5 and 6: compression classifiers


def test_language_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in queries.op5_language_id(spark, "/root/testdata/sf0.1").collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.98
    wrong = [r for r in held if r["accepted"] and r["lang_pred"] != lang[r["doc_id"]]]
    assert len(wrong) < 0.01 * len(held) and all(0 <= r["score"] <= 1 for r in held)


def test_quality_accuracy(spark):
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [r for r in queries.op6_quality_classifier(spark, "/root/testdata/sf0.1").collect() if r["held_out"] and r["doc_id"] in label]
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in held)


def test_compressed_sizes():
    import zstandard

    contents = {"a": b"abc " * 50, "b": b"xyz " * 50}
    text = b"abc xyz abc " * 20
    whole = compression.Dictionaries(contents, 64).sizes(text)
    for label, size in zip(contents, whole, strict=True):
        press = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(contents[label], dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)
        assert abs(size - sum(len(press.compress(text[i : i + 64])) for i in range(0, len(text), 64))) <= 8
    x, p = compression.isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert list(x) == [0, 1.5, 3] and list(p) == sorted(p)


def least_md5(ids):
    return sorted(ids, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())


def whole_texts(texts, limit):
    out = b""
    for t in dict.fromkeys(texts):
        if len(out) >= limit:
            break
        out += (b"\n" if out else b"") + t
    return out[:limit]


def packed_size(text, content, block):
    import zstandard

    shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    shared.precompute_compress(level=3)
    press = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)
    return sum(len(press.compress(text[i : i + block])) for i in range(0, len(text), block))


def test_language_query_by_brute_force(spark):
    """Dictionaries of whole texts of least md5, then the smallest size of every whole text."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    learn = [i for i in least_md5(rows) if zlib.crc32(str(i).encode()) % 4 != 2]
    by = collections.defaultdict(list)
    for i in learn:
        by[rows[i]["lang"]].append(rows[i]["text"])
    contents = {}
    for lang, texts in by.items():  # texts of together 512 KiB
        size = np.cumsum([0, *(len(t.encode()) for t in texts[0:800:2])])
        contents[lang] = whole_texts([langid.plain(t) for t, n in zip(texts[0:800:2], size, strict=False) if n < 1 << 19], 1 << 19)
    model = langid.fit(docs, F.coalesce(common.crc_mod("doc_id", 4) != 2, F.lit(False)))
    assert model.dictionaries.contents == contents
    got = table(queries.op5_language_id(spark, MEDIUM))
    for i in least_md5(rows)[:150]:
        sizes = {lang: packed_size(langid.plain(rows[i]["text"]), content, 512) for lang, content in contents.items()}
        order = sorted(sizes, key=lambda x: (sizes[x], -len(by[x]), x))
        margin = (sizes[order[1]] - sizes[order[0]]) / sizes[order[1]]
        if got[i]["lang_pred"] != "und":
            assert got[i]["lang_pred"] == order[0] and math.isclose(got[i]["margin"], margin, abs_tol=1e-12)
            assert math.isclose(got[i]["score"], 1 / (1 + math.exp(-(model.slope * margin + model.intercept))), rel_tol=1e-9)
            assert got[i]["accepted"] == (got[i]["score"] >= 0.5 and margin >= 0.01)


def test_quality_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    text, label = documents(spark, MEDIUM), {r["doc_id"]: r["quality"] for r in labels.collect()}
    learn = [i for i in least_md5(label) if zlib.crc32(str(i).encode()) % 4 != 2 and label[i] in (0, 1)]
    by = {v: [text[i] for i in learn if label[i] == v][:2000] for v in (0, 1)}
    lines = collections.Counter(line for t in {*by[0], *by[1]} for line in set(t.split("\n")))
    own = [whole_texts(["\n".join(x for x in t.split("\n") if lines[x] == 1).encode() for t in by[v]], 1 << 20) for v in (0, 1)]
    least = min(map(len, own))
    model = quality.fit(docs, labels, F.coalesce(common.crc_mod("id", 4) != 2, F.lit(False)))
    assert model.dictionaries.contents == {"bad": own[0][:least], "good": own[1][:least]}
    got = table(queries.op6_quality_classifier(spark, MEDIUM))
    for i in least_md5(text)[:150]:
        t = text[i].encode()
        x = (packed_size(t, own[0][:least], 128) - packed_size(t, own[1][:least], 128)) / len(t)
        smooth = 1 / (1 + math.exp(-(model.slope * x + model.intercept)))
        assert math.isclose(got[i]["score"], 0.98 * float(np.interp(x, *model.knots)) + 0.02 * smooth, rel_tol=1e-9)


def test_narrow_margins_are_rejected(spark):
    rows = [(i, f"wort{i} gleich", "de" if i % 2 else "en") for i in range(6)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True))
    got = langid.identify(spark.createDataFrame([(1, "ΑΒΓ αβγ")], "doc_id bigint, text string"), model, least_score=0.0).first()
    assert got["margin"] < 0.01 and not got["accepted"]


# 7: chat formatting


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a<|im_sep|>\n"]), st.text(alphabet="<|>\\im_endsartp ä\n", max_size=30)), max_size=5))
def test_chat_round_trip(turns):
    text, spans = chat.render(turns)
    assert chat.parsed(text) == turns
    assert [chat.unescaped(text[a:b]) for a, b in spans] == [t for _, t in turns]


def test_chat_query(spark):
    turns = collections.defaultdict(list)
    for r in sorted(spark.read.parquet(f"{MEDIUM}/conversations.parquet").collect(), key=lambda r: (r["conv_id"], r["turn"])):
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    turns[-1] = [(x, "<|im_end|><|im_start|>assistant ok") for x in ("user", "assistant")]
    got = table(queries.op7_chat_formatting(spark, MEDIUM), "conv_id")
    assert set(got) == set(turns)
    for conv, said in turns.items():
        masked = "".join(t for role, t in said if role == "assistant")
        want = (len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(), len(masked), hashlib.sha256(masked.encode()).hexdigest(), len(chat.render(said)[0]))
        assert tuple(got[conv])[1:] == want


# 8: Merkle fingerprints


def test_merkle_edits(spark):
    before = spark.createDataFrame([(1, "a\nb\n\nc\nd"), (2, "gleich")], "doc_id bigint, text string")
    after = spark.createDataFrame([(1, "a\nb\n\nc\nD\ne"), (2, "gleich")], "doc_id bigint, text string")
    assert sorted(map(tuple, merkle.edits(before, after).collect())) == [(1, 1, 1), (1, 1, 2)]


def test_likeness_after_insertions(spark):
    """A word put in anywhere changes the leaves around it; others keep their nodes."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abdefgnorstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    text = lambda w: "\n".join(" ".join(w[i : i + 50]) for i in range(0, len(w), 50))
    one = " ".join(words)
    rows = [(one, one), (one, "neu " + one), (one, one + " neu"), (one, " ".join([*words[:200], "neu", *words[200:]])), (text(words), text(words).replace("\n", "\n\n", 1)), (one, "ganz anders als vorher")]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", merkle.tree(F.col("a")).alias("x"), merkle.tree(F.col("b")).alias("y"))
    like = merkle.likeness(merkle.root(F.col("x")), merkle.leaves(F.col("x")), merkle.root(F.col("y")), merkle.leaves(F.col("y")))
    got = [r["like"] for r in df.select(like.alias("like")).collect()]
    assert got[0] == 1 and all(0.9 < x < 1 for x in got[1:4]) and got[5] < 0.1
    back = df.select("a", F.transform("x", lambda s: F.size(s["paragraphs"])).alias("n")).collect()
    assert [r["n"] for r in back] == [[1 + p.count("\n") for p in r["a"].split("\n\n")] for r in back]
    pieces = spark.createDataFrame([(t,) for t in (one, "", " ", "a", "a  b c  d\te es. x", "es es es es ", "x" * 5000)], "p string").select("p", F.regexp_extract_all("p", F.lit(merkle.LEAF), F.lit(0)).alias("l")).collect()
    assert all("".join(r["l"]) == r["p"] for r in pieces)


def test_next_with_ties_and_gaps(spark):
    rng = random.Random(3)
    rows = [(i, f"t{i}") for i in rng.sample(range(10**12), 300)] + [(7, "x"), (7, "y"), (7, "y"), (None, "n1"), (None, "n2"), (9, None)]
    rows += [(10**15 + i, f"u{i}") for i in range(300)]
    got = [(r["id"], r["text"], r["next_text"]) for r in merkle.with_next(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    mark = {r["s"]: r["h"] for r in spark.createDataFrame([(t or "",) for _, t in rows], "s string").select("s", F.xxhash64("s").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), mark[r[1] or ""], r[1] or ""))
    want = [(i, t or "", order[(k + 1) % len(order)][1] or "") for k, (i, t) in enumerate(order)]
    assert collections.Counter(got) == collections.Counter(want)
    one = merkle.with_next(spark.createDataFrame([(1, "allein")], "doc_id bigint, text string")).collect()
    assert [tuple(r) for r in one] == [(1, "allein", "allein")]


# 9: SimHash


def brute_components(fps: dict[int, int], distance: int = 3) -> dict[int, int]:
    parent = {i: i for i in fps}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(fps, 2):
        if (fps[a] ^ fps[b]).bit_count() <= distance:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: find(i) for i in fps}


def test_simhash_query(spark):
    def brute(text):
        words = (text or "").encode().translate(common.LOWER).split()
        grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    fps = {i: brute(t) for i, t in documents(spark, MEDIUM).items()}
    want = brute_components(fps)
    got = table(queries.op9_simhash_near_dedup(spark, MEDIUM))
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{f:016x}", want[i]) for i, f in fps.items()}


def test_simhash_links_of_random_clusters(spark):
    rng = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(12):
            fps.add(base)
            base ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 6])))
    ids = dict(enumerate(sorted(fps)))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in ids.values()]
    edges = simhash.links(spark.createDataFrame(signed, "fp bigint")).collect()
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 3 for r in edges)
    roots = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame([tuple(r) for r in edges], "a bigint, b bigint")).collect()}
    want = brute_components(ids)
    got = {i: roots.get(s, s) for i, (s,) in enumerate(signed)}
    assert {frozenset(k for k in got if got[k] == v) for v in got.values()} == {frozenset(k for k in want if want[k] == v) for v in want.values()}


@pytest.mark.parametrize(("low", "broadcast"), [(0, True), (0xDEADBEEF, True), ((1 << 32) - 1, False)])
def test_simhash_splits_crowded_keys(spark, monkeypatch, low, broadcast):
    """Most fingerprints share a half, but for a bit at most; some are linked, most aren't."""
    if not broadcast:
        monkeypatch.setattr(simhash, "MOST_BROADCAST", -1)
    rng = random.Random(low)
    fps = set()
    for high in [rng.getrandbits(32) for _ in range(500)] + [0, (1 << 32) - 1]:
        for _ in range(rng.choice([1, 1, 2, 4])):
            fps.add(high << 32 | low ^ rng.choice([0, 0, 1 << rng.randrange(32)]))
            high ^= sum(1 << b for b in rng.sample(range(32), rng.choice([1, 2, 3, 4])))
    fps |= {low << 32 | f >> 32 for f in rng.sample(sorted(fps), 200)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in sorted(fps)]
    df = spark.createDataFrame(signed, "fp bigint")
    keys = simhash.crowded(df, 16)
    assert keys.count() >= 2
    counts = simhash.split_crowded(simhash.signatures(df), keys, broadcast).groupBy("key").count()
    assert counts.agg(F.max("count")).first()[0] < 33 * 17  # the crowded keys have hundreds
    edges = [(r["a"], r["b"]) for r in simhash.links(df, most=16).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in edges)
    roots = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = brute_components({s: f for (s,), f in zip(signed, sorted(fps), strict=True)})
    assert {s: roots.get(s, s) for s in want} == want


# 10: hidden Markov scores


def naive_log(chain, sequence):
    state = chain.start
    total = 0.0
    for c in sequence:
        state = (state @ chain.step) * chain.emit[c]
        total += math.log(state.sum())
        state = state / state.sum()
    return total


def some_chain(states=3, classes=7, seed=2):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm.Chain(norm(rng.random(states), 0), norm(rng.random((states, states)), 1), norm(rng.random((classes, states)), 0))


def test_forward_and_counts():
    chain, rng = some_chain(), np.random.default_rng(4)
    sizes = np.array([1, 2, 128, 129, 300, 5, 1000])
    classes = rng.integers(0, 7, sizes.sum())
    pieces = hmm.Pieces(classes, sizes)
    texts = np.split(classes, np.cumsum(sizes)[:-1])
    assert np.allclose(hmm.forward(chain, pieces)[0], [naive_log(chain, t) for t in texts])
    sums = hmm.expected(chain, pieces)
    first, steps, emitted = np.split(sums, [3, 12])
    assert np.isclose(first.sum(), len(sizes)) and np.isclose(steps.sum(), sizes.sum())
    assert np.allclose(emitted.reshape(7, 3).sum(axis=1), np.bincount(classes, minlength=7))
    tiny = hmm.Pieces(classes[:4], np.array([4]))
    weight = {}  # expected steps by summing over all state paths
    for path in itertools.product(range(3), repeat=5):
        p = chain.start[path[0]]
        for a, b, c in zip(path, path[1:], classes[:4], strict=False):
            p *= chain.step[a, b] * chain.emit[c, b]
        weight[path] = p
    want = np.zeros((3, 3))
    for path, p in weight.items():
        for a, b in zip(path, path[1:], strict=False):
            want[a, b] += p / sum(weight.values())
    assert np.allclose(hmm.expected(chain, tiny)[3:12].reshape(3, 3), want)


def test_model_is_a_distribution(spark):
    """The empty text and all one-word texts, of every seen word and one unseen word for each class of endings: together
    they have no more than probability 1, and no less than what ends after a word at most."""
    train = [(i, t) for i, t in enumerate(["a b a", "b c", "a", "c c b d", ""] * 4)]
    unseen = {}
    for n in range(1000):
        unseen.setdefault(hmm.ending(b"u%d" % n, 2, 2), f"u{n}")
    probe = [(1000 + i, t) for i, t in enumerate(["", "a", "b", "c", "d", *unseen.values()])]
    assert set(unseen) == {3, 4}
    docs = spark.createDataFrame(train + probe, "doc_id bigint, text string")
    out = table(hmm.score(docs, F.col("id") >= 1000, states=2, own=2, hashed=2), "id")
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in out.values())
    total = sum(10 ** out[i]["score"] for i, _ in probe)
    assert 0.2 < total <= 1 + 1e-9
    assert sum(10 ** out[i]["base_score"] for i, _ in probe[:5]) < 1


def test_score_by_brute_force(spark, monkeypatch):
    """Of every text, by a given chain: the plain forward sum over its words' classes, and each word within its class."""
    own, hashed = 40, 6
    chain = some_chain(3, 1 + own + hashed, seed=9)
    monkeypatch.setattr(hmm, "trained", lambda *_: (chain, []))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10**6, "nie gesehen!"), (10**6 + 1, None)], "doc_id bigint, text string"))
    words = {r["doc_id"]: (r["text"] or "").encode().translate(common.LOWER).split() for r in docs.collect()}
    count = collections.Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    place = {w: k + 1 for k, w in enumerate(sorted(count, key=lambda w: (-count[w], w))[:own])}
    of = lambda w: place.get(w) or hmm.ending(w, own, hashed)
    size, kinds = collections.Counter(), collections.Counter()
    for w, n in count.items():
        size[of(w)] += n
        kinds[of(w)] += 1
    within = lambda w: 0.0 if w in place else math.log10((count[w] + 0.1) / (size[of(w)] + 0.1 * (kinds[of(w)] + 1)))
    got = table(hmm.score(docs, common.crc_mod("id", 10) == 0, states=3, own=own, hashed=hashed, block_words=5000), "id")
    for i, ws in words.items():
        want = naive_log(chain, [*map(of, ws), hmm.END]) / math.log(10) + sum(map(within, ws))
        assert math.isclose(got[i]["score"], want, rel_tol=1e-9), i


def test_training_raises_the_likelihood(spark):
    """Counts of a mixture by brute force; and rounds over blocks, which climb."""
    rng = np.random.default_rng(3)
    weight, emit = np.array([0.3, 0.7]), rng.random((5, 2))
    emit /= emit.sum(axis=0)
    sizes, sequence = np.array([3, 1, 4]), rng.integers(0, 5, 8)
    sums, total = hmm.mixture(weight, emit, sequence, sizes, at_once=2)
    texts, emitted, log = np.zeros(2), np.zeros((5, 2)), 0.0
    for part in np.split(sequence, np.cumsum(sizes)[:-1]):
        p = weight * np.prod(emit[part], axis=0)
        log += math.log(p.sum())
        texts += p / p.sum()
        for c in part:
            emitted[c] += p / p.sum()
    assert np.allclose(sums, [*texts, *emitted.ravel()]) and math.isclose(total, log)
    kind = "kind string, block bigint, bucket int, ids array<bigint>, held array<boolean>, sizes array<bigint>, words binary, counts binary, classes binary"
    rows = []
    for block in range(3):
        n = [int(x) for x in rng.integers(1, 30, 40)]
        classes = np.concatenate([rng.integers(1, 4, k) if t % 2 else rng.integers(3, 6, k) for t, k in enumerate(n)])
        rows.append(("texts", block, -1, list(range(40)), [t % 10 == 0 for t in range(40)], n, np.arange(sum(n), dtype=np.uint32).tobytes(), None, classes.astype(np.uint16).tobytes()))
    chain, climbed = hmm.trained(spark.createDataFrame(rows, kind), np.ones(6) * 300, 2, 3, 5, -1.0)
    assert len(climbed) == 5 and climbed[-1] > climbed[0] and np.allclose(chain.emit.sum(axis=0), 1)


def test_own_words_are_the_most_frequent(spark):
    """Of all training texts, whole, however often a task passes its counts on; ties by bytes."""
    docs = documents(spark, SMALL)
    count = collections.Counter(w for i, t in docs.items() if i % 3 for w in (t or "").encode().translate(common.LOWER).split())
    want = sorted(count, key=lambda w: (-count[w], w))
    rows = spark.createDataFrame([(i, i % 3 == 0, t) for i, t in docs.items()], "id bigint, held boolean, text string")
    assert hmm.frequent_words(rows, 50) == hmm.frequent_words(rows, 50, most=100) == want[:50]
    assert hmm.frequent_words(rows, len(want) + 1) == want and hmm.frequent_words(rows.limit(0), 5) == []


def test_hmm_query(spark):
    docs = documents(spark, MEDIUM)
    tokens = {i: [*(t or "").encode().translate(common.LOWER).split(), None] for i, t in docs.items()}
    count = collections.Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(count.values()), len(count)
    got = table(queries.op10_hidden_markov_scores(spark, MEDIUM))
    assert set(got) == set(docs)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (zlib.crc32(str(i).encode()) % 10 == 0, len(ws), sum(count[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel_tol=1e-9)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


# odd inputs


@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
def test_odd_documents(spark, which, request):
    docs = request.getfixturevalue(which)
    n = docs.count()
    bench = spark.createDataFrame([(1, "a b c d e f g h i j"), (None, None)], "item_id bigint, text string")
    none = bench.limit(0)
    learn = F.coalesce(common.crc_mod("doc_id", 4) != 2, F.lit(False))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(None).cast("int").alias("toxic"))
    found = decontam.decontaminate(docs, bench)
    assert found.count() == n and found.where("n_hit > 0").count() == (3 if n else 0)
    assert decontam.decontaminate(docs, none).where("n_hit = 0").count() == n
    model = langid.fit(docs, learn)
    got = langid.identify(docs, model)
    assert got.count() == n and got.where("id in (1, 2, 3, 9) and lang_pred != 'und'").count() == 0
    assert langid.accepted(docs, model).columns == docs.columns
    model = quality.fit(docs, labels, F.lit(True))
    assert quality.classify(docs, model).where("score between 0 and 1").count() == n
    assert quality.accepted(docs, model, 0.0).count() == n
    near = simhash.near_duplicates(docs)
    assert near.count() == n
    if n:
        assert {r["component_id"] for r in near.where("id in (6, 7)").collect()} == {6}
        assert {r["component_id"] for r in near.where("id in (1, 2, 3)").collect()} == {1}
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (6, 7)").count() == (1 if n else 0)
    scores = hmm.score(docs, common.crc_mod("doc_id", 10) == 0)
    assert scores.count() == n and scores.where("score > 0 or base_score > 0 or isnan(score)").count() == 0
    mixed = mixing.mix(docs, mixing.topic_of(F.col("text")), {}, 1.0)
    assert mixed.select(*mixing.columns_of(mixed, docs)).columns == docs.columns
    assert merkle.with_next(docs).count() == n and merkle.nodes(docs).where("section is null").count() == n
    files = docs.select(F.col("doc_id").alias("file_id"), F.lit(None).cast("string").alias("path"), "text")
    assert license_scan.scan(files).count() == n
    chats = docs.select(F.col("doc_id").alias("conv_id"), F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"), "text", "id", "key")
    assert chat.format_chats(chats, queries.TOKENIZER).count() == docs.select("doc_id").distinct().count()
    urls = docs.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), "id")
    assert url_filter.filter_urls(urls, labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))).count() == n


def test_repeated_and_clashing_rows(spark):
    """Repeated rows, and columns with the names that operators use inside, change no result of a row."""
    names = "digest string, node string, n string, gram string, root string, leaves string, tree string, host string, name string, domain string, suffix string, unit string, said string, licence string, held string, lang_pred string, tokens string"
    base = [(1, "eins zwei drei vier\n\nfünf sechs sieben"), (1, "eins zwei drei vier\n\nfünf sechs sieben"), (2, None), (3, "eins zwei drei acht")]
    full = spark.createDataFrame([(*r, *["?"] * 17) for r in base], f"doc_id bigint, text string, {names}")
    bare = full.select("doc_id", "text")
    rows = lambda df: sorted(map(str, df.collect()))
    bench = spark.createDataFrame([(1, "zwei drei"), (1, "zwei drei"), (2, None)], "item_id bigint, text string")
    assert rows(decontam.decontaminate(full, bench)) == rows(decontam.decontaminate(bare, bench))
    assert rows(merkle.with_next(full)) == rows(merkle.with_next(bare)) and rows(merkle.nodes(full)) == rows(merkle.nodes(bare))
    assert rows(simhash.near_duplicates(full)) == rows(simhash.near_duplicates(bare)) and rows(simhash.near_texts(full)) == rows(simhash.near_texts(bare))
    assert rows(hmm.score(full, F.lit(False), own=3, hashed=2)) == rows(hmm.score(bare, F.lit(False), own=3, hashed=2))
    assert simhash.deduplicated(full).columns == full.columns and simhash.deduplicated(full).count() == 3
    marked = full.withColumn("lang", F.lit("de"))
    assert langid.accepted(marked, langid.fit(marked, F.lit(True)), told_col="lang").columns == marked.columns
    assert [r["n"] for r in mixing.mix(full.withColumns({"source": F.lit("s"), "lang": F.lit(None).cast("string")}), F.lit("t"), {}, 1.0).agg(F.count("*").alias("n")).collect()] == [4]
    urls = full.select(F.col("doc_id").alias("page_id"), F.lit("http://a.b.com/x").alias("url"), "host", "name", "domain", "suffix")
    outcomes = spark.createDataFrame([(1, 1, "?"), (1, 1, "?"), (3, 0, "?")], "page_id bigint, good int, host string")
    got = url_filter.filter_urls(urls, outcomes).collect()
    assert len(got) == 4 and {(r["labelled"], r["good"]) for r in got} == {(5, 4)}
    assert url_filter.filter_urls(urls.limit(0), outcomes).count() == 0 and url_filter.filter_urls(urls, outcomes.limit(0)).where("abs(posterior_mean - 0.5) < 1e-9").count() == 4
    chats = full.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("assistant").alias("role"), "text", "name", "n")
    assert sorted(r["formatted"].count("<|im_start|>") for r in chat.format_chats(chats, queries.TOKENIZER).collect()) == [1, 1, 2]
    assert chat.format_chats(chats.limit(0), queries.TOKENIZER).count() == 0


def test_very_long_lines_and_paragraphs(spark):
    """One line of a megabyte: no stack is exhausted, nothing is cut."""
    long = "wort " * 200_000
    docs = spark.createDataFrame([(1, long + "Licensed under the MIT license."), (2, "x" * 1_000_000), (3, "a. " * 300_000)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["n"] for r in docs.select("doc_id", F.size(merkle.leaves(merkle.tree(F.col("text")))).alias("n")).collect()}
    assert got[2] == 1 and 1 <= got[1] <= 3 and got[3] >= 1
    back = docs.select(F.length(F.array_join(F.regexp_extract_all("text", F.lit(merkle.LEAF), F.lit(0)), "")).alias("m"), F.length("text").alias("n")).collect()
    assert all(r["m"] == r["n"] for r in back)
    files = docs.select(F.col("doc_id").alias("file_id"), F.lit("a/b").alias("path"), "text")
    assert license_scan.scan(files).count() == 3
    assert {r["component_id"] for r in simhash.near_duplicates(docs).collect()} == {1, 2, 3}
    assert hmm.score(docs, F.lit(False), own=3, hashed=2).where("score < 0").count() == 3
