"""The registered spelling queries over the whole vocabulary."""

import __spark_entry__ as entry
from prosemill.options import DEFAULT

DATA = "/root/testdata/sf0.01"


def deletes(words):
    return {w[:i] + w[i + 1 :] for w in words for i in range(len(w))}


def test_spelling_queries_take_the_whole_vocabulary(spark):
    run = entry.queries()
    freqs = {r["word"]: r["freq"] for r in run["token_freq"](spark, DATA).collect()}
    words = sorted((w for w, n in freqs.items() if n >= 2), key=lambda w: (-freqs[w], w.encode()))
    assert 2_000 < len(words) < DEFAULT.tier1_words
    vocab = run["vocab_topk"](spark, DATA).collect()
    assert sorted((r["idx"], r["word"], r["freq"]) for r in vocab) == [(i, w, freqs[w]) for i, w in enumerate(words)]
    index = run["delete_index"](spark, DATA).where("idx in (0, 199, 200, 1999, 2000) or idx % 997 = 0").collect()
    got = {}
    for r in index:
        got.setdefault(r["idx"], []).append(r["variant"])
    for i, variants in got.items():
        one = deletes({words[i]})
        assert sorted(variants) == sorted({words[i]} | one | deletes(one))
    assert {0, 199, 200, 1999, 2000} <= set(got)
