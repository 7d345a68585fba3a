"""Values that a dimension's targets don't name."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from prosemill.llm import mixing


def test_unnamed_values_keep_their_share(spark):
    langs = ["en"] * 500 + ["de"] * 300 + ["it"] * 100 + [None] * 100
    docs = spark.createDataFrame([(i, "eins zwei drei vier", "s", x) for i, x in enumerate(langs)], "doc_id bigint, text string, source string, lang string")
    targets = {"lang": {"en": 0.45, "de": 0.2, "fr": 0.2}}
    cells = {c[1]: c for c in mixing.calibrate(docs.select("source", F.coalesce("lang", F.lit("?")).alias("lang"), F.lit("t").alias("topic"), F.lit(4).alias("n_tokens")), targets, 0.5)}
    shares = {lang: c[4] for lang, c in cells.items()}
    assert shares == pytest.approx({"it": 0.1, "?": 0.1, "en": 0.8 * 0.45 / 0.65, "de": 0.8 * 0.2 / 0.65})
    got = Counter(r["lang"] for r in mixing.mix(docs, F.lit("t"), targets).select("lang").collect())
    assert all(got[lang] for lang in ("en", "de", "it", "?"))


def test_only_unnamed_values(spark):
    rows = spark.createDataFrame([("s", "it", "t", 3), ("s", "?", "t", 1)], "source string, lang string, topic string, n_tokens long")
    assert [c[4] for c in mixing.calibrate(rows, {"lang": {"en": 1.0}}, 0.5)] == pytest.approx([0.25, 0.75])


def test_targets_that_cannot_be_met_are_reported(spark):
    rows = spark.createDataFrame([("s", "en", "x", 5), ("t", "de", "y", 5)], "source string, lang string, topic string, n_tokens long")
    cells = mixing.calibrate(rows, {"source": {"s": 0.9, "t": 0.1}, "lang": {"en": 0.2, "de": 0.8}}, 0.5)
    assert [c[-1] for c in cells] == pytest.approx([0.4, 0.4])  # topics, raked last, have their own half each; sources miss 0.9 by 0.4
    met = mixing.calibrate(rows, {"source": {"s": 0.9, "t": 0.1}}, 0.5)
    assert met[0][-1] > 0.1  # languages and topics keep their shares, which those of the sources contradict
    cells = mixing.calibrate(rows, {"source": 0.5, "lang": 0.5, "topic": 0.5}, 0.5)
    assert [c[-1] for c in cells] == pytest.approx([0, 0])


def test_power_targets(spark):
    rows = spark.createDataFrame([("hot", "en", "x", 90), ("small", "en", "x", 10)], "source string, lang string, topic string, n_tokens long")
    assert [c[4] for c in mixing.calibrate(rows, {"source": 0.5}, 1.0)] == pytest.approx([0.75, 0.25])
    assert mixing.calibrate(rows.limit(0), {"source": 0.5}, 1.0) == []
