"""The pipeline's stages against brute force on what came before each."""

import corpus_pipeline as pipeline
from prosemill.llm import decontam, langid, quality
from prosemill.llm.common import crc_mod, table
from pyspark.sql import functions as F

from test_near_dedup import brute_force

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    outs = [docs]
    for _, stage in pipeline.STAGES:
        df = stage(spark, outs[-1], SF)
        outs.append(spark.createDataFrame(df.collect(), df.schema))
    rows = [{r["doc_id"]: r for r in o.collect()} for o in outs]
    assert all(o.columns == docs.columns for o in outs[:-1]) and set(outs[-1].columns) > set(docs.columns)
    assert all(set(b) <= set(a) for a, b in zip(rows, rows[1:], strict=False))
    model = quality.fit(docs, table(spark, SF, "labels"), F.coalesce(crc_mod(F.col("id"), 4) != 2, F.lit(False)))
    assert set(rows[1]) == {i for i, r in rows[0].items() if model.score(r["text"].encode()) >= pipeline.LEAST_QUALITY}
    model = langid.fit(outs[1], F.coalesce(crc_mod("doc_id", 4) != 2, F.lit(False)))
    assert set(rows[2]) == {i for i, r in rows[1].items() if (p := model.predict(r["text"]))[0] != "und" and p[1] >= pipeline.LEAST_LANGUAGE and p[2] >= 0.01}
    assert all(r["lang"] == model.predict(r["text"])[0] for r in rows[2].values())
    left, _ = brute_force({i: r["text"] for i, r in rows[2].items()})
    assert set(rows[3]) == left
    items = {tuple(w[i : i + 10]) for r in table(spark, SF, "benchmark").collect() for w in [decontam.words_of(r["text"].encode())] for i in range(len(w) - 9)}
    dirty = {i for i, r in rows[3].items() if any(tuple(w[k : k + 10]) in items for w in [decontam.words_of(r["text"].encode())] for k in range(len(w) - 9))}
    assert dirty and set(rows[4]) == set(rows[3]) - dirty
    assert {r["doc_id"] for r in pipeline.run(spark, SF).collect()} == set(rows[5])
