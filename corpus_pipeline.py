"""Training-corpus pipeline: quality, language, near-duplicates, benchmark passages, mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.llm import decontam, langid, mixing, quality, simhash
from prosemill.llm.common import crc_mod, stored, table

#: A document goes if it is that likely a bad one; the classifier's own decision line is higher, as a filter that
#: drops should be surer than a report.
LEAST_QUALITY = 0.6
LEAST_LANGUAGE = 0.5


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learn = F.coalesce(crc_mod(F.col("id"), 4) != 2, F.lit(False))
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels"), learn), LEAST_QUALITY)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """From here on `lang` is the language that was told, which the mixture goes by."""
    learn = F.coalesce(crc_mod("doc_id", 4) != 2, F.lit(False))
    return langid.accepted(docs, langid.fit(docs, learn), LEAST_LANGUAGE, told_col="lang")


def by_likeness(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles of whole texts, similarity 0.8."""
    return simhash.deduplicated(docs)


def by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


#: Target marginals: languages that aren't named keep their own share of tokens; of the rest English is held at 45 %.
#: Sources go by a power of their own shares, so that a hot one doesn't fill the mixture.
TARGETS = {"source": 0.7, "lang": {"en": 0.45, "de": 0.2, "fr": 0.2, "es": 0.15}}
BUDGET = 0.7


def by_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, mixing.topic_of(F.col("text")), TARGETS, BUDGET)
    return mixed.select(*mixing.columns_of(mixed, docs), *(F.col(c).alias(f"mix_{c.removeprefix('mix_')}") for c in ("topic", "n_tokens", "chance", "mix_weight", "margin_miss")))


STAGES = [
    ("quality classifier", by_quality),
    ("language ID", by_language),
    ("SimHash near-dedup", by_likeness),
    ("benchmark decontamination", by_benchmark),
    ("mixing to target weights", by_mixture),
]

#: zstandard sizes and XXH64 have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
