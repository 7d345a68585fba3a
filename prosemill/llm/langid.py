"""Language identification by compression: the dictionary of the language that makes a text smallest wins.

Training takes a bounded sample of labelled rows: of each language `per_language` texts of least md5(id), whole.  Odd
ones, whole and in that order until there are `dictionary_bytes`, become the language's raw-content dictionary; the first
200 even ones calibrate the score on the executors: the probability that the choice is right, by logistic regression
on the margin.  Labels tell which texts are of a language in training; a prediction sees nothing but the text.

The margin is how much smaller, as a share, the best size is than the second; of equal sizes the language with more
labelled texts wins.  Null texts and texts without a letter are `und`, score 0.  A text is accepted if its score is
`least_score` or more and its margin `least_margin` or more.  Languages must number `most_languages` at most.  Null
languages and null ids are not learned from; repeated rows count once.  Without any labelled text all rows are `und`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, drop_stored, sampled_ids, slices, stored
from .compression import Dictionaries, calibrated, collected, content, logistic

UNKNOWN = "und"
LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_LETTER = regex.compile(r"\p{L}")


def plain(text: str) -> bytes:
    """Lower-cased, ASCII that is no letter as single spaces."""
    return b" ".join(text.lower().encode().translate(LETTERS).split())


@dataclass(frozen=True)
class LanguageModel:
    dictionaries: Dictionaries
    slope: float
    intercept: float
    known: dict[str, int]  # labelled texts by language

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin)."""
        if not text or not self.dictionaries.labels or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0.0
        sizes = self.dictionaries.sizes(plain(text))
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], -self.known[self.dictionaries.labels[i]], self.dictionaries.labels[i]))
        margin = (sizes[order[1]] - sizes[order[0]]) / max(1, sizes[order[1]]) if len(order) > 1 else 1.0
        return self.dictionaries.labels[order[0]], float(logistic(np.float64(margin), self.slope, self.intercept)), margin


def fit(docs: DataFrame, learn: Column, per_language: int = 800, dictionary_bytes: int = 1 << 19, block: int = 512, most_languages: int = 500,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    labelled = docs.where(learn).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("id is not null and lang is not null and text is not null")
    known = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(most_languages + 1).collect()}
    if len(known) > most_languages:
        raise ValueError(f"over {most_languages} languages")
    ids = sampled_ids(labelled, "id", "lang", per_language, {r["lang"]: r["n"] for r in labelled.select("lang", "id").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()})
    found = stored(labelled.join(F.broadcast(ids), ["id", "lang"]).select("lang", "_rank", "text").distinct(), "labelled-texts")
    by: dict[str, list[str]] = {}
    for lang, _, text in collected(found.where("_rank % 2 = 1"), "lang", dictionary_bytes):
        by.setdefault(lang, []).append(text)
    draft = LanguageModel(Dictionaries({lang: content(map(plain, texts), dictionary_bytes) for lang, texts in by.items()}, block), 1.0, 0.0, known)
    shared = docs.sparkSession.sparkContext.broadcast(draft)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            got = [shared.value.predict(t.decode()) for t in as_bytes(batch.column(1))]
            right = [None if g[0] == UNKNOWN else g[0] == lang for g, lang in zip(got, batch.column(0).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([g[2] for g in got], pa.float64()), pa.array(right, pa.bool_())], names=["margin", "right"])

    seen = sorted(map(tuple, found.where("_rank % 2 = 0 and _rank <= 400").select("lang", "text").mapInArrow(run, "margin double, right boolean").where("right is not null").collect()))
    drop_stored(found)
    x, y = [0.0, 0.3, *(m for m, _ in seen)], [0.0, 1.0, *(float(ok) for _, ok in seen)]  # a narrow and a wide margin, so that both outcomes occur
    return LanguageModel(draft.dictionaries, *calibrated(np.array(x), np.array(y), np.ones(len(x)), ridge=0.01), known)


def is_accepted(found: tuple[str, float, float], least_score: float, least_margin: float) -> bool:
    return found[0] != UNKNOWN and found[1] >= least_score and found[2] >= least_margin


def identify(docs: DataFrame, model: LanguageModel, least_score: float = 0.5, least_margin: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, margin, accepted) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = [shared.value.predict(t.decode() if t is not None else None) for t in as_bytes(batch.column(1))]
            langs, scores, margins = (pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64())))
            accepted = pa.array([is_accepted(f, least_score, least_margin) for f in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), langs, scores, margins, accepted], names=["id", "lang_pred", "score", "margin", "accepted"])

    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double, margin double, accepted boolean")


def accepted(docs: DataFrame, model: LanguageModel, least_score: float = 0.5, least_margin: float = 0.01, text_col: str = "text", told_col: str | None = None) -> DataFrame:
    """The rows of docs, with their columns, whose language is told; with `told_col` that column, of strings, says which."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    told = docs.columns.index(told_col) if told_col else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            found = [shared.value.predict(t.decode() if t is not None else None) for t in as_bytes(batch.column(at))]
            if told is not None:
                kind = batch.schema.field(told).type
                batch = pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], kind) if i == told else c for i, c in enumerate(batch.columns)], names=batch.schema.names)
            yield batch.filter(pa.array([is_accepted(f, least_score, least_margin) for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
