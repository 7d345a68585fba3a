"""Quality by compression: a text is likely good if a dictionary of good texts shortens it more than one of bad texts.

x = (size under bad - size under good) / bytes of the text, over the whole text in small blocks; isotonic
regression turns x into the probability of label 1.  A text that repeats itself gains from neither dictionary, so x
is near 0; clean prose gains from the good one.  Lines that several sampled texts share stay out of the dictionaries.

Training takes a bounded sample of labelled rows: of each label `per_label` texts of least md5(id), whole.  A label's
dictionary is made of whole texts in that order until it has `dictionary_bytes`.  The regression is fitted on the whole
texts of the first `calibration_docs` of each, in two folds: each half is measured, on the executors, with dictionaries
of the other half.  It is weighted to the labels' frequencies in the whole table.  Null ids, texts and labels are not
learned from; where a document has several labels each counts, and repeated rows count once.  A prediction sees nothing
but the text; null and empty texts have x = 0.  Without labelled rows of both kinds every score is the share of label 1,
or 0.5.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, drop_stored, sampled_ids, slices, stored
from .compression import Dictionaries, calibrated, collected, content, isotonic, logistic


@dataclass(frozen=True)
class QualityModel:
    dictionaries: Dictionaries | None
    slope: float
    intercept: float
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 by the feature: isotonic, with a trace of the logistic curve so that it rises everywhere."""
        smooth = logistic(x, self.slope, self.intercept)
        return smooth if self.knots is None else 0.98 * np.interp(x, *self.knots) + 0.02 * smooth

    def feature(self, text: bytes | None) -> float:
        if not text or self.dictionaries is None:
            return 0.0
        bad, good = self.dictionaries.sizes(text)
        return (bad - good) / len(text)

    def score(self, text: bytes | None) -> float:
        return float(self.scores(np.float64(self.feature(text))))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int = 2000, dictionary_bytes: int = 1 << 20, block: int = 128, calibration_docs: int = 800,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel:
    spark = docs.sparkSession
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)").where(learn).distinct()
    share = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(share) < 2:
        p = min(0.999, max(0.001, float(next(iter(share), 0.5))))
        return QualityModel(None, 0.0, float(np.log(p / (1 - p))))
    ids = sampled_ids(marked, "id", "label", per_label, share)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    found = stored(texts.join(F.broadcast(ids), "id").select("label", "_rank", "text").distinct(), "labelled-texts")
    rows = collected(found, "label", dictionary_bytes, fold="_rank % 2")
    lines = Counter(line for text in {text for _, _, text in rows} for line in set(text.split("\n")))

    def own(text: str) -> bytes:
        """Without lines that several texts share: they tell nothing of a text's quality."""
        return "\n".join(line for line in text.split("\n") if lines[line] == 1).encode()

    def dictionaries(fold: int | None) -> Dictionaries | None:
        """Of the rows outside the fold; of like size, so that neither helps by its length."""
        parts = [content((own(text) for of, rank, text in rows if of == label and rank % 2 != fold), dictionary_bytes) for label in (0, 1)]
        least = max(4096, min(map(len, parts)))
        return Dictionaries({"bad": parts[0][:least], "good": parts[1][:least]}, block) if all(parts) else None

    drafts = [QualityModel(dictionaries(fold), 1.0, 0.0) for fold in (0, 1)]
    whole = dictionaries(None)
    shared = spark.sparkContext.broadcast(drafts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            ranks, texts = batch.column(1).to_pylist(), as_bytes(batch.column(2))
            x = [shared.value[rank % 2].feature(text) if shared.value[rank % 2].dictionaries else None for rank, text in zip(ranks, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.float64())], names=["label", "x"])

    seen = sorted(map(tuple, found.where(F.col("_rank") <= calibration_docs).mapInArrow(run, "label int, x double").where("x is not null").collect()))
    drop_stored(found)
    x, y = np.array([x for _, x in seen], float), np.array([label for label, _ in seen], float)
    if whole is None or len(set(y)) < 2:
        return QualityModel(None, 0.0, float(np.log((share[1] + 1) / (share[0] + 1))))
    weight = np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum())
    weight *= len(y) / weight.sum()
    rise, level = isotonic(x, y, weight)
    return QualityModel(whole, *calibrated(x, y, weight, ridge=0.01), (rise, np.maximum.accumulate(level)))


def classify(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, feature) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            x = np.array([shared.value.feature(t) for t in as_bytes(batch.column(1))], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(x)), pa.array(x)], names=["id", "score", "feature"])

    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, score double, feature double")


def accepted(docs: DataFrame, model: QualityModel, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of docs, with their columns, whose score is `least_score` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            yield batch.filter(pa.array([shared.value.score(t) >= least_score for t in as_bytes(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
