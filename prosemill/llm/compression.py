"""Sizes of texts under zstandard with raw-content dictionaries: what the compression classifiers stand on."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Dictionaries:
    """A compressor per label, each with that label's raw content; sent as bytes and built where it is used."""

    def __init__(self, contents: dict[str, bytes], block: int, level: int = 3):
        self.contents, self.block, self.level = contents, block, level
        self.labels = list(contents)
        self._compress = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_compress": None}

    def sizes(self, text: bytes) -> list[int]:
        """Of the whole text in blocks of `block` bytes, each compressed on its own, by label: the dictionary's help
        doesn't fade with the length of a text, and a text doesn't become its own dictionary."""
        if self._compress is None:
            self._compress = []
            for content in self.contents.values():
                shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                shared.precompute_compress(level=self.level)
                self._compress.append(zstandard.ZstdCompressor(level=self.level, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        blocks = [text[i : i + self.block] for i in range(0, len(text), self.block)]
        return [sum(map(len, map(compress, blocks))) for compress in self._compress]


def collected(found: DataFrame, group: str, limit: int, fold: str = "0") -> list[tuple]:
    """(group, _rank, text) of found's rows, whole, sorted: in each group and fold the rows of least rank that together
    reach `limit` bytes.  So the driver gets `limit` bytes and one text of each at most."""
    sizes = found.groupBy(group, "_rank", F.expr(fold).alias("fold")).agg(F.sum(F.octet_length("text")).alias("bytes")).collect()
    have: dict[tuple, int] = {}
    wanted = []
    for r in sorted(sizes, key=lambda r: r["_rank"]):
        key = (r[group], r["fold"])
        if have.get(key, 0) < limit:
            have[key] = have.get(key, 0) + r["bytes"]
            wanted.append((r[group], r["_rank"]))
    if not wanted:
        return []
    few = found.sparkSession.createDataFrame(wanted, found.select(group, "_rank").schema)
    return sorted(map(tuple, found.join(F.broadcast(few), [group, "_rank"]).select(group, "_rank", "text").collect()))


def content(pieces: Iterable[bytes], limit: int) -> bytes:
    """Distinct texts, one after another, until they have `limit` bytes."""
    out, size = [], 0
    for piece in dict.fromkeys(pieces):
        if size >= limit:
            break
        out.append(piece)
        size += len(piece) + 1
    return b"\n".join(out)[:limit]


def calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """(slope, intercept) of a weighted logistic regression of y on x, by Newton steps; x is scaled inside."""
    spread = float(np.std(x)) or 1.0
    design = np.stack([x / spread, np.ones(len(x))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge * beta * [1, 0.1]
        curve = design.T @ (design * (weight * p * (1 - p))[:, None]) + np.diag([ridge, 0.1 * ridge])
        move = np.linalg.solve(curve, gradient)
        beta = beta + np.clip(move, -3, 3)
        if np.abs(move).max() < 1e-9:
            break
    return float(beta[0] / spread), float(beta[1])


def logistic(x: np.ndarray, slope: float, intercept: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * x + intercept, -40, 40)))


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (x, probability) of the increasing step fit by pooling neighbours that are out of order; one spare
    observation of either kind keeps probabilities off 0 and 1."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, weighted y, weighted x
    for w, a, b in zip(weight[order].tolist(), y[order].tolist(), x[order].tolist(), strict=True):
        pools.append([w, w * a, w * b])
        while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    spare = float(np.mean(weight))
    return np.array([p[2] / p[0] for p in pools]), np.array([(p[1] + spare / 2) / (p[0] + spare) for p in pools])
