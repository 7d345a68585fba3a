"""Mixing sources to target weights by iterative proportional fitting, and sampling by the calibrated probabilities.

Token weights are summed into the cells of source x language x topic.  Raking multiplies the cells by factors until
the marginal shares of each dimension meet their targets; cells that hold no tokens stay empty.  A dimension's targets
are shares by value, or a power: shares in proportion to the values' own shares to that power, which lifts small
values.  Values that the targets don't name, the missing value '?' among them, keep their own share of tokens, and the named
targets are rescaled to what remains and to the values that occur.  Targets that no weights of the cells can meet
together leave the last dimension's met; `margin_miss`, in every row, is by how much the worst marginal share misses.

A document's probability is min(1, scale x its cell's factor), where scale is the greatest at which expected tokens
are at most `budget` times the corpus; it is sampled by a hash of its id, so that a sample repeats and a greater budget
contains it.  Each kept document carries `mix_weight`, target over expected share of its cell (1 where the probability
did not reach 1).

The cells are a table of at most `most_cells` rows, checked before it comes to the driver; documents are joined to
it by a broadcast of that size.  Null dimension values are the value '?'.  Null and wordless texts weigh 0 tokens but are sampled like
others.  A null id hashes as ''.  Repeated rows stay or go together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "?"
DIMENSIONS = ("source", "lang", "topic")


def rake(cells: np.ndarray, places: list[np.ndarray], targets: list[np.ndarray], rounds: int = 200, close: float = 1e-12) -> np.ndarray:
    """Cell weights, summing to 1, whose marginals are the targets; `places` gives each cell's value per dimension."""
    weight = cells / cells.sum()
    for _ in range(rounds):
        off = 0.0
        for place, target in zip(places, targets, strict=True):
            now = np.bincount(place, weights=weight, minlength=len(target))
            factor = np.divide(target, now, out=np.zeros(len(target)), where=now > 0)
            off = max(off, float(np.abs(now - target)[now > 0].max(initial=0)))
            weight = weight * factor[place]
        if off < close:
            break
    return weight / weight.sum()


def uniform(id_col: Column, seed: str) -> Column:
    """In [0, 1), from 52 bits of an md5."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / float(1 << 52)


def tokens(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]++")), F.lit(0)).cast("long")


def scale_for(tokens_: np.ndarray, factor: np.ndarray, budget: float) -> float:
    """The greatest scale at which sum(tokens x min(1, scale x factor)) is at most budget."""
    live = (factor > 0) & (tokens_ > 0)
    t, f = tokens_[live], factor[live]
    if not len(t) or t.sum() <= budget:
        return float("inf") if len(t) else 0.0
    order = np.argsort(-f, kind="stable")
    t, f = t[order], f[order]
    full, rest = np.concatenate([[0], np.cumsum(t)]), np.concatenate([np.cumsum((t * f)[::-1])[::-1], [0]])
    for i in range(len(t)):  # the i cells of greatest factor are taken whole
        scale = (budget - full[i]) / rest[i]
        if scale * f[i] <= 1:
            return float(scale)
    return float("inf")


def calibrate(rows: DataFrame, targets: dict[str, dict[str, float] | float], budget: float, most_cells: int = 100_000) -> list[tuple]:
    """[(value per dimension, tokens, target share, probability, mix_weight, margin_miss)] of the cells of rows (DIMENSIONS, n_tokens)."""
    cells = rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").cast("double").alias("tokens")).limit(most_cells + 1).collect()
    if len(cells) > most_cells:
        raise ValueError(f"over {most_cells} cells")
    cells = sorted(cells, key=lambda r: tuple(r)[:3])
    if not cells:
        return []
    count = np.array([r["tokens"] for r in cells])
    if not count.sum():
        return [(*tuple(r)[:3], 0.0, 0.0, 1.0, 1.0, 0.0) for r in cells]
    places, wanted = [], []
    for d in DIMENSIONS:
        values = sorted({r[d] for r in cells})
        place = np.array([values.index(r[d]) for r in cells])
        has = np.bincount(place, weights=count, minlength=len(values)) > 0
        goal = targets.get(d) or {}
        own = np.bincount(place, weights=count, minlength=len(values)) / count.sum()
        if not isinstance(goal, dict):
            goal = {v: x**goal if x else 0.0 for v, x in zip(values, own.tolist(), strict=True)}
        named = np.array([v in goal for v in values], bool)
        target = np.array([goal.get(v, 0.0) for v in values]) * has
        left = 1.0 - own[~named].sum()  # values without a target keep their own share
        target = np.where(named, target * (left / target.sum() if target.sum() else 0.0), own)
        places.append(place)
        wanted.append(target / target.sum() if target.sum() else has / has.sum())
    share = rake(count, places, wanted)
    miss = max(float(np.abs(np.bincount(place, weights=share, minlength=len(target)) - target).max()) for place, target in zip(places, wanted, strict=True))
    factor = np.divide(share, count / count.sum(), out=np.zeros(len(count)), where=count > 0)
    scale = scale_for(count, factor, budget * count.sum())
    chance = np.where(count > 0, np.minimum(1.0, np.where(factor > 0, scale * factor if np.isfinite(scale) else 1.0, 0.0)), 1.0)
    got = count * chance
    got = got / got.sum() if got.sum() else got
    raw = np.divide(share, got, out=np.ones(len(count)), where=got > 0)
    return [(*tuple(r)[:3], *map(float, x), miss) for r, *x in zip(cells, count, share, chance, raw, strict=True)]


def mix(docs: DataFrame, topic: Column, targets: dict[str, dict[str, float] | float], budget: float = 0.5, seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """(row, n_tokens, topic, source, lang, chance, mix_weight, ...) of the sampled documents; `row` holds all their columns."""
    spark = docs.sparkSession
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
    full = docs.select(F.struct("*").alias("row"), tokens(F.col(text_col)).alias("n_tokens"), F.coalesce(topic, F.lit(MISSING)).alias("topic"), name(source_col).alias("source"), name(lang_col).alias("lang"), uniform(F.col(id_col), seed).alias("u"))
    cells = calibrate(full.select(*DIMENSIONS, "n_tokens"), targets, budget)
    table = spark.createDataFrame(cells, "source string, lang string, topic string, cell_tokens double, share double, chance double, mix_weight double, margin_miss double")
    return full.join(F.broadcast(table), list(DIMENSIONS)).where("u < chance")


def columns_of(mixed: DataFrame, docs: DataFrame) -> list[Column]:
    """The documents' own columns in the result of mix()."""
    return [F.col("row").getField(c).alias(c) for c in docs.columns]


def topic_of(text: Column) -> Column:
    """A rule-based topic of a document by what it holds: licence, contact, table, shouting, else prose by its length."""
    n = F.length(text)
    return (F.when(text.isNull() | (n == 0), "empty").when(text.rlike("(?i)licen[cs]e"), "licence").when((F.contains(text, F.lit("@")) & text.rlike("[A-Za-z0-9._]@[A-Za-z0-9]")) | (F.contains(text, F.lit("-")) & text.rlike("[0-9]{3}-[0-9]{4}")), "contact")
            .when(F.contains(text, F.lit(" | ")), "table").when(n < 800, "short").when(n < 3000, "medium").otherwise("long"))
