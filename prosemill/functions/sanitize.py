"""Wikitext to prose: a fixed sequence of replacements, entity decoding, appendix removal, white space."""

from __future__ import annotations

import html
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import patterns as P
from .text import strip


@F.pandas_udf(StringType())
def _decoded(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def stable(text: str | None) -> str | None:
        for _ in range(5):
            if text is None or (after := html.unescape(text)) == text:
                break
            text = after
        return text

    for series in texts:
        yield series.map(stable)


def decode_entities(text: Column) -> Column:
    """Repeated until stable, five times at most; only texts with an ampersand leave the JVM."""
    return F.coalesce(_decoded(F.when(F.contains(text, F.lit("&")), text)), text)


def step(text: Column, *names: str) -> Column:
    """The named steps of the sanitizer, in their order."""
    chosen = [x for x in (*P.BEFORE_ENTITIES, *P.STEPS) if x[0] in names]
    return reduce(lambda t, x: F.regexp_replace(t, x[1], x[2]), chosen, text)


def flat(text: Column, spaces: str = "") -> Column:
    """Every kind of line end as a newline, the given characters as spaces."""
    return F.translate(F.replace(text, F.lit("\r\n"), F.lit("\n")), P.LINE_ENDS + spaces, "\n" * len(P.LINE_ENDS) + " " * len(spaces))


def _without_appendices(text: Column) -> Column:
    inner = P.HEADING.removeprefix("^").removesuffix("$")
    sections = F.split(text, rf"(?d)\n(?=(?:{inner})(?:\n|\z))")
    first_line = lambda s: F.substring_index(s, "\n", 1)
    level = lambda s: F.length(F.regexp_extract(first_line(s), P.HEADING, 1))
    named = lambda s: F.lower(F.regexp_extract(first_line(s), P.HEADING, 2)).isin(*P.APPENDICES)

    def fold(state: Column, s: Column) -> Column:
        still = (state["skip"] > 0) & ((level(s) == 0) | (level(s) > state["skip"]))
        starts = ~still & (level(s) > 0) & named(s)
        skip = F.when(still, state["skip"]).when(starts, level(s)).otherwise(0)
        return F.struct(skip.cast("int").alias("skip"), F.when(skip > 0, state["kept"]).otherwise(F.concat(state["kept"], F.array(s))).alias("kept"))

    empty = F.struct(F.lit(0).alias("skip"), F.array().cast("array<string>").alias("kept"))
    return F.aggregate(sections, empty, fold, lambda state: F.array_join(state["kept"], "\n"))


def _tidied(text: Column) -> Column:
    lines = F.array_join(F.transform(F.split(text, "\n"), strip), "\n")
    return strip(F.regexp_replace(F.regexp_replace(lines, r"\n{2,}+", "\n\n"), r"[ \t]{2,}+", " "))


def strip_appendix(text: Column) -> Column:
    """Without the sections of fixed names and their sub-sections; line ends become newlines.

    The text is cut before each heading, so the fold runs over sections, not lines: a section is skipped from an
    appendix heading until a heading of its level or a higher one."""
    return _without_appendices(flat(text))


def tidy(text: Column) -> Column:
    """No-break spaces to spaces, lines stripped, runs of spaces and tabs to one, blank lines to one empty line."""
    return _tidied(flat(text, "\xa0"))


def sanitize(raw: Column) -> Column:
    markup = step(decode_entities(step(raw, "comments")), *(x[0] for x in P.STEPS))
    return _tidied(_without_appendices(flat(markup, "\xa0")))
