"""Scalar functions over columns; null in, null out unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.trim(text, F.lit(P.SPACES))


def word_count(text: Column) -> Column:
    """Runs of anything but Unicode white space."""
    return F.regexp_count(F.translate(text, P.SPACES, " " * len(P.SPACES)), F.lit("[^ ]++"))


def link_targets(raw: Column) -> Column:
    """Array of the targets in [[target#fragment|label]]; links without a target or with a colon in it aren't there."""
    return F.regexp_extract_all(raw, F.lit(P.LINK_TARGET), F.lit(1))


def content_links(raw: Column) -> Column:
    """Number of links to articles: file, category and other namespace links don't count."""
    return F.regexp_count(raw, F.lit(P.CONTENT_LINK))


def norm_title(title: Column) -> Column:
    """Underscores to spaces, white space collapsed and trimmed, first character upper case."""
    flat = F.regexp_replace(strip(F.translate(title, "_", " ")), f"{P.S}++", " ")
    return F.concat(F.upper(F.substring(flat, 1, 1)), flat.substr(F.lit(2), F.length(flat)))


def fnv1a32(text: Column) -> Column:
    """FNV-1a over the UTF-8 bytes, as bigint; the offset basis for the empty string."""
    data = text.cast("binary")
    at = F.filter(F.sequence(F.lit(0), F.octet_length(data)), lambda i: i > 0)
    byte = lambda i: F.conv(F.hex(data.substr(i, F.lit(1))), 16, 10).cast("long")
    step = lambda h, i: (h.bitwiseXOR(byte(i)) * 16777619).bitwiseAND(F.lit(4294967295))
    return F.aggregate(at, F.lit(2166136261).cast("long"), step)


def hex8(h: Column) -> Column:
    return F.lpad(F.lower(F.hex(h)), 8, "0")


def lead_sample(text: Column, chars: int) -> Column:
    return F.translate(F.substring(text, 1, chars), "\n", " ")


def tokens(text: Column) -> Column:
    """Lower-case words that begin with a letter, 3 to 28 characters, not all digits (superscripts included)."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{Nl}\p{No}](?:[\p{L}\p{N}_-]*[\p{L}\p{N}_])?"), F.lit(0))
    return F.filter(found, lambda w: F.length(w).between(3, 28) & ~w.rlike(r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨]+$"))


def deletes(words: Column) -> Column:
    """All words of an array with one character left out."""
    one = lambda w: F.transform(F.filter(F.sequence(F.lit(0), F.length(w)), lambda i: i > 0), lambda i: F.concat(w.substr(F.lit(1), i - 1), w.substr(i + 1, F.length(w))))
    return F.array_distinct(F.flatten(F.transform(words, one)))


def trigrams(text: Column) -> Column:
    """Lower-case substrings of three characters, repeats included."""
    low = F.lower(text)
    return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(F.lit(0), F.length(low) - 2)), lambda i: i > 0), lambda i: low.substr(i, F.lit(3)))
