"""Build options; the defaults are fixed values of the corpus rules."""

from __future__ import annotations

from dataclasses import dataclass

SCHEMA_VERSION = 8


@dataclass(frozen=True)
class Options:
    min_words: int = 50
    max_link_ratio: float = 0.5
    rescue_words: int = 2000
    taxon_words: int = 150
    short_words: int = 300
    min_indegree: int = 4
    sample_chars: int = 300
    chunk_size: int = 200
    level: int = 19
    window_log: int = 23
    title_weight: int = 5
    sample_weight: int = 1
    min_freq: int = 2
    max_words: int = 250_000
    tier1_words: int = 80_000
    redirect_hops: int = 16

    def __post_init__(self) -> None:
        if not 1 <= self.level <= 19:
            raise ValueError("level must be within 1..19")
        if self.chunk_size < 1:
            raise ValueError("chunk_size must be at least 1")
        if self.tier1_words < 1 or self.max_words < 1:
            raise ValueError("vocabulary sizes must be at least 1")


DEFAULT = Options()
