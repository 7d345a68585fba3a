"""Benchmark decontamination with an FM-index per training shard.

A shard is what a task holds of the training texts, up to `shard_bytes`.  Its words become symbols of the
benchmark's vocabulary; a word that the benchmark lacks, or the end of a text, is a separator.  Runs of symbols
shorter than the shortest phrase can't hold one, so only longer runs are indexed: suffix array by prefix doubling,
Burrows-Wheeler transform, wavelet matrix with popcount ranks, and the suffix positions of every eighth place and of
run starts, found by their rank among the marked rows.  All phrases of a block search backwards at once; occurrences
are located by walking to a marked row, and their word ranges merge to removal spans.

Phrases are the windows of `window` consecutive words of an item; an item with fewer words, but not none, is one
phrase.  Items are normalized on the executors, long ones in pieces that overlap by a window less one word, which have
the same windows.  One scan of the texts takes `pass_blocks` x `block_bytes` of the benchmark: each shard is indexed once
and searched for one block of phrases after the other.  Only a benchmark beyond that takes further passes over the texts,
each written to the shared folder, which add up each row's spans; so what is held or broadcast at once has a fixed bound
whatever the benchmark's size.  No shuffle: the output has one row per row.

Null or wordless text: no words, no hit.  Null or wordless items are never found.  A null item id counts as ''.
Items that repeat an id count once.  An empty benchmark gives rows without hits.  Repeated rows each give a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, as_bytes, slices, stored

WINDOW = 10
SAMPLE = 8
SHARD_BYTES = 32 << 20
BLOCK_BYTES = 2 << 20
PASS_BLOCKS = 32
#: Phrases that are searched at once; words of a piece of a long item.
PHRASES, PIECE = 1 << 17, 1 << 16
FOUND = "id {}, n_words bigint, n_hit bigint, span_starts array<bigint>, span_ends array<bigint>, items array<string>"
#: Stands between texts; no word equals it, as words have neither ASCII punctuation nor white space.
GAP = b" - "


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(ALNUM).split()


class Phrases:
    """Windows of items over a vocabulary of symbols from 1: the items' symbols one after another, and in blocks of PHRASES
    where each distinct window starts, its length and the items that have it."""

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int = WINDOW):
        self.window, self.vocabulary, place = window, {}, {}
        symbols, starts, lengths, owners, at = [], [], [], [], 0
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            symbols.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int32))
            n = max(1, len(words) - window + 1)
            starts.append(np.arange(at, at + n))
            lengths.append(np.full(n, min(window, len(words)), np.int32))
            owners.append(np.full(n, place.setdefault(item, len(place)), np.int64))
            at += len(words)
        self.items = np.array(list(place), object)
        self.symbols = np.concatenate([np.zeros(0, np.int32), *symbols])
        starts, lengths, owners = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (starts, lengths, owners))
        self.shortest = int(lengths.min(initial=window))
        self.blocks = []
        for i in range(0, len(starts), PHRASES):
            start, length, owner = (x[i : i + PHRASES] for x in (starts, lengths, owners))
            _, first, phrase = np.unique(np.ascontiguousarray(self.table(start, length)).view(f"V{4 * window}").ravel(), return_index=True, return_inverse=True)
            pairs = np.unique(phrase * (len(place) + 1) + owner)
            self.blocks.append((start[first], length[first], np.searchsorted(pairs // (len(place) + 1), np.arange(len(first) + 1)), pairs % (len(place) + 1)))

    def table(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A row of symbols per window, aligned at the last word, zeros before the first."""
        back = np.arange(self.window)[::-1]
        at = (starts + lengths)[:, None] - 1 - back
        return np.where(back < lengths[:, None], self.symbols[np.maximum(at, 0)], 0)


class FMIndex:
    """Over runs of symbols from 1; `runs` is their concatenation with a zero after each."""

    def __init__(self, runs: np.ndarray, symbols: int):
        n = self.n = len(runs)
        ends = runs == 0
        rank = np.where(ends, np.cumsum(ends) - 1, runs + int(ends.sum()))  # separators differ and come first
        width = 1
        while True:
            after = np.zeros(n, np.int64)
            after[: n - width] = rank[width:] + 1
            key = rank * (int(rank.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            steps = np.r_[False, key[order][1:] != key[order][:-1]]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(steps)
            width *= 2
            if width >= n or rank[order[-1]] == n - 1:
                break
        bwt = runs[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(runs, minlength=symbols + 1))])
        self.levels = max(1, symbols.bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        row = bwt
        start = np.zeros(symbols + 1, np.int64)
        every = np.arange(symbols + 1)
        for level in range(self.levels):
            bit = (row >> (self.levels - 1 - level)) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            words = np.zeros(n // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            self.bits.append(words)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(int(n - bit.sum()))
            start = self._down(level, (every >> (self.levels - 1 - level)) & 1, start)
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        self.start = start
        marked = ((np.arange(n) % SAMPLE == 0) | np.r_[True, ends[:-1]])[order]
        self.marks = np.zeros(n // 64 + 1, np.uint64)
        packed = np.packbits(marked, bitorder="little")
        self.marks.view(np.uint8)[: len(packed)] = packed
        self.marks_before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)])
        self.places = order[marked]  # of the marked rows alone, in the order of the rows

    def _down(self, level: int, bit: np.ndarray, i: np.ndarray) -> np.ndarray:
        ones = self.ones[level][i >> 6] + np.bitwise_count(self.bits[level][i >> 6] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))
        return np.where(bit == 1, self.zeros[level] + ones, i - ones)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            i = self._down(level, (symbol >> (self.levels - 1 - level)) & 1, i)
        return i - self.start[symbol]

    def symbol(self, row: np.ndarray) -> np.ndarray:
        out = np.zeros(len(row), np.int64)
        for level in range(self.levels):
            bit = ((self.bits[level][row >> 6] >> (row & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            out = out * 2 + bit
            row = self._down(level, bit, row)
        return out

    def search(self, table: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each phrase, all phrases at once from the last word on."""
        low, high = np.zeros(len(table), np.int64), np.full(len(table), self.n, np.int64)
        for step in range(table.shape[1]):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            c = table[live, -1 - step]
            low[live] = self.first[c] + self.rank(c, low[live])
            high[live] = self.first[c] + self.rank(c, high[live])
        return low, high

    def marked(self, row: np.ndarray) -> np.ndarray:
        return (self.marks[row >> 6] >> (row & 63).astype(np.uint64)) & np.uint64(1) == 1

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the rows' suffixes: steps back to a marked row, and the sampled place of that."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self.marked(at))
        while len(todo):
            c = self.symbol(at[todo])
            at[todo] = self.first[c] + self.rank(c, at[todo])
            steps[todo] += 1
            todo = todo[~self.marked(at[todo])]
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.places[self.marks_before[at >> 6] + np.bitwise_count(self.marks[at >> 6] & below)] + steps


def hits(symbols: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Of a shard's symbols: a mask of words inside occurrences; and for each block of phrases, of its occurrences, the
    phrase and the first word."""
    mask = np.zeros(len(symbols), bool)
    if not len(phrases.blocks) or not len(symbols):
        return mask, []
    inside = np.r_[False, symbols > 0, False]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = turns[::2], turns[1::2]
    keep = end - begin >= phrases.shortest
    begin, size = begin[keep], (end - begin)[keep]
    if not len(begin):
        return mask, []
    slot = np.concatenate([[0], np.cumsum(size + 1)])
    place = np.arange(slot[-1]) - np.repeat(slot[:-1] - begin, size + 1)  # of each indexed symbol in the shard
    runs = np.where(place < np.repeat(begin + size, size + 1), symbols[np.minimum(place, len(symbols) - 1)], 0)
    index = FMIndex(runs, len(phrases.vocabulary))
    edge, found = np.zeros(len(symbols) + 1, np.int64), []
    for start, length, _, _ in phrases.blocks:
        low, high = index.search(phrases.table(start, length), length)
        count = np.maximum(0, high - low)
        phrase = np.repeat(np.arange(len(count)), count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[phrase]
        word = place[index.locate(rows)]
        np.add.at(edge, word, 1)
        np.add.at(edge, word + length[phrase], -1)
        found.append((phrase, word))
    return np.cumsum(edge[:-1]) > 0, found


def scan_shard(texts: list[np.ndarray], phrases: Phrases) -> list[tuple[int, int, list[int], list[int], list[str]]]:
    """(n_words, n_hit, span starts, span ends, items) of each text; `texts` are its words' symbols."""
    sizes = np.array([len(x) for x in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])  # a separator after each text
    symbols = np.zeros(first[-1], np.int64)
    for i, x in zip(first[:-1].tolist(), texts, strict=True):
        symbols[i : i + len(x)] = x
    mask, found = hits(symbols, phrases)
    out = [(int(n), 0, [], [], []) for n in sizes]
    turn = np.diff(np.r_[False, mask, False].astype(np.int8))
    begin, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    text_of, item_of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]  # each text's items, once a block
    for (_, _, edge, owners), (phrase, word) in zip(phrases.blocks, found, strict=False):
        met = np.unique((np.searchsorted(first, word, "right") - 1) * (len(edge) + 1) + phrase)
        of, phrase = met // (len(edge) + 1), met % (len(edge) + 1)
        many = edge[phrase + 1] - edge[phrase]
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(edge[phrase], many)
        pairs = np.unique(np.repeat(of, many) * (len(phrases.items) + 1) + owners[at])
        text_of.append(pairs // (len(phrases.items) + 1))
        item_of.append(pairs % (len(phrases.items) + 1))
    text_of, item_of = np.concatenate(text_of), np.concatenate(item_of)
    order = np.argsort(text_of, kind="stable")
    text_of, item_of = text_of[order], item_of[order]
    owner = np.searchsorted(first, begin, "right") - 1
    for i in np.unique(owner).tolist():
        mine = slice(*np.searchsorted(owner, [i, i + 1]))
        a, b = begin[mine] - first[i], end[mine] - first[i]
        items = {phrases.items[x] for x in item_of[slice(*np.searchsorted(text_of, [i, i + 1]))]}
        out[i] = (int(sizes[i]), int((b - a).sum()), a.tolist(), b.tolist(), sorted(items))
    return out


def pieces_of(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(i, t): the items' words, normalized, those of long items in overlapping pieces; no item without a word."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).alias("t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            ids, texts = [], []
            for item, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                words = words_of(text)
                for at in range(0, max(min(1, len(words)), len(words) - window + 1), PIECE):
                    ids.append(item)
                    texts.append(b" ".join(words[at : at + PIECE + window - 1]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["i", "t"])

    return rows.mapInArrow(run, "i string, t string")


def passes_of(benchmark: DataFrame, id_col: str, text_col: str, window: int, pass_bytes: int) -> Iterator[Phrases]:
    """The benchmark's phrases, of about pass_bytes of text at a time; rows arrive one partition at a time."""
    part: list[tuple[str, bytes]] = []
    size = 0
    for r in pieces_of(benchmark, id_col, text_col, window).toLocalIterator():
        text = r["t"].encode()
        if size and size + len(text) > pass_bytes:
            yield Phrases(part, window)
            part, size = [], 0
        part.append((r["i"], text))
        size += len(text)
    yield Phrases(part, window)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES, pass_blocks: int = PASS_BLOCKS,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, span_starts, span_ends, items): per row the merged word ranges [start, end) of benchmark
    phrases and the ids, as sorted strings, of the items they are of."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = FOUND.format(docs.schema[id_col].dataType.simpleString())
    passes = passes_of(benchmark, item_col, item_text_col, window, block_bytes * pass_blocks)
    phrases = next(passes)
    for following in passes:
        rows = stored(_scan(rows, 1, phrases, shard_bytes, found + ", text string"), "decontam-pass").select("id", "text", "n_words", "n_hit", "span_starts", "span_ends", "items")
        phrases = following
    return _scan(rows, 1, phrases, shard_bytes, found)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES, pass_blocks: int = PASS_BLOCKS, text_col: str = "text") -> DataFrame:
    """The rows of docs, with their columns, that hold no benchmark phrase; see decontaminate()."""
    at = docs.columns.index(text_col)
    passes = passes_of(benchmark, "item_id", "text", window, block_bytes * pass_blocks)
    phrases = next(passes)
    for following in passes:
        docs = stored(_scan(docs, at, phrases, shard_bytes, None), "decontam-pass")
        phrases = following
    return _scan(docs, at, phrases, shard_bytes, None)


def _scan(rows: DataFrame, at: int, phrases: Phrases, shard_bytes: int, found: str | None) -> DataFrame:
    """One pass.  With a schema `found`: each row's id, what this pass and the passes before found, and the text if the
    schema has it; without: the rows that hold no phrase.  The text is the column `at`, the results so far follow it."""
    shared = rows.sparkSession.sparkContext.broadcast(phrases)
    later = found is not None and len(rows.columns) > 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            results = scan_shard(shard, shared.value)
            if later:
                results = [_merged(x, y) for x, y in zip(before, results, strict=True)]
            begin = 0
            for batch in held:
                part = results[begin : begin + batch.num_rows]
                begin += batch.num_rows
                if found is None:
                    yield batch.filter(pa.array([x[1] == 0 for x in part], pa.bool_()))
                    continue
                columns = zip(zip(*part, strict=True), (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())), strict=True)
                names = ["id", "n_words", "n_hit", "span_starts", "span_ends", "items", "text"]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in columns), *batch.columns[1:]], names=names[: 5 + batch.num_columns])

        held, shard, before, size = [], [], [], 0
        (gap,) = GAP.split()
        vocabulary = shared.value.vocabulary | {gap: -1}
        for batch in slices(batches, at):
            texts = as_bytes(batch.column(at))
            joined = GAP.join((t or b"").translate(ALNUM) for t in texts).split()
            symbols = np.fromiter(map(vocabulary.get, joined, repeat(0)), np.int32, len(joined))
            shard += [x[1:] if i else x for i, x in enumerate(np.split(symbols, np.flatnonzero(symbols == -1)))]
            if later:
                before += zip(*(c.to_pylist() for c in batch.columns[2:7]), strict=True)
            held.append(batch if found is None else batch.select([0, 1] if "text" in found else [0]))
            size += sum(len(t or b"") for t in texts)
            if size >= shard_bytes:
                yield from flush()
                held, shard, before, size = [], [], [], 0
        if shard:
            yield from flush()

    return rows.mapInArrow(run, rows.schema if found is None else found)


def _merged(x: tuple, y: tuple) -> tuple:
    """Results of two passes for one text."""
    starts, ends = [], []
    for a, b in sorted([*zip(x[2], x[3], strict=True), *zip(y[2], y[3], strict=True)]):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return x[0], sum(ends) - sum(starts), starts, ends, sorted({*x[4], *y[4]})


def without_spans(text: str, starts: list[int], ends: list[int]) -> str:
    """The text without the characters of the words in [start, end) of each span, from the first to the last of them."""
    data = text.encode()
    places = [m.span() for m in re.finditer(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", data)]
    out, at = [], 0
    for a, b in zip(starts, ends, strict=True):
        out.append(data[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, data[at:]]).decode()
