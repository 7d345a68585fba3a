"""Hidden Markov language model: Baum-Welch over all training texts, exact likelihood of every text.

Tokens are words (runs of anything but ASCII white space, A-Z lower-cased) and one end per text.  The latent chain
emits word classes, a bounded number of them: the end, each of the `own` words that occur most in all training texts,
and `hashed` classes of word endings for the rest.  A class emits its words by their counts in the whole training corpus, add-0.1 smoothed, with
one slot for words not seen; so the vocabulary may grow without bound while the chain's tables do not:

    P(text) = [sum over state paths of  start * prod A * B(class)] * prod P(word | class)

Passes: (0) words are counted, in each task by a table of bounded size, and over all tasks by a shuffle, for the own
words; (1) texts become blocks of word numbers plus, per block and bucket of word hashes, the block's words with
their training counts; (2) each bucket sums its words' counts over all blocks and answers each block, and gives the
classes' totals; (3) states start as a mixture of unigrams, drawn around the classes' shares and fitted by EM; (4)
Baum-Welch re-estimates them until a round raises the log likelihood by less than `tolerance` a token, `iterations`
times at most; (5) each block meets its answers and is scored by the scaled forward recursion.  Every round of (3) and
(4) sums expected counts over all training texts, whole, one set of partial sums per partition.  Nothing of the
vocabulary is broadcast or collected.  Words are keyed by their 64-bit XXH64; there are as many buckets as the bytes of the
texts need, so that a bucket's size doesn't grow with the corpus.

Null or empty text: the end token alone.  A null id is held out.  Repeated rows are scored, and learned, as often
as they occur.  Without training texts every token is unseen and the chain is uniform.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, as_bytes, slices, stored

#: Tokens in a piece of a text that is worked on at once with the like pieces of others.
WIDTH = 128
END = 0
#: Distinct words that a task counts before it passes its counts on.
MOST_COUNTED = 1 << 18


@dataclass(frozen=True)
class Chain:
    start: np.ndarray  # of the silent state before the first token
    step: np.ndarray  # (K, K)
    emit: np.ndarray  # (classes, K); columns sum to 1


class Pieces:
    """Texts of given token numbers, concatenated, cut into pieces of WIDTH tokens, longest first."""

    def __init__(self, classes: np.ndarray, sizes: np.ndarray):
        number = -(-sizes // WIDTH)
        text = np.repeat(np.arange(len(sizes)), number)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
        length = np.minimum(WIDTH, sizes[text] - nth * WIDTH)
        order = np.argsort(-length, kind="stable")
        self.texts, self.text, self.nth, self.length = len(sizes), text[order], nth[order], length[order]
        begin = (np.cumsum(sizes) - sizes)[self.text] + self.nth * WIDTH
        self.table = classes[np.minimum(begin[:, None] + np.arange(WIDTH), max(0, len(classes) - 1))] if len(text) else np.zeros((0, WIDTH), classes.dtype)
        self.active = [int(n) for n in np.searchsorted(-self.length, -np.arange(WIDTH), "left")]
        by = np.argsort(self.nth, kind="stable")
        self.turns = np.split(by, np.flatnonzero(np.diff(self.nth[by])) + 1) if len(by) else []


def transfers(chain: Chain, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Per piece the product of its tokens' matrices, scaled, and the log of the scale."""
    states = len(chain.start)
    product = np.tile(np.eye(states), (len(pieces.text), 1, 1))
    logs = np.zeros(len(pieces.text))
    for t, n in enumerate(pieces.active):
        if not n:
            break
        now = (product[:n].reshape(-1, states) @ chain.step).reshape(n, states, states)
        now *= chain.emit[pieces.table[:n, t]][:, None, :]
        product[:n] = now
        if t % 16 == 15:
            top = now.max(axis=(1, 2))
            product[:n] /= top[:, None, None]
            logs[:n] += np.log(top)
    return product, logs


def forward(chain: Chain, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Natural log likelihood of each text, the state distribution before each piece, and the pieces' products."""
    product, logs = transfers(chain, pieces)
    now = np.tile(chain.start, (pieces.texts, 1))
    total, before = np.zeros(pieces.texts), np.empty((len(pieces.text), len(chain.start)))
    for turn in pieces.turns:
        of = pieces.text[turn]
        before[turn] = now[of]
        after = np.einsum("sk,skl->sl", now[of], product[turn])
        mass = after.sum(axis=1)
        total[of] += np.log(mass) + logs[turn]
        now[of] = after / mass[:, None]
    return total, before, product


def expected(chain: Chain, pieces: Pieces) -> np.ndarray:
    """Expected counts (start, steps, emissions), flat, of the texts: the sums that Baum-Welch re-estimates from."""
    return expectation(chain, pieces)[0]


def expectation(chain: Chain, pieces: Pieces) -> tuple[np.ndarray, float]:
    """expected(), and the log likelihood of the texts."""
    states, classes = len(chain.start), len(chain.emit)
    total, before, product = forward(chain, pieces)
    after, end = np.ones((pieces.texts, states)), np.empty_like(before)
    for turn in pieces.turns[::-1]:
        of = pieces.text[turn]
        end[turn] = after[of]
        back = np.einsum("skl,sl->sk", product[turn], after[of])
        after[of] = back / back.sum(axis=1, keepdims=True)
    del product
    first = chain.start * after
    first = (first / first.sum(axis=1, keepdims=True)).sum(axis=0) if pieces.texts else np.zeros(states)
    ahead = np.zeros((WIDTH + 1, len(pieces.text), states))
    ahead[0] = before
    for t, n in enumerate(pieces.active):
        now = (ahead[t, :n] @ chain.step) * chain.emit[pieces.table[:n, t]]
        ahead[t + 1, :n] = now / now.sum(axis=1, keepdims=True)
    steps, emitted, back = np.zeros((states, states)), np.zeros((classes, states)), end
    for t in range(WIDTH - 1, -1, -1):
        n = pieces.active[t]
        if not n:
            continue
        at = ahead[t + 1, :n] * back[:n]
        ahead[t + 1, :n] = at / at.sum(axis=1, keepdims=True)  # from now on the state distribution given the text
        out = chain.emit[pieces.table[:n, t]] * back[:n]
        pre = out @ chain.step.T
        prior = ahead[t, :n]
        steps += (prior / (prior * pre).sum(axis=1, keepdims=True)).T @ out
        back[:n] = pre / pre.sum(axis=1, keepdims=True)
    steps *= chain.step
    for t, n in enumerate(pieces.active):
        for k in range(states):
            emitted[:, k] += np.bincount(pieces.table[:n, t], weights=ahead[t + 1, :n, k], minlength=classes)
    return np.concatenate([first, steps.ravel(), emitted.ravel()]), float(total.sum())


def mixture(weight: np.ndarray, emit: np.ndarray, sequence: np.ndarray, sizes: np.ndarray, at_once: int = 1024) -> tuple[np.ndarray, float]:
    """Expected counts (texts, emissions), flat, of texts that each are of one state, and their log likelihood."""
    classes, states = emit.shape
    logs, texts, emitted, total = np.log(emit), np.zeros(states), np.zeros((classes, states)), 0.0
    edge = np.r_[0, np.cumsum(sizes)]
    for i in range(0, len(sizes), at_once):
        n = min(at_once, len(sizes) - i)
        part = sequence[edge[i] : edge[i + n]].astype(np.int64) + np.repeat(np.arange(n) * classes, sizes[i : i + n])
        bags = np.bincount(part, minlength=n * classes).reshape(n, classes).astype(float)
        score = bags @ logs + np.log(weight)
        top = score.max(axis=1, keepdims=True)
        share = np.exp(score - top)
        mass = share.sum(axis=1, keepdims=True)
        total += float((np.log(mass) + top).sum())
        share /= mass
        texts += share.sum(axis=0)
        emitted += bags.T @ share
    return np.concatenate([texts, emitted.ravel()]), total


def reestimated(sums: np.ndarray, chain: Chain) -> Chain:
    states, classes = len(chain.start), len(chain.emit)
    first, steps, emitted = np.split(sums, [states, states + states * states])
    steps, emitted = steps.reshape(states, states), emitted.reshape(classes, states)
    share = (emitted.sum(axis=1) + 0.5) / (emitted.sum() + 0.5 * classes)  # of the classes, whatever the state
    emitted = emitted + 2 * share[:, None]
    return Chain((first + 0.1) / (first + 0.1).sum(), (steps + 0.1) / (steps + 0.1).sum(axis=1, keepdims=True), emitted / emitted.sum(axis=0))


def ending(word: bytes, own: int, hashed: int) -> int:
    """The class of a word without a class of its own: by its last three bytes before trailing ASCII punctuation."""
    return 1 + own + zlib.crc32(word.rstrip(b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~")[-3:] + word[-1:]) % hashed


def frequent_words(rows: DataFrame, own: int, most: int = MOST_COUNTED) -> list[bytes]:
    """The `own` words that occur most in the rows (id, held, text) that aren't held out; of equal counts the least bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for batch in slices(batches, 0):
            for text in as_bytes(batch.column(0)):
                counts.update((text or b"").translate(LOWER).split())
                if len(counts) >= most:
                    yield flush()
                    counts.clear()
        yield flush()

    counted = rows.where("not held").select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r["word"]) for r in counted.orderBy(F.col("n").desc(), "word").limit(own).collect()]


def _pack(array: np.ndarray, kind: type) -> bytes:
    return np.ascontiguousarray(array, kind).tobytes()


def _blocks(rows: DataFrame, classes, own: int, hashed: int, buckets: int, block_words: int) -> DataFrame:  # noqa: ANN001
    """kind 'texts': a block's texts as word numbers; kind 'words': a block's words of a bucket, by hash."""
    id_kind = rows.schema["id"].dataType.simpleString()
    schema = f"kind string, block bigint, bucket int, ids array<{id_kind}>, held array<boolean>, sizes array<bigint>, words binary, counts binary, classes binary"
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(rows.schema["id"].dataType)
    target = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("bucket", pa.int32()), ("ids", pa.list_(id_type)), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("words", pa.binary()), ("counts", pa.binary()), ("classes", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = classes.value
        block = TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            words = list(number)
            keys = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
            kinds = np.fromiter((known.get(w) or ending(w, own, hashed) for w in words), np.uint16, len(words))
            bucket = (keys % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((keys, bucket))
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            numbers = place[np.concatenate(held_numbers)] if held_numbers else np.zeros(0, np.int64)
            learn = np.repeat(~np.array(held, bool), sizes)
            counts = np.bincount(numbers[learn], minlength=len(words))
            keys, kinds, bucket = keys[order], kinds[order], bucket[order]
            out = [("texts", block, -1, ids, held, sizes, _pack(numbers, np.uint32), None, _pack(kinds, np.uint16))]
            edge = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edge)).tolist():
                at = slice(edge[b], edge[b + 1])
                out.append(("words", block, b, None, None, None, _pack(keys[at], np.uint64), _pack(counts[at], np.uint32), _pack(kinds[at], np.uint16)))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), target, strict=True)], schema=target)

        def fresh() -> None:
            nonlocal number, held_numbers, ids, held, sizes, total
            ticket = count()
            number, held_numbers, ids, held, sizes, total = defaultdict(ticket.__next__), [], [], [], [], 0

        number = held_numbers = ids = held = sizes = total = None
        fresh()
        for batch in slices(batches, 2):
            for name, is_held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2)), strict=True):
                words = (text or b"").translate(LOWER).split()
                held_numbers.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                ids.append(name)
                held.append(is_held)
                sizes.append(len(words))
                total += len(words)
                if total >= block_words:
                    yield flush()
                    block += 1
                    fresh()
        if ids:
            yield flush()

    return rows.mapInArrow(run, schema)


def _answers(words: DataFrame, classes: int, buckets: int) -> DataFrame:
    """Per bucket: for each block its words' counts over all blocks (kind 'block'), and the classes' numbers of
    distinct and of all training words (kind 'totals')."""

    def run(group: pa.Table) -> pa.Table:
        blocks = group.column("block").to_pylist()
        parts = [[np.frombuffer(x, kind) for x in group.column(name).to_pylist()] for name, kind in (("words", np.uint64), ("counts", np.uint32), ("classes", np.uint16))]
        keys, counts, kinds = (np.concatenate(x) for x in parts)
        distinct, first, of = np.unique(keys, return_index=True, return_inverse=True)
        total = np.bincount(of, weights=counts, minlength=len(distinct)).astype(np.int64)  # exact below 2**53
        cuts = np.cumsum([len(x) for x in parts[0]])[:-1]
        replies = [_pack(x, np.int64) for x in np.split(total[of], cuts)]
        kind = kinds[first]
        sums = np.stack([np.bincount(kind[total > 0], minlength=classes), np.bincount(kind, weights=total, minlength=classes).astype(np.int64)])
        bucket = group.column("bucket")[0].as_py()
        return pa.table({"kind": ["block"] * len(blocks) + ["totals"], "block": pa.array([*blocks, -1], pa.int64()), "bucket": pa.array([bucket] * (len(blocks) + 1), pa.int32()), "reply": pa.array([*replies, _pack(sums, np.int64)], pa.binary())})

    return words.select("bucket", "block", "words", "counts", "classes").repartition(buckets, "bucket").groupBy("bucket").applyInArrow(run, "kind string, block bigint, bucket int, reply binary")


def _unpacked(ids: list, sizes: list, words: bytes, classes: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers; class sequence with ends; sizes with ends."""
    numbers, kinds = np.frombuffer(words, np.uint32), np.frombuffer(classes, np.uint16)
    sizes = np.array(sizes, np.int64)
    sequence = np.full(len(numbers) + len(ids), END, np.int32)
    sequence[np.arange(len(numbers)) + np.repeat(np.arange(len(ids)), sizes)] = kinds[numbers]
    return numbers, sequence, sizes + 1


def _summed(texts: DataFrame, model: object, size: int, sums_of: Callable) -> tuple[np.ndarray, float]:
    """Over all training texts of the blocks: the sums of sums_of(model, class sequence, sizes), and the log likelihood.
    A task passes on one row per number; a block is worked on at a time."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros(size + 1), False
        for batch in batches:
            for row in range(batch.num_rows):
                ids, held, sizes, words, classes = (batch.column(c)[row].as_py() for c in range(5))
                _, sequence, sizes = _unpacked(ids, sizes, words, classes)
                learn = ~np.array(held, bool)
                if learn.any():
                    found, likelihood = sums_of(shared.value, sequence[np.repeat(learn, sizes)], sizes[learn])
                    sums[:-1] += found
                    sums[-1] += likelihood
                    seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1, dtype=np.int32)), pa.array(sums)], names=["i", "x"])

    rows = texts.select("ids", "held", "sizes", "words", "classes").mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    sums = np.zeros(size + 1)
    for r in rows:
        sums[r["i"]] = r["x"]
    return sums[:-1], float(sums[-1])


def trained(texts: DataFrame, totals: np.ndarray, states: int, mixture_rounds: int, iterations: int, tolerance: float, seed: int = 7) -> tuple[Chain, list[float]]:
    """The chain after all rounds over the blocks' training texts, and the log likelihood a token before each Baum-Welch
    round.  totals: training tokens by class, more than none."""
    classes, tokens = len(totals), totals.sum()
    share = (totals + 0.5) / (tokens + 0.5 * classes)
    emit = share[:, None] * np.exp(np.random.default_rng(seed).normal(size=(classes, states)))
    weight, emit = np.full(states, 1 / states), emit / emit.sum(axis=0)
    for _ in range(mixture_rounds):
        sums, _ = _summed(texts, (weight, emit), states * (1 + classes), lambda model, sequence, sizes: mixture(*model, sequence, sizes))
        weight = (sums[:states] + 1) / (sums[:states].sum() + states)
        emit = sums[states:].reshape(classes, states) + 2 * share[:, None]
        emit /= emit.sum(axis=0)
    chain, likelihoods = Chain(weight, 0.8 * np.eye(states) + 0.2 * weight, emit), []
    for _ in range(iterations):
        sums, likelihood = _summed(texts, chain, states * (1 + states + classes), lambda model, sequence, sizes: expectation(model, Pieces(sequence, sizes)))
        chain = reestimated(sums, chain)
        likelihoods.append(likelihood / tokens)
        if len(likelihoods) > 1 and likelihoods[-1] - likelihoods[-2] < tolerance:
            break
    return chain, likelihoods


def score(docs: DataFrame, held_out: Column, states: int = 6, own: int = 767, hashed: int = 256, mixture_rounds: int = 6, iterations: int = 4, tolerance: float = 0.002,
          block_words: int = 1 << 19, bucket_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row; scores are log10 probabilities,
    base_score that of the add-0.1 unigram model, score that of the hidden Markov model."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(True)).alias("held"), F.col(text_col).alias("text"))
    classes_n = 1 + own + hashed
    if classes_n > 1 << 16:
        raise ValueError(f"{classes_n} classes; their numbers have 16 bits")
    own_classes = {w: i + 1 for i, w in enumerate(frequent_words(rows, own))}
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), size // bucket_bytes)
    table = stored(_blocks(rows, spark.sparkContext.broadcast(own_classes), own, hashed, buckets, block_words), "hmm-blocks", "kind")
    texts = table.where("kind = 'texts'")
    answers = stored(_answers(table.where("kind = 'words'"), classes_n, buckets), "hmm-answers", "kind")
    kinds = np.zeros((2, classes_n), np.int64)
    for r in answers.where("kind = 'totals'").select("reply").toLocalIterator():
        kinds += np.frombuffer(r["reply"], np.int64).reshape(2, classes_n)
    learned = texts.select(F.explode("held").alias("held")).where("not held").count()
    totals = kinds[1].astype(float)
    totals[END] = learned
    if learned:
        chain, _ = trained(texts, totals, states, mixture_rounds, iterations, tolerance)
    else:
        chain = Chain(np.full(states, 1 / states), np.full((states, states), 1 / states), np.full((classes_n, states), 1 / classes_n))

    ends, n, v = learned, int(kinds[1].sum()) + learned, int(kinds[0].sum()) + (learned > 0)
    below = np.log10(n + 0.1 * (v + 1))
    within = np.where(np.arange(classes_n) <= own, np.nan, np.log10(kinds[1] + 0.1 * (kinds[0] + 1)))  # nan: one word, probability 1
    fit = spark.sparkContext.broadcast((chain, within))
    id_kind = rows.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(id_kind)

    def run(block: pa.Table, reply: pa.Table) -> pa.Table:
        chain, within = fit.value
        out = []
        by = np.argsort(reply.column("bucket").to_numpy(), kind="stable")
        replies = reply.column("reply").to_pylist()
        counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(replies[i], np.int64) for i in by.tolist())])
        for row in range(block.num_rows):
            ids, held, sizes, words, kinds = (block.column(c)[row].as_py() for c in ("ids", "held", "sizes", "words", "classes"))
            numbers, sequence, with_end = _unpacked(ids, sizes, words, kinds)
            word_class = np.frombuffer(kinds, np.uint16).astype(np.int64)
            smooth = np.log10(counts + 0.1)
            inside = np.where(np.isnan(within[word_class]), 0.0, smooth - within[word_class])
            edge = np.r_[0, np.cumsum(sizes)].astype(np.int64)
            spread = lambda x: np.array([x[numbers[a:b]].sum() for a, b in zip(edge[:-1], edge[1:], strict=True)])
            base = spread(smooth) + np.log10(ends + 0.1) - with_end * below
            known = spread((counts > 0).astype(np.int64)) + int(ends > 0)
            log, _, _ = forward(chain, Pieces(sequence, with_end))
            out.append(pa.table({"id": pa.array(ids, id_type), "held_out": pa.array(held, pa.bool_()), "n_tokens": with_end, "n_known": known.astype(np.int64), "train_tokens": np.full(len(ids), n, np.int64), "base_score": base.astype(float), "score": log / np.log(10) + spread(inside)}))
        return pa.concat_tables(out) if out else empty

    empty = pa.table({k: pa.array([], t) for k, t in (("id", id_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()))})
    schema = f"id {id_kind.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return texts.select("block", "ids", "held", "sizes", "words", "classes").groupBy("block").cogroup(answers.where("kind = 'block'").select("block", "bucket", "reply").groupBy("block")).applyInArrow(run, schema)
