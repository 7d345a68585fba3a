"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and each masked turn's span is cut out of
the token starts by binary search.  The template is, per turn,

    <|im_start|>role<|im_sep|>text<|im_end|>

whose three marks are special tokens, so a token never crosses the border of a text.  Inside roles and texts every `<`,
any number of backslashes, `|` gets one backslash more; no mark can then occur in them, and taking one away restores them.

Rows come sorted by (conv_id, turn, role, text) and stream through the tasks, one conversation at a time; a conversation is
held whole, as it is encoded whole.  Null text or role: empty.  A null conv_id is a conversation of its own, null
turns come first, repeated rows stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and where each turn's escaped text lies in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escaped(role)}{SEP}", escaped(text)
        parts += [head, body, END]
        spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parsed(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out = []
    for turn in formatted.split(START)[1:]:
        head, _, body = turn.partition(SEP)
        out.append((unescaped(head), unescaped(body.removesuffix(END))))
    return out


def tokenizer(vocabulary: str):  # noqa: ANN201
    """From the text of a tokenizer file, with the template's marks as special tokens."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_str(vocabulary)
    out.add_special_tokens([START, SEP, END])
    return out


def format_chats(rows: DataFrame, tokenizer_path: str, loss_roles: tuple[str, ...] = ("assistant",), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, token_ids, token_starts, token_ends, loss_starts, loss_ends): per conversation its text, its
    tokens with their character offsets, and the token ranges [start, end) that the loss counts, one per masked turn."""
    spark = rows.sparkSession
    kind = rows.schema[conv_col].dataType.simpleString()
    with open(tokenizer_path, encoding="utf-8") as file:  # on the driver; the tasks get the text
        vocabulary = spark.sparkContext.broadcast(file.read())
    turns = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = turns.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(vocabulary.value)
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            texts, spans = zip(*(render(turns) for _, turns in done), strict=True)
            columns: list[list] = [[name for name, _ in done], list(texts), [], [], [], [], []]
            for (_, turns), places, code in zip(done, spans, encoder.encode_batch(list(texts), add_special_tokens=False), strict=True):
                offsets = np.fromiter(chain.from_iterable(code.offsets), np.int32, 2 * len(code)).reshape(-1, 2)
                masked = np.array([place for (role, _), place in zip(turns, places, strict=True) if role in loss_roles], np.int32).reshape(-1, 2)
                begin = np.searchsorted(offsets[:, 0], masked[:, 0], "left")
                end = np.searchsorted(offsets[:, 0], masked[:, 1], "left")
                for column, value in zip(columns[2:], (code.ids, offsets[:, 0], offsets[:, 1], begin, end), strict=True):
                    column.append(value)
            ints = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), pa.array(columns[1], pa.string()), *(pa.array(c, ints) for c in columns[2:])], names=["conv_id", "formatted", "token_ids", "token_starts", "token_ends", "loss_starts", "loss_ends"])

        now, size, id_type, fresh = [], 0, None, True
        name = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if not fresh and conv != name:
                    done.append((name, now))
                    now = []
                    if size > 1 << 20:
                        yield flush()
                        done, size = [], 0
                name, fresh = conv, False
                now.append((role, text))
                size += len(text)
        if not fresh:
            done.append((name, now))
            yield flush()

    return dealt.mapInArrow(run, f"conv_id {kind}, formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, loss_starts array<int>, loss_ends array<int>")
