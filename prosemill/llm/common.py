"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.stage import drop_staged as drop_stored  # noqa: F401
from ..plans.stage import staged as stored  # noqa: F401

#: ASCII lower-casing as a bytes.translate table; other bytes stay.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: ASCII lower-casing, and every ASCII byte that is neither letter nor digit becomes a space.
ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary") if isinstance(id_col, str) else id_col.cast("string").cast("binary")) % modulus


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], text_at: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece has about `limit` bytes of text at most, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
        begin = size = 0
        for i, n in enumerate(lengths.tolist()):
            if size and size + n > limit:
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n
        yield batch.slice(begin)


def whole_keys(batches: Iterable[pa.RecordBatch], columns: int) -> Iterator[list[np.ndarray]]:
    """The first `columns` columns of batches that come sorted by the first, as arrays that hold every row of their keys;
    what is held at a time is one batch and the key that is open.  Binary columns of 8 k bytes become (rows, k) words."""

    def plain(column: pa.Array) -> np.ndarray:
        if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
            return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)
        return column.to_numpy(zero_copy_only=False)

    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([plain(batch.column(i)) for i in range(columns)])
        if held[-1][0][-1] == held[0][0][0]:  # still the key that was open
            continue
        whole = [np.concatenate(x) for x in zip(*held, strict=True)]
        cut = int(np.searchsorted(whole[0], whole[0][-1]))
        yield [x[:cut] for x in whole]
        held = [[x[cut:] for x in whole]]  # the last key may go on in the next batch
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def sampled_ids(rows: DataFrame, id_col: str, group_col: str, per_group: int, known: dict) -> DataFrame:
    """Per group about the `per_group` ids of least md5, which doesn't depend on partitions.  `known` has the groups' row
    numbers: only ids whose md5, as a share of the whole range, is below 4 x per_group / number are ranked, so the
    ranking sees a bounded number of rows of each group, however many it has."""
    from pyspark.sql import Window

    digest = F.md5(F.col(id_col).cast("string").cast("binary"))
    share = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / float(1 << 52)
    most = F.create_map(*(x for group, n in known.items() for x in (F.lit(group), F.lit(4.0 * per_group / n)))) if known else F.create_map(F.lit(""), F.lit(1.0))
    order = Window.partitionBy(group_col).orderBy("_key", id_col)
    near = rows.select(group_col, id_col, digest.alias("_key"), share.alias("_share")).where(F.col(id_col).isNotNull()).where(F.col("_share") < F.try_element_at(most, F.col(group_col)))
    return near.select(group_col, id_col, "_key").distinct().withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_group).drop("_key")
