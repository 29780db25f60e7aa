"""Documents in blocks, and exchanges of packed arrays between blocks and hash buckets.

A block is the work of one map step on a few megabytes of text: it sends each of its distinct values
once to the bucket that the value's hash picks, and gets one answer for each back. Rows are few and
wide, so a shuffle carries close to the bytes of the values alone. Blocks are written once, bucketed
by their number, so that joining the answers to them does not shuffle them again.
"""

from __future__ import annotations

import random
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from wearline.llm.words import text_bytes
from wearline.session import work_path

BLOCK_BYTES = 8 << 20
#: Entries that one bucket is meant to hold. Buckets follow the input, so this bounds memory.
BUCKET_ENTRIES = 1 << 20
#: Stands for a missing id, and sorts after all others.
NO_ID = (1 << 63) - 1


def pack(array: np.ndarray) -> bytes:
    """A compressed array. Bytes of equal weight lie together, which suits small numbers."""
    array = np.ascontiguousarray(array)
    planes = array.view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(array.dtype.str.encode().ljust(4) + planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    kind = np.dtype(raw[:4].decode().strip())
    planes = np.frombuffer(raw, np.uint8, offset=4).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def new_block() -> int:
    return random.SystemRandom().getrandbits(62)


def gather(batches, block_bytes: int = BLOCK_BYTES):
    """(ids, texts) of about block_bytes of text from batches of (id, text), whole rows only.

    A third column, of booleans, comes along as an array.

    A missing id becomes NO_ID. A single longer text makes a block of its own.
    """
    ids, texts, marks, held = [], [], [], 0

    def block():
        done = np.concatenate(ids), pa.chunked_array(texts).combine_chunks()
        return (*done, np.concatenate(marks)) if marks else done

    for batch in batches:
        keys = batch.column(0).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        column = batch.column(1)
        sizes = np.diff(text_bytes(column)[1])
        first = 0
        total = np.cumsum(sizes)
        while first < len(keys):
            before = int(total[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(total, before + block_bytes - held, side="right")))
            last = min(last, len(keys))
            ids.append(keys[first:last])
            texts.append(column.slice(first, last - first).fill_null(""))
            if batch.num_columns > 2:
                marks.append(batch.column(2).to_numpy(zero_copy_only=False)[first:last])
            held += int(total[last - 1]) - before
            first = last
            if held >= block_bytes * 15 // 16:
                yield block()
                ids, texts, marks, held = [], [], [], 0
    if ids:
        yield block()


def settle_blocks(df: DataFrame, name: str) -> DataFrame:
    """Write rows with a column block to the shared folder, bucketed by it, and read them back."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    (df.write.format("parquet").option("compression", "uncompressed").option("path", work_path(spark, name))
     .bucketBy(buckets, "block").saveAsTable(table))
    return spark.table(table)


def bucket_count(docs: DataFrame, text_col: str, entries_per_byte: float) -> int:
    """Buckets for values of which a text has so many per byte."""
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    at_least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(at_least, int(size * entries_per_byte) // BUCKET_ENTRIES + 1)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket by the upper 32 bits."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index of each run of equal neighbours, and one past the last run."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate([[0], cuts, [len(values)]]).astype(np.int64)


def rejoin(blocks: DataFrame, answers: DataFrame, columns: list[str]) -> DataFrame:
    """Each block with answers: its answers as an array of structs of columns, by bucket."""
    by_block = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", *columns))).alias("answers"))
    return blocks.join(by_block, "block", "left")
