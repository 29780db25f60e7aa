"""Exact substring dedup: Rabin-Karp hashes of every window of words, counted in hash buckets."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from wearline.llm.blocks import (
    NO_ID, bucket_count, bucket_of, gather, new_block, pack, rejoin, runs, settle_blocks, unpack,
)
from wearline.llm.words import find_words, text_bytes, window_hashes, window_starts, word_hashes

WIDTH = 50
#: Bytes of a window hash that are sent, besides what its bucket tells.
HASH_BYTES = 7
BLOCK_BYTES = 4 << 20


class Windows:
    """The windows of one block whose documents are in order of their ids."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, width: int):
        self.words = find_words(texts)
        self.starts = window_starts(self.words, width)
        hashes = window_hashes(word_hashes(self.words), self.starts, width)
        self.ids = ids[self.words.doc_of()[self.starts]]
        # The first of equal windows belongs to the smallest document of the block.
        self.unique, self.first, self.which = np.unique(hashes, return_index=True, return_inverse=True)

    def sent(self, buckets: int):
        """(index into unique, bucket) of all distinct windows, by bucket and then place."""
        by_place = np.argsort(self.first)
        bucket = bucket_of(self.unique[by_place], buckets)
        order = np.argsort(bucket, kind="stable")
        return by_place[order], bucket[order]

    def removed(self, earlier: np.ndarray, width: int) -> np.ndarray:
        """Mask of words in windows that start in a smaller document. earlier: by distinct window,
        whether some other block has it in a smaller document."""
        hit = earlier[self.which] | (self.ids > self.ids[self.first][self.which])
        step = np.zeros(len(self.words.start) + 1, np.int64)
        np.add.at(step, self.starts[hit], 1)
        np.add.at(step, self.starts[hit] + width, -1)
        return np.cumsum(step[:-1]) > 0


def _texts(body: bytes, sizes: np.ndarray) -> pa.Array:
    raw = zstandard.ZstdDecompressor().decompress(body) if body else b""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


BLOCK = "block long, ids binary, sizes binary, body binary"


def _to_blocks(block_bytes: int):
    def run(batches):
        for ids, texts in gather(batches, block_bytes):
            order = np.argsort(ids, kind="stable")
            ids, texts = ids[order], texts.cast(pa.large_string()).take(pa.array(order))
            data, at = text_bytes(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([new_block()], pa.int64()), pa.array([pack(ids)], pa.binary()),
                 pa.array([pack(np.diff(at))], pa.binary()),
                 pa.array([zstandard.ZstdCompressor(level=3).compress(data.tobytes())], pa.binary())],
                names=["block", "ids", "sizes", "body"])

    return run


def _sender(width: int, buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                w = Windows(unpack(row["ids"]), _texts(row["body"], unpack(row["sizes"])), width)
                sent, bucket = w.sent(buckets)
                if not len(sent):
                    continue
                cuts = runs(bucket)
                part = np.ascontiguousarray(w.unique[sent].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES])
                owner = w.ids[w.first[sent]]
                out = []
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    owners = runs(owner[a:b])
                    out.append((int(bucket[a]), row["block"], part[a:b].tobytes(), pack(owner[a:b][owners[:-1]]),
                                pack(np.diff(owners).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[k] for o in out], kind) for k, kind in enumerate(
                        (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                    names=["bucket", "block", "hashes", "owners", "counts"])

    return run


def _earlier(table):
    """For one bucket: of every block's windows, which another block has in a smaller document."""
    hashes, owners, sizes = [], [], []
    for h, o, n in zip(table.column("hashes"), table.column("owners"), table.column("counts")):
        raw = np.frombuffer(h.as_py(), np.uint8).reshape(-1, HASH_BYTES)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :HASH_BYTES] = raw
        hashes.append(wide.view("<u8").reshape(-1))
        owners.append(np.repeat(unpack(o.as_py()), unpack(n.as_py())))
        sizes.append(len(raw))
    every, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(every)
    ranked = every[order]
    cuts = runs(ranked)
    least = np.minimum.reduceat(owner[order], cuts[:-1])
    hit = np.empty(len(every), bool)
    hit[order] = owner[order] > np.repeat(least, np.diff(cuts))
    ends = np.cumsum(sizes)
    masks = [np.packbits(hit[e - n:e]).tobytes() for e, n in zip(ends.tolist(), sizes)]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                     "mask": pa.array(masks, pa.binary()), "n": pa.array(sizes, pa.int32())})


RESULT = "id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:int,end:int>>, kept string"


def _finisher(width: int, buckets: int, with_text: bool):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["ids"])
                w = Windows(ids, _texts(row["body"], unpack(row["sizes"])), width)
                sent, _ = w.sent(buckets)
                earlier = np.zeros(len(w.unique), bool)
                if len(sent):
                    earlier[sent] = np.concatenate([np.unpackbits(np.frombuffer(a["mask"], np.uint8), count=a["n"])
                                                    for a in row["answers"]]).astype(bool)
                gone = w.removed(earlier, width)
                data, doc = w.words.data.tobytes(), w.words.doc.tolist()
                start, end = w.words.start, w.words.end
                digests, spans, texts, lost = [], [], [], []
                for a, b in zip(doc[:-1], doc[1:]):
                    mask = gone[a:b]
                    n = int(mask.sum())
                    if n:
                        edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]))).tolist()
                        spans.append([{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2])])
                        kept = np.flatnonzero(~mask) + a
                        text = b" ".join([data[s:e] for s, e in zip(start[kept].tolist(), end[kept].tolist())])
                    else:
                        spans.append([])
                        text = b" ".join(data[start[a]:end[b - 1]].split()) if b > a else b""
                    lost.append(n)
                    digests.append(hashlib.sha256(text).hexdigest())
                    texts.append(text.decode() if with_text else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=ids == NO_ID), pa.array(w.words.counts.astype(np.int64)), pa.array(lost, pa.int64()),
                     pa.array(digests, pa.string()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     pa.array(texts, pa.string())],
                    names=["id", "n_words", "n_removed", "kept_sha256", "removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                   with_text: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, removed (word intervals), kept.

    A word goes if it lies in a window of width words that also starts in a document with a smaller
    id; windows are judged on the input. Ids are integers; a row without one counts as larger than
    all others, and rows with equal ids never remove from each other. Null and short texts lose
    nothing. Other columns are ignored; an empty table gives no rows.

    Every block sends each distinct window once, whatever the number of its copies there.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    blocks = settle_blocks(texts.mapInArrow(_to_blocks(block_bytes), BLOCK), "substrings")
    buckets = bucket_count(texts, "text", 1 / 6)
    answers = (blocks.mapInArrow(_sender(width, buckets),
                                 "bucket int, block long, hashes binary, owners binary, counts binary")
               .groupBy("bucket").applyInArrow(_earlier, "block long, bucket int, mask binary, n int"))
    done = rejoin(blocks, answers, ["mask", "n"]).mapInArrow(_finisher(width, buckets, with_text), RESULT)
    return done.withColumnRenamed("id", id_col)
