"""Byte-level BPE: every distinct pre-token of the corpus is encoded once.

Blocks of documents send their distinct pre-tokens to hash buckets; a bucket encodes each distinct
one once and answers with its ids; the blocks put the ids back in place. Decoding joins ids with
the table of token bytes.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame, functions as F

from wearline.llm.blocks import (
    NO_ID, bucket_count, bucket_of, gather, new_block, pack, rejoin, runs, settle_blocks, unpack,
)
from wearline.llm.words import Words, text_bytes, word_hashes

#: Texts are cut into pre-tokens a megabyte at a time.
STEP_BYTES = 1 << 20
BLOCK_BYTES = 6 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and a number per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def rust_pattern(pattern: str) -> str:
    """The pattern for the regex module, with \\s as Unicode white space as tiktoken reads it."""
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


@lru_cache(maxsize=4)
def _splitter(pattern: str):
    return regex.compile(rust_pattern(pattern))


def _distinct(texts: pa.Array, pattern: str):
    """(index of each pre-token into the distinct ones, the distinct ones, pre-tokens per text)."""
    find, chunks, counts, held, size = _splitter(pattern).findall, [], [], [], 0
    for text in texts:
        found = find(text.as_py())
        counts.append(len(found))
        held += found
        size += len(found)
        if size >= STEP_BYTES // 4:
            chunks.append(pa.array(held, pa.string()).dictionary_encode())
            held, size = [], 0
    chunks.append(pa.array(held, pa.string()).dictionary_encode())
    one = pa.chunked_array(chunks).unify_dictionaries()
    words = one.chunk(one.num_chunks - 1).dictionary
    index = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in one.chunks]).astype(np.int64)
    return index, words, np.array(counts, np.int64)


def _hashes(words: pa.Array) -> np.ndarray:
    data, at = text_bytes(words)
    return word_hashes(Words(data, at[:-1], at[1:], np.array([0, len(words)])))


BLOCK = "block long, ids binary, counts binary, places binary, order binary, cuts binary, words binary"


def _to_blocks(pattern: str, buckets: int, block_bytes: int):
    """place: each pre-token's distinct one, by falling frequency; order: from that rank to the
    place in the sent list, which is by bucket and then bytes; cuts: buckets and their sizes."""
    def run(batches):
        for ids, texts in gather(batches, block_bytes):
            index, words, counts = _distinct(texts, pattern)
            bucket = bucket_of(_hashes(words), buckets)
            by_bytes = pa.compute.array_sort_indices(words).to_numpy().astype(np.int64)
            sent = by_bytes[np.argsort(bucket[by_bytes], kind="stable")]
            place = np.empty(len(words), np.int64)
            place[sent] = np.arange(len(words))
            common = np.argsort(-np.bincount(index, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[common] = np.arange(len(words))
            data, at = text_bytes(words.take(pa.array(sent)))
            cuts = runs(bucket[sent]) if len(sent) else np.zeros(1, np.int64)
            packed = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                packed.append(pack(np.diff(at[a:b + 1]).astype(np.int32)))
                packed.append(zstandard.ZstdCompressor(level=3).compress(data[at[a]:at[b]].tobytes()))
            sizes = np.array([len(p) for p in packed], np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([new_block()], pa.int64()),
                 *(pa.array([x], pa.binary()) for x in (
                     pack(ids), pack(counts.astype(np.int32)), pack(rank[index].astype(np.uint32)),
                     pack(place[common].astype(np.uint32)),
                     pack(np.concatenate([bucket[sent][cuts[:-1]], sizes]).astype(np.int32)), b"".join(packed)))],
                names=["block", "ids", "counts", "places", "order", "cuts", "words"])

    return run


def _send(batches):
    for batch in batches:
        for row in batch.to_pylist():
            cuts = unpack(row["cuts"])
            n = len(cuts) // 3
            ends = np.concatenate([[0], np.cumsum(cuts[n:])]).tolist()
            body = row["words"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cuts[:n], pa.int32()), pa.array([row["block"]] * n, pa.int64()),
                 pa.array([body[ends[2 * k]:ends[2 * k + 1]] for k in range(n)], pa.binary()),
                 pa.array([body[ends[2 * k + 1]:ends[2 * k + 2]] for k in range(n)], pa.binary())],
                names=["bucket", "block", "sizes", "words"])


_ENCODERS: dict[int, tiktoken.Encoding] = {}


def _encoder(shared) -> tiktoken.Encoding:
    """An encoder that takes each string as one piece."""
    key = id(shared.value)
    if key not in _ENCODERS:
        _ENCODERS[key] = tiktoken.Encoding("piece", pat_str=r"(?s:.)+", mergeable_ranks=shared.value, special_tokens={})
    return _ENCODERS[key]


def _encode(shared):
    def run(table):
        sizes = [unpack(s.as_py()) for s in table.column("sizes")]
        raw = [zstandard.ZstdDecompressor().decompress(w.as_py()) for w in table.column("words")]
        every = np.concatenate(sizes)
        ends = np.concatenate([[0], np.cumsum(every)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(every), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(raw))])
        coded = words.dictionary_encode()
        ranks, encode = shared.value, _encoder(shared).encode_ordinary
        ids = []
        for word in coded.dictionary.to_pylist():
            whole = ranks.get(word.encode())
            ids.append([whole] if whole is not None else encode(word))
        lens = np.array([len(i) for i in ids], np.int64)
        flat = np.array([t for i in ids for t in i], np.uint32)
        start = np.concatenate([[0], np.cumsum(lens)])[:-1]
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        out, first = [], 0
        for n in map(len, sizes):
            mine = which[first:first + n]
            first += n
            out.append((pack(lens[mine].astype(np.int32)), pack(flat[_spread(start[mine], lens[mine])])))
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "lens": pa.array([o[0] for o in out], pa.binary()), "tokens": pa.array([o[1] for o in out], pa.binary())})

    return run


def _spread(start: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """All indices of the spans start[k] .. start[k] + lens[k] - 1, one span after another."""
    total = np.concatenate([[0], np.cumsum(lens)])
    return np.repeat(start - total[:-1], lens) + np.arange(total[-1])


RESULT = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, token_ids array<int>"


def _finish(shared, with_ids: bool):
    def run(batches):
        table = _token_bytes(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids, counts = unpack(row["ids"]), unpack(row["counts"]).astype(np.int64)
                answers = row["answers"] or []
                lens = np.concatenate([unpack(a["lens"]) for a in answers] or [np.empty(0, np.int32)]).astype(np.int64)
                flat = np.concatenate([unpack(a["tokens"]) for a in answers] or [np.empty(0, np.uint32)])
                start = np.concatenate([[0], np.cumsum(lens)])[:-1]
                order = unpack(row["order"]).astype(np.int64)
                first = np.concatenate([[0], np.cumsum(counts)])
                places = unpack(row["places"])
                n, id_sha, text_sha, lists = [], [], [], []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                    mine = order[places[a:b]]
                    tokens = flat[_spread(start[mine], lens[mine])].astype("<u4")
                    n.append(len(tokens))
                    id_sha.append(hashlib.sha256(tokens.tobytes()).hexdigest())
                    text_sha.append(hashlib.sha256(decode_bytes(tokens, table)).hexdigest())
                    lists.append(tokens.astype(np.int32) if with_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=ids == NO_ID), pa.array(n, pa.int64()), pa.array(id_sha, pa.string()),
                     pa.array(text_sha, pa.string()), pa.array(lists, pa.list_(pa.int32()))],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"])

    return run


def _token_bytes(ranks: dict[bytes, int]):
    """The token-byte table as one buffer with the start and length of every id."""
    size = max(ranks.values(), default=-1) + 1
    tokens = [b""] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    lens = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum(lens)])[:-1], lens


def decode_bytes(tokens: np.ndarray, table) -> bytes:
    data, start, lens = table
    return data[_spread(start[tokens], lens[tokens])].tobytes()


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256, token_ids.

    ids_sha256 is over the ids as little-endian 32-bit numbers, decoded_sha256 over the bytes that
    decoding gives back. Special tokens are ordinary text. A null text counts as empty and has no
    tokens; ids are integers or null. Repeated rows give repeated rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    buckets = bucket_count(texts, "text", 1 / 40)
    blocks = settle_blocks(texts.mapInArrow(_to_blocks(pattern, buckets, block_bytes), BLOCK), "bpe")
    answers = (blocks.select("block", "cuts", "words")
               .mapInArrow(_send, "bucket int, block long, sizes binary, words binary")
               .groupBy("bucket").applyInArrow(_encode(shared), "block long, bucket int, lens binary, tokens binary"))
    done = rejoin(blocks.drop("cuts", "words"), answers, ["lens", "tokens"]).mapInArrow(_finish(shared, with_ids), RESULT)
    return done.withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "token_ids") -> DataFrame:
    """encoded with a column decoded: the bytes of its ids, by the token-byte table.

    The table has one row per token of the vocabulary, which bounds what is sent to the executors.
    Null ids give null. An id without bytes raises an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    @F.arrow_udf("binary")
    def run(lists: pa.Array) -> pa.Array:
        table = _token_bytes(shared.value)
        return pa.array([None if x is None else decode_bytes(np.array(x, np.int64), table) for x in lists.to_pylist()], pa.binary())

    return encoded.withColumn("decoded", run(F.col(ids_col)))
