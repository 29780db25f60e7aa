"""Katz backoff language model: Good-Turing discounted bigrams over unigrams.

Blocks of documents hold their token streams as places in a list of distinct tokens. Two exchanges
with hash buckets count tokens and then bigrams over the training documents; the counts, and for each
context what its backoff weight needs, come back once per distinct value of a block. The last step
evaluates each token: its bigram if that was seen, else the backoff weight times its unigram.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wearline.llm.blocks import (
    NO_ID, bucket_count, bucket_of, gather, new_block, pack, rejoin, runs, settle_blocks, unpack,
)
from wearline.llm.words import find_words, mix, word_hashes

#: Counts up to this are discounted.
K = 5
#: Stand-ins for the end of a text and for the context of its first token.
END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
#: A context seen more often is dealt over several buckets. It grows with the corpus, so that there
#: are never more than MAX_SPLIT such contexts.
SPLIT = 1 << 20
MAX_SPLIT = 500_000
WORD_BYTES = 6
BLOCK_BYTES = 6 << 20

BLOCK = "block long, ids binary, counts binary, train binary, unique binary, places binary"


def _rows(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], names=list(columns))


def _to_blocks(block_bytes: int):
    def run(batches):
        for ids, texts, train in gather(batches, block_bytes):
            words = find_words(texts, lower=True)
            n = len(words.start)
            tokens = np.full(n + len(ids), END)
            tokens[np.arange(n) + words.doc_of()] = word_hashes(words)
            unique, place = np.unique(tokens, return_inverse=True)
            one = lambda x: ([x], pa.binary())
            yield _rows({"block": ([new_block()], pa.int64()), "ids": one(pack(ids)),
                         "counts": one(pack((words.counts + 1).astype(np.int32))), "train": one(pack(train.astype(np.uint8))),
                         "unique": one(unique.tobytes()), "places": one(pack(place.astype(np.uint32)))})

    return run


class Block:
    def __init__(self, row: dict):
        self.ids, self.counts = unpack(row["ids"]), unpack(row["counts"]).astype(np.int64)
        self.train = unpack(row["train"]).astype(bool)
        self.unique = np.frombuffer(row["unique"], np.uint64)
        self.place = unpack(row["places"]).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.learned = np.repeat(self.train, self.counts)

    def unigrams(self) -> np.ndarray:
        return np.bincount(self.place[self.learned], minlength=len(self.unique))

    def bigrams(self, seen: np.ndarray):
        """Distinct (context, token) places, training counts, and each token's pair.

        The context of a first token is the place after all others. seen: training counts of the
        distinct tokens."""
        n = len(self.unique)
        context = np.empty_like(self.place)
        context[1:] = self.place[:-1]
        context[self.first[:-1]] = n
        pairs, which = np.unique(context * (n + 1) + self.place, return_inverse=True)
        count = np.bincount(which[self.learned], minlength=len(pairs))
        return pairs // (n + 1), pairs % (n + 1), count, which


def _send_unigrams(buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                bucket, n = bucket_of(b.unique, buckets), b.unigrams()
                cuts = runs(bucket)
                spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
                yield _rows({"bucket": (bucket[cuts[:-1]], pa.int32()), "block": ([row["block"]] * len(spans), pa.int64()),
                             "hashes": ([b.unique[x:y].tobytes() for x, y in spans], pa.binary()),
                             "counts": ([pack(n[x:y].astype(np.uint32)) for x, y in spans], pa.binary())})

    return run


def _classes(counts: np.ndarray) -> list[int]:
    """How many counts equal 1 .. K + 1."""
    return np.bincount(np.minimum(counts, K + 2), minlength=K + 3)[1:K + 2].tolist()


N_COLUMNS = [f"n{r}" for r in range(1, K + 2)]
STATS = "total long, kinds long, " + ", ".join(f"{c} long" for c in N_COLUMNS)


def _stats(rows: int, total: int, counts: np.ndarray) -> dict:
    """Columns of statistics on the first of a bucket's rows; zeros on the others."""
    values = [total, int((counts > 0).sum()), *_classes(counts)]
    return {name: pa.array([v] + [0] * (rows - 1), pa.int64()) for name, v in zip(["total", "kinds", *N_COLUMNS], values)}


def _count_unigrams(table):
    parts = [np.frombuffer(h.as_py(), np.uint64) for h in table.column("hashes")]
    counts = np.concatenate([unpack(c.as_py()) for c in table.column("counts")]).astype(np.int64)
    _, which = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(which, weights=counts).astype(np.int64)
    mine, ends = total[which], np.cumsum([len(p) for p in parts])
    answers = [pack(mine[e - len(p):e].astype(np.uint64)) for p, e in zip(parts, ends.tolist())]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                     "counts": pa.array(answers, pa.binary()), **_stats(len(parts), int(total.sum()), total)})


def good_turing(n: list[int]) -> np.ndarray:
    """Katz's discounts of counts 1 .. K (index 0 unused) from how many kinds have 1 .. K + 1.

    Where these numbers give no discount between 0 and 1, an absolute discount takes its place."""
    d = np.ones(K + 1)
    if all(n):
        rest = (K + 1) * n[K] / n[0]
        if rest < 1:
            for r in range(1, K + 1):
                d[r] = ((r + 1) * n[r] / (r * n[r - 1]) - rest) / (1 - rest)
            if (d[1:] > 0).all() and (d[1:] < 1).all():
                return d
    part = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    for r in range(1, K + 1):
        d[r] = (r - min(part, 0.9)) / r
    return d


class Unigrams:
    """Discounted probabilities of tokens by their training counts; what is left is that of any
    unknown token."""

    def __init__(self, total: int, kinds: int, n: list[int]):
        self.total, self.kinds, self.d = total, kinds, good_turing(n)
        left = sum((1 - self.d[r]) * r * n[r - 1] for r in range(1, K + 1))
        self.base = total if left > 0 else total + 1
        self.unknown = (left if left > 0 else 1) / self.base

    def probability(self, counts: np.ndarray) -> np.ndarray:
        p = self.d[np.where(counts <= K, counts, 0)] * counts / self.base
        return np.where(counts > 0, p, self.unknown)


def _join_counts(row: dict, n: int) -> np.ndarray:
    found = [unpack(a["counts"]) for a in row["answers"] or []]
    return np.concatenate(found).astype(np.int64) if found else np.zeros(n, np.int64)


def _dealt(b: Block, seen: np.ndarray, documents: int, split: int, buckets: int):
    """The block's bigrams whose context was learned, by bucket and context."""
    context, token, count, which = b.bigrams(seen)
    times = np.append(seen, documents)
    hashes = np.append(b.unique, START)
    parts = 1 + times // split
    own = hashes[context]
    salted = parts[context] > 1
    own = np.where(salted, mix(own + (mix(hashes[token]) % parts[context].astype(np.uint64) + np.uint64(1)) * END), mix(own))
    bucket = bucket_of(own, buckets)
    known = np.flatnonzero(times[context] > 0)
    sent = known[np.lexsort((context[known], bucket[known]))]
    return context, token, count, which, sent, bucket[sent], times, hashes, parts


PAIRS = "bucket int, block long, contexts binary, sizes binary, words binary, counts binary, seen binary, split binary"


def _send_bigrams(documents: int, split: int, buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                seen = _join_counts(row, len(b.unique))
                context, token, count, _, sent, bucket, _, hashes, parts = _dealt(b, seen, documents, split, buckets)
                if not len(sent):
                    continue
                cuts = runs(bucket)
                context, token, count = context[sent], token[sent], count[sent]
                words = np.ascontiguousarray(hashes[token].view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES])
                out = [[] for _ in range(6)]
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    own = runs(context[x:y])
                    heads = context[x:y][own[:-1]]
                    for column, value in zip(out, (
                            hashes[heads].tobytes(), pack(np.diff(own).astype(np.int32)), words[x:y].tobytes(),
                            pack(count[x:y].astype(np.uint32)), pack(seen[token[x:y]].astype(np.uint64)),
                            hashes[heads[parts[heads] > 1]].tobytes())):
                        column.append(value)
                names = ("contexts", "sizes", "words", "counts", "seen", "split")
                yield _rows({"bucket": (bucket[cuts[:-1]], pa.int32()), "block": ([row["block"]] * (len(cuts) - 1), pa.int64()),
                             **{name: (column, pa.binary()) for name, column in zip(names, out)}})

    return run


#: Of one context: kinds of followers counted 1 .. K, the sum of larger counts, and the unigram
#: probability of all its followers.
SUMS = K + 2
ANSWER = "block long, bucket int, counts binary, sums binary, split binary, " + STATS


def _count_bigrams(unigrams: Unigrams):
    def run(table):
        pick = lambda name: [x.as_py() for x in table.column(name)]
        heads = [np.frombuffer(x, np.uint64) for x in pick("contexts")]
        sizes = [unpack(x) for x in pick("sizes")]
        raw = np.frombuffer(b"".join(pick("words")), np.uint8).reshape(-1, WORD_BYTES)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :WORD_BYTES] = raw
        word = wide.view(np.uint64).reshape(-1)
        del raw, wide
        context, which_context = np.unique(np.concatenate(heads), return_inverse=True)
        own = np.repeat(which_context, np.concatenate(sizes))
        counts = np.concatenate([unpack(x) for x in pick("counts")]).astype(np.int64)
        seen = np.concatenate([unpack(x) for x in pick("seen")]).astype(np.int64)
        order = np.lexsort((word, own))
        o, w = own[order], word[order]
        new = np.concatenate([[True], (o[1:] != o[:-1]) | (w[1:] != w[:-1])])
        first = np.flatnonzero(new)
        total = np.add.reduceat(counts[order], first)
        mine = np.empty(len(own), np.int64)
        mine[order] = np.repeat(total, np.diff(np.append(first, len(own))))
        pair_context, hit = o[first], total > 0
        n = len(context)
        sums = np.zeros((SUMS, n))
        for r in range(1, K + 1):
            sums[r - 1] = np.bincount(pair_context[total == r], minlength=n)
        large = total > K
        sums[K] = np.bincount(pair_context[large], weights=total[large], minlength=n)
        p = unigrams.probability(seen[order][first])
        sums[K + 1] = np.bincount(pair_context[hit], weights=p[hit], minlength=n)
        split = np.unique(np.frombuffer(b"".join(pick("split")), np.uint64))
        at = np.searchsorted(context, split)
        hot = [split.tobytes() + sums[:, at].astype("<f8").tobytes()]
        answers, of_context, x, y = [], [], 0, 0
        for h, s in zip(heads, sizes):
            m = int(s.sum())
            answers.append(pack(mine[x:x + m].astype(np.uint32)))
            mass = sums[:, which_context[y:y + len(h)]]
            of_context.append(pack(mass[:K + 1].astype(np.uint32).reshape(-1)) + b"//" + pack(mass[K + 1]))
            x, y = x + m, y + len(h)
        rows = len(heads)
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "counts": pa.array(answers, pa.binary()),
                         "sums": pa.array(of_context, pa.binary()),
                         "split": pa.array(hot + [None] * (rows - 1), pa.binary()),
                         **_stats(rows, int(total.sum()), total)})

    return run


def _read_sums(data: bytes) -> np.ndarray:
    import zstandard
    one = zstandard.ZstdDecompressor().decompressobj()
    raw = one.decompress(data)
    kind = np.dtype(raw[:4].decode().strip())
    small = np.ascontiguousarray(np.frombuffer(raw, np.uint8, offset=4).reshape(kind.itemsize, -1).T).view(kind).reshape(K + 1, -1)
    return np.vstack([small, unpack(one.unused_data[2:])])


def _split_rows(batches):
    """(context, sums...) from the packed partial sums of split contexts."""
    for batch in batches:
        for data in batch.column(0).to_pylist():
            n = len(data) // (8 * (SUMS + 1))
            context = np.frombuffer(data, np.int64, n)
            sums = np.frombuffer(data, "<f8", offset=8 * n).reshape(SUMS, n)
            yield pa.RecordBatch.from_arrays([pa.array(context), *(pa.array(s) for s in sums)],
                                             names=["context", *(f"s{i}" for i in range(SUMS))])


class Backoff:
    """Denominators and backoff weights of contexts from their sums and the bigram discounts."""

    def __init__(self, sums: np.ndarray, d: np.ndarray):
        r = np.arange(1, K + 1)[:, None]
        total = (sums[:K] * r).sum(axis=0) + sums[K]
        kept = (sums[:K] * r * d[1:, None]).sum(axis=0) + sums[K]
        # A context whose followers are all frequent still leaves room for one more event.
        left = np.where(total - kept > 1e-9, total - kept, 1.0)
        self.base = kept + left
        self.weight = left / self.base / np.maximum(1 - sums[K + 1], 1e-300)


RESULT = "id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _finish(unigrams: Unigrams, d: np.ndarray, shared, documents: int, split: int, buckets: int):
    def run(batches):
        hot_context, hot_sums = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                answers = row["answers"] or []
                ones = [a for a in answers if not a["pairs"]]
                seen = _join_counts({"answers": ones}, len(b.unique))
                context, token, count, which, sent, bucket, times, hashes, parts = _dealt(b, seen, documents, split, buckets)
                found = np.zeros(len(context), np.int64)
                base, weight = np.ones(len(hashes)), np.ones(len(hashes))
                if len(sent):
                    mine = [a for a in answers if a["pairs"]]
                    found[sent] = np.concatenate([unpack(a["counts"]) for a in mine])
                    cuts = runs(bucket.astype(np.int64) * (len(hashes) + 1) + context[sent])
                    heads = context[sent][cuts[:-1]]
                    sums = np.hstack([_read_sums(a["sums"]) for a in mine])
                    many = np.flatnonzero(parts[heads] > 1)
                    if len(many):
                        sums = sums.astype(np.float64)
                        sums[:, many] = hot_sums[:, np.searchsorted(hot_context, hashes[heads[many]].view(np.int64))]
                    known = Backoff(sums, d)
                    base[heads], weight[heads] = known.base, known.weight
                one = unigrams.probability(np.append(seen, 0))[token]
                p = np.where(found > 0, d[np.where(found <= K, found, 0)] * found / base[context],
                             np.where(times[context] > 0, weight[context], 1.0) * one)
                log_p = np.log10(np.maximum(p, 1e-300))[which]
                plain = np.log10((seen + 1) / (unigrams.total + unigrams.kinds + 1))[b.place]
                starts = b.first[:-1]
                yield _rows({"id": (pa.array(b.ids, mask=b.ids == NO_ID), pa.int64()), "train": (b.train, pa.bool_()),
                             "n_tokens": (b.counts, pa.int64()),
                             "n_known": (np.add.reduceat((seen > 0)[b.place].astype(np.int64), starts), pa.int64()),
                             "train_tokens": (np.full(len(starts), unigrams.total), pa.int64()),
                             "base_score": (np.add.reduceat(plain, starts), pa.float64()),
                             "score": (np.add.reduceat(log_p, starts), pa.float64())})

    return run


def _sums_of(table: DataFrame) -> tuple[int, int, list[int]]:
    row = table.agg(*[F.sum(c) for c in ("total", "kinds", *N_COLUMNS)]).first()
    values = [int(v or 0) for v in row]
    return values[0], values[1], values[2:]


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train=None,
                    split: int = SPLIT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, train, n_tokens, n_known, train_tokens, base_score, score.

    train: a boolean column of the rows to learn from (all by default; null counts as true). Tokens
    are lower-cased words and one end. score is the log10 probability of a text, base_score that of
    add-one unigrams. A null text counts as empty and is one end. Ids are integers or null; repeated
    rows count and are scored each; other columns are ignored. With nothing to learn from, every
    token is unknown and certain to be, so scores are 0.
    """
    spark = docs.sparkSession
    learned = F.lit(True) if train is None else F.coalesce(train, F.lit(True))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), learned.alias("train"))
    blocks = settle_blocks(texts.mapInArrow(_to_blocks(block_bytes), BLOCK), "katz")
    documents = texts.where("train").count()

    one_buckets = bucket_count(texts, "text", 1 / 40)
    ones = settle_blocks(blocks.mapInArrow(_send_unigrams(one_buckets), "bucket int, block long, hashes binary, counts binary")
                         .groupBy("bucket").applyInArrow(_count_unigrams, "block long, bucket int, counts binary, " + STATS),
                         "katz_unigrams")
    unigrams = Unigrams(*_sums_of(ones))
    split = max(split, unigrams.total // MAX_SPLIT)

    two_buckets = bucket_count(texts, "text", 1 / 8)
    pairs = settle_blocks(rejoin(blocks, ones, ["counts"]).mapInArrow(_send_bigrams(documents, split, two_buckets), PAIRS)
                          .groupBy("bucket").applyInArrow(_count_bigrams(unigrams), ANSWER), "katz_bigrams")
    _, _, kinds = _sums_of(pairs)
    columns = [f"s{i}" for i in range(SUMS)]
    hot = (pairs.where("split IS NOT NULL").select("split")
           .mapInArrow(_split_rows, "context long, " + ", ".join(f"{c} double" for c in columns))
           .groupBy("context").agg(*[F.sum(c).alias(c) for c in columns]).orderBy("context").collect())
    shared = spark.sparkContext.broadcast((
        np.array([r["context"] for r in hot], np.int64),
        np.array([[r[c] for r in hot] for c in columns], np.float64).reshape(SUMS, len(hot))))

    none = F.lit(None).cast("binary")
    answers = (ones.select("block", "bucket", F.lit(False).alias("pairs"), "counts", none.alias("sums"))
               .union(pairs.select("block", "bucket", F.lit(True).alias("pairs"), "counts", "sums")))
    done = rejoin(blocks, answers, ["pairs", "counts", "sums"]).mapInArrow(
        _finish(unigrams, good_turing(kinds), shared, documents, split, two_buckets), RESULT)
    return done.withColumnRenamed("id", id_col)
