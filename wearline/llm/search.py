"""Ranked lexical search of many items at once, with shared partial sums.

Scores add up over terms, so terms that several items have in common need adding only once per
document. The items' terms, the most shared ones first, are written as sequences, and neighbours that
recur in two or more places become a node of their own, again and again, until none recurs. The nodes
form a graph: a node's accumulator is the sum of two others', and an item's score the sum of the
nodes left in its sequence. A task fills the accumulators of a block of documents once and reads all
items from them. Weights and lengths are integers, so the order of adding changes nothing.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from wearline.llm.blocks import NO_ID
from wearline.llm.words import ALPHANUMERIC, Words, find_words, pieces
from wearline.session import settle

#: Term occurrences of the items that are searched for together; more items take further passes.
GROUP_TERMS = 1 << 20
#: Accumulator cells (nodes x documents) that a task fills at once.
CELLS = 1 << 22


def word_array(words: Words) -> pa.Array:
    """The words as bytes, in order."""
    sizes = words.end - words.start
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    inside = np.repeat(words.start - at[:-1], sizes) + np.arange(at[-1])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(words.data[inside])])


class Plan(NamedTuple):
    terms: list[bytes]                  # the vocabulary; node k < len(terms) is term k
    steps: list[tuple]                  # (node, left, right) arrays, one tuple per depth of the graph
    nodes: int
    sequence: np.ndarray                # the nodes of all items, one item after another
    starts: np.ndarray                  # where each item's part begins
    items: np.ndarray                   # item numbers


def make_plan(rows: list[tuple[int, bytes, int]]) -> Plan:
    """The sharing graph of (item, term, occurrences) rows."""
    shared = Counter(term for _, term, _ in rows)
    terms = sorted(shared, key=lambda t: (-shared[t], t))
    number = {t: i for i, t in enumerate(terms)}
    held: dict[int, list[int]] = {}
    for item, term, n in rows:
        held.setdefault(item, []).extend([number[term]] * n)
    items = sorted(held)
    sequences = [sorted(held[i]) for i in items]
    nodes, depth, made = len(terms), [0] * len(terms), []
    while True:
        counts = Counter(pair for s in sequences for pair in zip(s, s[1:]))
        wanted = {p for p, n in counts.items() if n > 1}
        uses = Counter(pair for s in sequences for pair in _cut(s, wanted, counts) if isinstance(pair, tuple))
        kept = sorted(p for p, n in uses.items() if n > 1)
        if not kept:
            break
        names = {p: nodes + i for i, p in enumerate(kept)}
        for a, b in kept:
            made.append((nodes, a, b))
            depth.append(max(depth[a], depth[b]) + 1)
            nodes += 1
        keep = set(kept)
        sequences = [[names[x] if isinstance(x, tuple) else x for x in _cut(s, keep, counts)] for s in sequences]
    steps = []
    for level in range(1, max(depth, default=0) + 1):
        rows_of = [m for m in made if depth[m[0]] == level]
        steps.append(tuple(np.array(c, np.int64) for c in zip(*rows_of)))
    sizes = [len(s) for s in sequences]
    return Plan(terms, steps, nodes, np.array([x for s in sequences for x in s], np.int64),
                np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64), np.array(items, np.int64))


def _cut(sequence: list[int], pairs: set, counts: Counter) -> list:
    """The sequence with chosen neighbours as tuples, from left to right, the more frequent first."""
    out, i, n = [], 0, len(sequence)
    while i < n:
        pair = tuple(sequence[i:i + 2])
        if pair in pairs:
            after = tuple(sequence[i + 1:i + 3])
            if not (after in pairs and counts[after] > counts[pair]):
                out.append(pair)
                i += 2
                continue
        out.append(sequence[i])
        i += 1
    return out


def _postings(texts: pa.Array, vocabulary: pa.Array):
    """(document, term, occurrences) arrays and every document's number of words."""
    words = find_words(texts, ALPHANUMERIC, lower=True)
    found = pc.index_in(word_array(words), value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    known = found >= 0
    size = max(1, len(vocabulary))
    keys, counts = np.unique(words.doc_of()[known] * size + found[known], return_counts=True)
    return keys // size, keys % size, counts.astype(np.int64), words.counts.astype(np.int64)


def _item_terms(batches):
    for batch in batches:
        for first, part in pieces(batch.column(1)):
            words = find_words(part, ALPHANUMERIC, lower=True)
            coded = word_array(words).dictionary_encode()
            size = max(1, len(coded.dictionary))
            keys, counts = np.unique(words.doc_of() * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(first + keys // size)), coded.dictionary.take(pa.array(keys % size)).cast(pa.binary()),
                 pa.array(counts, pa.int64())], names=["item", "term", "n"])


def _vocabulary(terms: list[bytes]) -> pa.Array:
    return pa.array(terms, pa.large_binary())


def _frequencies(shared):
    """Rows (term number, documents with it) of one task; -1 counts documents with a word, -2 all words."""
    def run(batches):
        plan = shared.value
        vocabulary, df, n_docs, n_words = _vocabulary(plan.terms), np.zeros(len(plan.terms), np.int64), 0, 0
        for batch in batches:
            for _, part in pieces(batch.column(0)):
                _, term, _, sizes = _postings(part, vocabulary)
                df += np.bincount(term, minlength=len(df))
                n_docs, n_words = n_docs + int((sizes > 0).sum()), n_words + int(sizes.sum())
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([seen, [-1, -2]]), pa.int64()), pa.array(np.concatenate([df[seen], [n_docs, n_words]]), pa.int64())],
            names=["term", "n"])

    return run


class Weights(NamedTuple):
    term: np.ndarray
    n_docs: int
    n_words: int


def _weights(plan: Plan, rows) -> Weights:
    counts = {r.term: r.n for r in rows}
    n_docs = counts.get(-1, 0)
    term = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(k, 0) + 1))) for k in range(len(plan.terms))]
    return Weights(np.array(term, np.int64), n_docs, counts.get(-2, 0))


def _best(item, score, doc, k: int):
    """The k first rows of each item by falling score, then rising document."""
    order = np.lexsort((doc, -score, item))
    item, score, doc = item[order], score[order], doc[order]
    first = np.searchsorted(item, item)
    keep = np.arange(len(item)) - first < k
    return item[keep], score[keep], doc[keep]


def _search(shared, k: int):
    """The k best documents of one task for each item."""
    def run(batches):
        plan, weights = shared.value
        vocabulary = _vocabulary(plan.terms)
        best = tuple(np.empty(0, np.int64) for _ in range(3))
        least = np.ones(len(plan.items), np.int64)
        at_once = max(1, CELLS // max(plan.nodes, len(plan.sequence)))
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for first, part in pieces(batch.column(1)):
                doc, term, tf, sizes = _postings(part, vocabulary)
                norm = 25 + 75 * sizes * weights.n_docs // max(1, weights.n_words)
                gain = weights.term[term] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[doc]))
                for a in range(0, len(sizes), at_once):
                    b = min(a + at_once, len(sizes))
                    low, high = np.searchsorted(doc, [a, b])
                    sums = np.zeros((plan.nodes, b - a), np.int64)
                    sums[term[low:high], doc[low:high] - a] = gain[low:high]
                    for node, left, right in plan.steps:
                        sums[node] = sums[left] + sums[right]
                    scores = np.add.reduceat(sums[plan.sequence], plan.starts, axis=0)
                    item, col = np.nonzero(scores >= least[:, None])
                    if not len(item):
                        continue
                    best = _best(*(np.concatenate(x) for x in zip(best, (item, scores[item, col], ids[first + a + col]))), k)
                    full = np.bincount(best[0], minlength=len(least)) == k
                    last = np.searchsorted(best[0], np.arange(len(least)), side="right") - 1
                    least[full] = np.maximum(1, best[1][last[full]])
        item, score, doc = best
        yield pa.RecordBatch.from_arrays([pa.array(plan.items[item], pa.int64()), pa.array(score), pa.array(doc)], names=["item", "score", "doc"])

    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", group_terms: int = GROUP_TERMS) -> DataFrame:
    """Rows item_id, rank, doc_id, score: the k best documents of every item with a score above 0.

    Null texts have no terms. Every input row counts by itself: items that repeat are ranked again
    under the same id, documents that repeat are ranked beside each other. Equal scores go by rising
    document id, a null id last. No documents, items or common terms give no rows. Columns other than
    those named are not read. Items are dealt into groups of about group_terms term occurrences, each
    searched in one pass; an item alone is not split, so its terms must fit into a task.
    """
    spark = docs.sparkSession
    named = settle(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"),
                                F.col(item_text_col).alias("text")), "search-items")
    terms = settle(named.select("item", "text").mapInArrow(_item_terms, "item long, term binary, n long"), "search-terms")
    total = terms.agg(F.sum("n")).first()[0] or 0
    groups = -(-total // group_terms)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = []
    for g in range(groups):
        rows = terms.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g).collect()
        if not rows:
            continue
        plan = make_plan([(r.item, bytes(r.term), r.n) for r in rows])
        counts = (texts.select("text").mapInArrow(_frequencies(spark.sparkContext.broadcast(plan)), "term long, n long")
                  .groupBy("term").agg(F.sum("n").alias("n")).collect())
        shared = spark.sparkContext.broadcast((plan, _weights(plan, counts)))
        found.append(texts.mapInArrow(_search(shared, k), "item long, score long, doc long"))
    if not found:
        return named.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias(id_col),
                            F.lit(0).cast("long").alias("score")).limit(0)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc"))
    top = every.withColumn("rank", place).where(F.col("rank") <= k)
    return top.join(named.select("item", "item_id"), "item").select(
        "item_id", "rank", F.when(F.col("doc") != NO_ID, F.col("doc")).alias(id_col), "score")
