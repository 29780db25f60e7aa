"""Benchmark decontamination by winnowing: minimum k-gram hashes, joined, then extended."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wearline.llm.words import ALPHANUMERIC, find_words, pieces, window_hashes, window_starts, word_hashes

SPAN = 10
GRAM = 5
#: A benchmark of up to this many bytes is sent to every executor; a larger one is joined.
INDEX_BYTES = 16 << 20


def winnow(hashes: np.ndarray, left: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """Positions and hashes of the k-grams that are the smallest of some window of span words.

    left[i]: words from i to the end of its text. Two texts that share span words in a row keep the
    same k-grams of them, so they have a kept k-gram in common. Equal minima are all kept.
    """
    n, per = len(hashes), span - gram + 1
    top = np.uint64(2 ** 64 - 1)
    if n < span:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = np.full(n, top)
    starts = np.flatnonzero(left >= gram)
    grams[starts] = window_hashes(hashes, starts, gram)
    low = grams.copy()
    for j in range(1, per):
        np.minimum(low[:n - j], grams[j:], out=low[:n - j])
    low[left < span] = 0
    high = low.copy()
    for j in range(1, per):
        np.maximum(high[j:], low[:n - j], out=high[j:])
    kept = np.flatnonzero((high == grams) & (left >= gram))
    return kept, grams[kept]


def _left(words) -> np.ndarray:
    return np.repeat(words.doc[1:], words.counts) - np.arange(len(words.start))


class Index:
    """Fingerprints and words of benchmark items."""

    def __init__(self, ids: list, texts: list, span: int = SPAN, gram: int = GRAM):
        words = find_words(pa.array(texts, pa.large_string()), ALPHANUMERIC, lower=True)
        hashes = word_hashes(words)
        self.span, self.gram = span, gram
        self.ids = ids
        self.items = [hashes[a:b] for a, b in zip(words.doc[:-1], words.doc[1:])]
        owner, left = words.doc_of(), _left(words)
        at, prints = winnow(hashes, left, span, gram)
        order = np.argsort(prints, kind="stable")
        self.prints, self.item = prints[order], owner[at][order]
        self.place = (at - words.doc[owner[at]])[order]
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.prints >> np.uint64(48)).astype(np.int64)] = True
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, item in enumerate(self.items):
            if 0 < len(item) < span:
                self.short[len(item)][int(window_hashes(item, np.array([0]), len(item))[0])].append(k)

    def search(self, words):
        """For a batch: a mask of hit words, and the set of items hit for each text."""
        hashes = word_hashes(words)
        hit = np.zeros(len(hashes), bool)
        found: dict[int, set] = defaultdict(set)
        if not len(hashes):
            return hit, found
        left, owner = _left(words), words.doc_of()
        at, prints = winnow(hashes, left, self.span, self.gram)
        near = self.seen[(prints >> np.uint64(48)).astype(np.int64)]
        at, prints = at[near], prints[near]
        first = np.searchsorted(self.prints, prints, "left")
        last = np.searchsorted(self.prints, prints, "right")
        lines = set()
        for p, a, b in zip(at[first < last].tolist(), first[first < last].tolist(), last[first < last].tolist()):
            lines.update((p - q, k, int(owner[p])) for q, k in zip(self.place[a:b].tolist(), self.item[a:b].tolist()))
        for shift, k, doc in lines:
            item = self.items[k]
            low = max(int(words.doc[doc]), shift)
            high = min(int(words.doc[doc + 1]), shift + len(item))
            same = hashes[low:high] == item[low - shift:high - shift]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]])))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if b - a >= self.span:
                    hit[low + a:low + b] = True
                    found[doc].add(k)
        for width, table in self.short.items():
            starts = window_starts(words, width)
            here = window_hashes(hashes, starts, width)
            for i in np.flatnonzero(np.isin(here, np.array(list(table), np.uint64))).tolist():
                p = int(starts[i])
                hit[p:p + width] = True
                found[int(owner[p])].update(table[int(here[i])])
        return hit, found


RESULT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))])


def _hits(texts: pa.Array, index: Index) -> pa.Array:
    out = []
    for _, part in pieces(texts):
        words = find_words(part, ALPHANUMERIC, lower=True)
        hit, found = index.search(words)
        before = np.concatenate([[0], np.cumsum(hit)])
        totals = before[words.doc[1:]] - before[words.doc[:-1]]
        out += [{"n_words": n, "n_hit": h, "items": sorted({index.ids[k] for k in found.get(i, ())})}
                for i, (n, h) in enumerate(zip(words.counts.tolist(), totals.tolist()))]
    return pa.array(out, RESULT)


def _broadcast_hits(docs: DataFrame, rows: list, text, span: int, gram: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))
    kept: dict = {}

    @F.arrow_udf("struct<n_words:long,n_hit:long,items:array<string>>")
    def run(texts: pa.Array) -> pa.Array:
        if "index" not in kept:
            kept["index"] = Index(*shared.value, span, gram)
        return _hits(texts, kept["index"])

    return docs.withColumn("_hits", run(text))


def _prints_of(rows: DataFrame, span: int, gram: int) -> DataFrame:
    """(key, fp) of every kept k-gram of rows (key, text), and of every whole item shorter than span."""
    def run(batches):
        for batch in batches:
            for first, part in pieces(batch.column(1)):
                words = find_words(part, ALPHANUMERIC, lower=True)
                hashes = word_hashes(words)
                at, prints = winnow(hashes, _left(words), span, gram)
                keys = batch.column(0).slice(first, len(part))
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(words.doc_of()[at])), pa.array(prints.view(np.int64))], names=["key", "fp"])

    return rows.mapInArrow(run, "key string, fp long").distinct()


def _windows_of(rows: DataFrame, widths: list[int], whole: bool) -> DataFrame:
    """(key, fp) of every window of each width, or only of texts that are one such window."""
    def run(batches):
        for batch in batches:
            for first, part in pieces(batch.column(1)):
                words = find_words(part, ALPHANUMERIC, lower=True)
                hashes, owner = word_hashes(words), words.doc_of()
                keys = batch.column(0).slice(first, len(part))
                for width in widths:
                    starts = window_starts(words, width)
                    if whole and len(starts):
                        starts = starts[words.counts[owner[starts]] == width]
                    prints = window_hashes(hashes, starts, width)
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(owner[starts])), pa.array(prints.view(np.int64))], names=["key", "fp"])

    return rows.mapInArrow(run, "key string, fp long").distinct()


def _joined_hits(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, span: int, gram: int) -> DataFrame:
    """The same result by joining fingerprints, for a benchmark too large to send around."""
    key = F.xxhash64(F.col(id_col), F.col(text_col)).cast("string")
    texts = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    short = list(range(1, span))
    pairs = (_prints_of(texts, span, gram).toDF("key", "fp").join(_prints_of(items, span, gram).toDF("item", "fp"), "fp")
             .union(_windows_of(texts, short, False).toDF("key", "fp")
                    .join(_windows_of(items, short, True).toDF("item", "fp"), "fp"))
             .select("key", "item").distinct())

    @F.arrow_udf("array<struct<a:int,b:int>>")
    def spans(doc_texts: pa.Array, item_texts: pa.Array) -> pa.Array:
        out = []
        for doc, item in zip(doc_texts, item_texts):
            index = Index([""], [item.as_py()], span, gram)
            hit, _ = index.search(find_words(pa.array([doc.as_py()], pa.large_string()), ALPHANUMERIC, lower=True))
            edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]))).tolist()
            out.append([{"a": a, "b": b} for a, b in zip(edges[::2], edges[1::2])])
        return pa.array(out, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))

    once = texts.dropDuplicates(["key"])
    found = (pairs.join(once, "key").join(items.toDF("item", "item_text"), "item")
             .withColumn("spans", spans("text", "item_text")).where("size(spans) > 0")
             .groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                 F.sort_array(F.collect_set("item")).alias("items")))

    @F.arrow_udf("struct<n_words:long,n_hit:long>")
    def counted(doc_texts: pa.Array, all_spans: pa.Array) -> pa.Array:
        out = []
        for first, part in pieces(doc_texts):
            words = find_words(part, ALPHANUMERIC, lower=True)
            for n, some in zip(words.counts.tolist(), all_spans.slice(first, len(part)).to_pylist()):
                hit = np.zeros(n, bool)
                for x in some or ():
                    hit[x["a"]:x["b"]] = True
                out.append({"n_words": n, "n_hit": int(hit.sum())})
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64())]))

    named = docs.withColumn("_key", key).join(found.toDF("_key", "_spans", "_items"), "_key", "left")
    return (named.withColumn("_n", counted(F.col(text_col), F.col("_spans")))
            .withColumn("_hits", F.struct("_n.n_words", "_n.n_hit", F.coalesce(
                "_items", F.array().cast("array<string>")).alias("items")))
            .drop("_key", "_spans", "_items", "_n"))


def with_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", span: int = SPAN, gram: int = GRAM,
              index_bytes: int = INDEX_BYTES) -> DataFrame:
    """docs with a column _hits: struct of n_words, n_hit and items (sorted ids, as strings).

    A word is hit if it lies in span consecutive words that also stand in a benchmark item, or in a
    whole item of fewer words. Null and empty texts have no words; an item without words is never
    found; an item without an id is called "null". Repeated rows are judged each; empty tables give
    no rows or no hits. Other columns stay.
    """
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("key"),
                             F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    weight = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    if weight <= index_bytes:
        return _broadcast_hits(docs, items.collect(), F.col(text_col), span, gram)
    return _joined_hits(docs, items, id_col, text_col, span, gram)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit word."""
    return with_hits(docs, benchmark, **options).where("_hits.n_hit = 0").drop("_hits")
