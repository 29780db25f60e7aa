"""Phrase collocations by vertically partitioned suffix trees, cut off at the longest phrase.

1. Blocks of documents send each distinct word of a language once, with its count, to a hash bucket.
   Words below the least count are in no candidate, so suffixes end before them; the others get an
   id. A bucket also packs its words, as prefixes of suffixes, into groups of a bounded number of
   occurrences. A word above that bound is extended by its next word, and so on (only such prefixes
   are counted over again).
2. Pairs of neighbours go the same way, to the group of their first word. Suffixes end before a pair
   below the least count as well, which leaves few of three or more words; blocks deal these to the
   groups.
3. Every group is built by itself: its sorted suffixes of at most five words are the leaves of its
   subtrees, and a phrase's count is the total of the leaves below it.
4. Cuts, scores and the containment test are joins on the counted phrases.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from wearline.llm.blocks import bucket_count, bucket_of, gather, new_block, pack, rejoin, runs, settle_blocks, unpack
from wearline.llm.search import word_array
from wearline.llm.words import Words, find_words, mix, text_bytes, word_hashes
from wearline.session import settle, small_side

LONGEST = 5
#: Occurrences of the words that one group's subtrees are meant to start with.
GROUP_OCCURRENCES = 1 << 21
BLOCK_BYTES = 4 << 20
HOT = -1

#: [.,;:!?] and \x0A-\x0D end a piece; a blank or tab only ends a word.
ENDS = np.array([chr(b) in ".,;:!?" or 0x0A <= b <= 0x0D for b in range(256)])
INSIDE = np.array([not ENDS[b] and b not in (0x20, 0x09) for b in range(256)])


def _hashes(words: pa.Array) -> np.ndarray:
    data, at = text_bytes(words.cast(pa.large_string()))
    return word_hashes(Words(data, at[:-1], at[1:], np.array([0, len(words)])))


BLOCK = "block long, lang string, places binary, breaks binary, cuts binary, sizes binary, counts binary, words binary"


def _to_blocks(buckets: int, block_bytes: int):
    """One row per block and language. places: each word's place among the distinct ones, which go by
    bucket; cuts: buckets and where their words begin."""
    def run(batches):
        for _, texts, langs in gather(batches, block_bytes):
            names, code = np.unique(langs, return_inverse=True)
            for k, lang in enumerate(names.tolist()):
                row = _block(texts.take(pa.array(np.flatnonzero(code == k))), lang, buckets)
                if row:
                    yield pa.RecordBatch.from_pylist([row], schema=BLOCK_SCHEMA)

    return run


BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("lang", pa.string())] + [
    (c, pa.binary()) for c in ("places", "breaks", "cuts", "sizes", "counts", "words")])


def _block(texts: pa.Array, lang: str, buckets: int) -> dict | None:
    words = find_words(texts, INSIDE, lower=True)
    if not len(words.start):
        return None
    passed = np.cumsum(ENDS[words.data], dtype=np.int64)[words.start]
    breaks = np.concatenate([[True], passed[1:] != passed[:-1]])
    breaks[words.doc[:-1][words.doc[:-1] < len(breaks)]] = True
    coded = word_array(words).dictionary_encode()
    index, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    salt = _hashes(pa.array([lang]))[0]
    bucket = bucket_of(mix(_hashes(distinct) ^ salt), buckets)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    cuts = runs(bucket[order])
    sent = distinct.take(pa.array(order))
    data, at = text_bytes(sent.cast(pa.large_string()))
    return {"block": new_block(), "lang": lang, "places": pack(place[index].astype(np.uint32)), "breaks": pack(np.packbits(breaks)),
            "cuts": pack(np.concatenate([bucket[order][cuts[:-1]], cuts]).astype(np.int64)),
            "sizes": pack(np.diff(at).astype(np.int64)),
            "counts": pack(np.bincount(index, minlength=len(order))[order].astype(np.int64)),
            "words": zstandard.ZstdCompressor(level=1).compress(data.tobytes())}


SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("lang", pa.string()), ("sizes", pa.binary()), ("counts", pa.binary()),
                  ("words", pa.binary())])


def _send(batches):
    for batch in batches:
        for row in batch.to_pylist():
            cuts, sizes, counts = unpack(row["cuts"]), unpack(row["sizes"]), unpack(row["counts"])
            n = len(cuts) // 2
            body = zstandard.ZstdDecompressor().decompress(row["words"])
            at = np.concatenate([[0], np.cumsum(sizes)])
            out = []
            for bucket, a, b in zip(cuts[:n].tolist(), cuts[n:-1].tolist(), cuts[n + 1:].tolist()):
                out.append({"bucket": bucket, "block": row["block"], "lang": row["lang"], "sizes": pack(sizes[a:b]), "counts": pack(counts[a:b]),
                            "words": zstandard.ZstdCompressor(level=1).compress(body[at[a]:at[b]])})
            yield pa.RecordBatch.from_pylist(out, schema=SENT)


#: Answers have a block, known words an id, totals a language alone.
ANSWER = "bucket int, block long, ids binary, groups binary, id long, lang string, word string, f long, hot boolean"
ANSWERS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("groups", pa.binary()), ("id", pa.int64()),
                     ("lang", pa.string()), ("word", pa.string()), ("f", pa.int64()), ("hot", pa.bool_())])


def _count_words(least: int, budget: int):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        sizes = [unpack(s.as_py()) for s in table.column("sizes")]
        rows = np.array([len(s) for s in sizes])
        raw = [zstandard.ZstdDecompressor().decompress(w.as_py()) for w in table.column("words")]
        at = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(b"".join(raw))]).dictionary_encode()
        langs = table.column("lang").combine_chunks().dictionary_encode()
        names = langs.dictionary.to_pylist()
        lang_of = np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), rows)
        counts = np.concatenate([unpack(c.as_py()) for c in table.column("counts")])
        keys, which = np.unique(lang_of * len(words.dictionary) + words.indices.to_numpy(zero_copy_only=False), return_inverse=True)
        f = np.zeros(len(keys), np.int64)
        np.add.at(f, which, counts)
        # Ids and groups follow the order of the words, not that of arrival, so a lost task repeats them.
        often = np.flatnonzero(f >= least)
        known = [(names[k // len(words.dictionary)], words.dictionary[k % len(words.dictionary)].as_py()) for k in keys[often].tolist()]
        order = sorted(range(len(known)), key=known.__getitem__)
        known, often = [known[i] for i in order], often[order]
        ids = np.zeros(len(keys), np.int64)
        ids[often] = (bucket << 32) + 1 + np.arange(len(often))
        hot = f[often] > budget
        group = np.zeros(len(keys), np.int64)
        group[often] = np.where(hot, HOT, np.cumsum(np.where(hot, 0, f[often])) // budget)
        out, first = [], 0
        for block, n in zip(table.column("block").to_pylist(), rows.tolist()):
            mine = which[first:first + n]
            first += n
            out.append({"bucket": bucket, "block": block, "ids": pack(ids[mine]), "groups": pack(group[mine])})
        out += [{"bucket": bucket, "id": i, "lang": lang, "word": word, "f": n, "hot": h}
                for i, (lang, word), n, h in zip(ids[often].tolist(), known, f[often].tolist(), hot.tolist())]
        totals = np.zeros(len(names), np.int64)
        np.add.at(totals, keys // len(words.dictionary), f)
        out += [{"bucket": bucket, "lang": lang, "f": n} for lang, n in zip(names, totals.tolist())]
        return pa.Table.from_pylist(out, schema=ANSWERS)

    return run


def _order(codes: np.ndarray) -> np.ndarray:
    """The rows of a matrix of small codes in lexicographic order."""
    wide = [codes[k].astype(np.uint64) << np.uint64(32) | (codes[k + 1].astype(np.uint64) if k + 1 < len(codes) else np.uint64(0))
            for k in range(0, len(codes), 2)]
    return np.lexsort(wide[::-1])


def _changes(codes: np.ndarray) -> np.ndarray:
    """For each depth, whether a sorted row's first depth + 1 codes differ from the row's before."""
    out = np.ones(codes.shape, bool)
    out[:, 1:] = np.logical_or.accumulate(codes[:, 1:] != codes[:, :-1], axis=0)
    return out


def _leaves(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of a (depth, n) matrix, sorted, with the totals of their counts."""
    order = _order(codes)
    codes = codes[:, order]
    first = np.flatnonzero(_changes(codes)[-1]) if codes.shape[1] else np.empty(0, np.int64)
    if not len(first):
        return codes, np.empty(0, np.int64)
    total = np.diff(np.append(first, codes.shape[1])) if counts is None else np.add.reduceat(counts[order], first)
    return codes[:, first], total


class Coded(NamedTuple):
    """A block's words as codes: 0 for unknown ones, else the place in ids."""
    ids: np.ndarray         # ids[0] = 0
    groups: np.ndarray
    word: np.ndarray        # the code of each word
    at: np.ndarray          # words that a known one follows in their piece
    pairs: np.ndarray       # (2, n) codes of the distinct pairs, by group, part and codes
    which: np.ndarray       # the pair that starts at each of at
    counts: np.ndarray
    dealt: tuple            # group and part of each pair


def _coded(row, extended, budget: int) -> Coded:
    answers = row["answers"] or []
    sent = np.concatenate([unpack(a["ids"]) for a in answers])
    known = np.flatnonzero(sent)
    ids = np.concatenate([[0], sent[known]])
    groups = np.concatenate([[0], np.concatenate([unpack(a["groups"]) for a in answers])[known]])
    places = unpack(row["places"])
    breaks = np.unpackbits(unpack(row["breaks"]), count=len(places)).astype(bool)
    code = np.zeros(len(sent), np.int64)
    code[known] = np.arange(1, len(known) + 1)
    word = code[places]
    at = np.flatnonzero((word[:-1] > 0) & (word[1:] > 0) & ~breaks[1:])
    keys, which, counts = np.unique(word[at] * len(ids) + word[at + 1], return_inverse=True, return_counts=True)
    pairs = np.stack([keys // len(ids), keys % len(ids)])
    group, part = _dealt(ids, groups, pairs, extended, budget)
    order = np.lexsort((part, group))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return Coded(ids, groups, word, at, pairs[:, order], place[which], counts[order], (group[order], part[order]))


def _dealt(ids: np.ndarray, groups: np.ndarray, codes: np.ndarray, extended, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Group and part of each suffix: the packed group of its first word, or a part of its longest
    extended prefix, by the word that follows."""
    packed = groups[codes[0]]
    group = (ids[codes[0]] >> 32 << 32) + packed
    part = np.zeros(len(group), np.int64)
    left = np.flatnonzero(packed == HOT)
    for depth, level in enumerate(extended[:len(codes) - 1], 1):
        prefix = ids[codes[:depth, left]]
        at = level.find(prefix)
        left, at, prefix = left[at >= 0], at[at >= 0], prefix[:, at >= 0]
        if not len(left):
            break
        parts = -(-level.counts[at] // budget)
        key = level.key(prefix)
        group[left] = (key >> np.uint64(1)).astype(np.int64)
        part[left] = 1 + (mix(ids[codes[depth, left]].astype(np.uint64) ^ key) % parts.astype(np.uint64)).astype(np.int64)
    return group, part


GROUP = "lang string, grp long, part long, block long, ids binary, codes binary, counts binary"
GROUPS = pa.schema([("lang", pa.string()), ("grp", pa.int64()), ("part", pa.int64()), ("block", pa.int64())]
                   + [(c, pa.binary()) for c in ("ids", "codes", "counts")])


def _groups(row, ids, codes, counts, group, part):
    """One row per group and part, whose suffixes lie together."""
    if not len(counts):
        return
    cuts = np.flatnonzero((np.diff(group) != 0) | (np.diff(part) != 0)) + 1
    out = []
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(counts)]):
        used, local = np.unique(codes[:, a:b], return_inverse=True)
        out.append({"lang": row["lang"], "grp": int(group[a]), "part": int(part[a]), "block": row["block"], "ids": pack(ids[used]),
                    "codes": pack(local.reshape(-1).astype(np.uint32)), "counts": pack(counts[a:b].astype(np.int64))})
    yield pa.RecordBatch.from_pylist(out, schema=GROUPS)


def _received(table: pa.Table, depth: int):
    """All ids of a group's rows, and the rows' codes into them and counts."""
    parts = [(unpack(i.as_py()), unpack(c.as_py()).reshape(depth, -1), unpack(n.as_py()))
             for i, c, n in zip(table.column("ids"), table.column("codes"), table.column("counts"))]
    ids = np.unique(np.concatenate([[0], *(p[0] for p in parts)]))
    return ids, [np.searchsorted(ids, own).astype(np.uint32)[codes] for own, codes, _ in parts], [p[2] for p in parts]


def _pairs(shared, budget: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _coded(row, shared.value, budget)
                yield from _groups(row, block.ids, block.pairs, block.counts, *block.dealt)

    return run


LINK = "block long, grp long, part long, often binary, lang string, phrase array<long>, a long"
LINKS = pa.schema([("block", pa.int64()), ("grp", pa.int64()), ("part", pa.int64()), ("often", pa.binary()), ("lang", pa.string()),
                   ("phrase", pa.list_(pa.int64())), ("a", pa.int64())])


def _count_pairs(least: int):
    """Pairs found often enough, and for each block a bit for every pair that it sent."""
    def run(table: pa.Table) -> pa.Table:
        ids, codes, counts = _received(table, 2)
        key = np.concatenate([c[0].astype(np.int64) * len(ids) + c[1] for c in codes])
        keys, which = np.unique(key, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, which, np.concatenate(counts))
        often = total >= least
        at = np.cumsum([0, *map(len, counts)]).tolist()
        bits = [pack(np.packbits(often[which[a:b]])) for a, b in zip(at[:-1], at[1:])]
        n = int(often.sum())
        pairs = np.stack([ids[keys[often] // len(ids)], ids[keys[often] % len(ids)]], axis=1)
        none = lambda kind, k: pa.nulls(k, kind)
        links = pa.table([table.column("block"), table.column("grp"), table.column("part"), pa.array(bits, pa.binary()),
                          none(pa.string(), len(bits)), none(pa.list_(pa.int64()), len(bits)), none(pa.int64(), len(bits))], schema=LINKS)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 2), pa.array(pairs.reshape(-1).astype(np.int64)))
        found = pa.table([none(pa.int64(), n), none(pa.int64(), n), none(pa.int64(), n), none(pa.binary(), n),
                          pa.array([table.column("lang")[0].as_py()] * n, pa.string()), lists, pa.array(total[often], pa.int64())], schema=LINKS)
        return pa.concat_tables([links, found])

    return run


LEAF = "block long, lang string, ids binary, groups binary, codes binary, counts binary"
LEAVES = pa.schema([("block", pa.int64()), ("lang", pa.string())] + [(c, pa.binary()) for c in ("ids", "groups", "codes", "counts")])


def _suffixes(shared, budget: int):
    """The distinct suffixes of each block with three words or more, cut at five words and where the
    next pair is too rare for a candidate."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _coded(row, shared.value, budget)
                sizes = np.diff(np.flatnonzero(np.concatenate([[True], _steps(*block.dealt), [True]]))) if len(block.counts) else []
                often = [np.unpackbits(unpack(x["often"]), count=n) for x, n in zip(row["links"] or [], sizes)]
                often = np.concatenate(often).astype(bool) if often else np.empty(0, bool)
                linked = np.zeros(len(block.word), bool)
                linked[block.at] = often[block.which]
                codes = np.zeros((LONGEST, len(block.word)), np.uint32)
                codes[0] = block.word
                goes_on = np.ones(len(block.word), bool)
                for k in range(1, LONGEST):
                    goes_on = goes_on[:len(block.word) - k] & linked[k - 1:len(block.word) - 1]
                    codes[k, :len(goes_on)] = np.where(goes_on, block.word[k:], 0)
                codes, counts = _leaves(codes[:, codes[2] > 0])
                if len(counts):
                    used, local = np.unique(codes, return_inverse=True)
                    first = 0 if used[0] == 0 else 1
                    used = used if not first else np.concatenate([[0], used])
                    yield pa.RecordBatch.from_pylist([{
                        "block": row["block"], "lang": row["lang"], "ids": pack(block.ids[used]), "groups": pack(block.groups[used]),
                        "codes": pack((local.reshape(-1) + first).astype(np.uint32)), "counts": pack(counts.astype(np.int64))}], schema=LEAVES)

    return run


def _steps(group: np.ndarray, part: np.ndarray) -> np.ndarray:
    return (np.diff(group) != 0) | (np.diff(part) != 0)


def _unpack_leaves(row):
    counts = unpack(row["counts"])
    return unpack(row["ids"]), unpack(row["codes"]).reshape(LONGEST, -1), counts


class Extended:
    """Prefixes of one length above the budget: sorted ids, found by exact comparison."""

    def __init__(self, prefixes: np.ndarray, counts: np.ndarray):
        keys = self.key(prefixes)
        order = np.argsort(keys, kind="stable")
        self.keys, self.prefixes, self.counts = keys[order], prefixes[:, order], counts[order]

    @staticmethod
    def key(ids: np.ndarray) -> np.ndarray:
        key = np.zeros(ids.shape[1], np.uint64)
        for column in ids:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
        return key

    def find(self, ids: np.ndarray) -> np.ndarray:
        """The position of each prefix, -1 for those that are not extended."""
        if not len(self.keys) or not ids.shape[1]:
            return np.full(ids.shape[1], -1)
        at = np.minimum(np.searchsorted(self.keys, self.key(ids)), len(self.keys) - 1)
        return np.where((self.prefixes[:, at] == ids).all(axis=0), at, -1)


def _prefix_counts(shared, depth: int):
    """Counts of prefixes of depth + 1 words whose first depth words are extended."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, codes, counts = _unpack_leaves(row)
                held = codes[depth] > 0
                prefix = ids[codes[:depth + 1, held]]
                hot = shared.value[depth - 1].find(prefix[:depth]) >= 0
                nodes, total = _leaves(codes[:depth + 1, held][:, hot], counts[held][hot])
                if len(total):
                    flat = pa.array(ids[nodes].T.reshape(-1))
                    at = pa.array(np.arange(len(total) + 1, dtype=np.int32) * (depth + 1))
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(at, flat), pa.array(total)], names=["phrase", "a"])

    return run


def _deal(shared, budget: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, codes, counts = _unpack_leaves(row)
                group, part = _dealt(ids, unpack(row["groups"]), codes, shared.value, budget)
                order = np.lexsort((part, group))
                yield from _groups(row, ids, codes[:, order], counts[order], group[order], part[order])

    return run


PHRASE = pa.schema([("lang", pa.string()), ("phrase", pa.list_(pa.int64())), ("a", pa.int64())])


def _subtrees(shared, least: int):
    """All phrases of three or more words that a group's leaves count often enough."""
    def run(table: pa.Table) -> pa.Table:
        every, codes, counts = _received(table, LONGEST)
        leaves, counts = _leaves(np.concatenate(codes, axis=1), np.concatenate(counts))
        changes = _changes(leaves)
        out = []
        for depth in range(2, LONGEST):
            first = np.flatnonzero(changes[depth])
            total = np.add.reduceat(counts, first)
            often = (total >= least) & (leaves[depth, first] > 0)
            phrases, total = every[leaves[:depth + 1, first[often]]], total[often]
            # A prefix that was dealt over several parts is counted whole elsewhere.
            if depth < len(shared.value):
                whole = shared.value[depth].find(phrases) < 0
                phrases, total = phrases[:, whole], total[whole]
            at = pa.array(np.arange(len(total) + 1, dtype=np.int32) * (depth + 1))
            out.append(pa.table([pa.array([table.column("lang")[0].as_py()] * len(total), pa.string()),
                                 pa.ListArray.from_arrays(at, pa.array(phrases.T.reshape(-1).astype(np.int64))), pa.array(total, pa.int64())], schema=PHRASE))
        return pa.concat_tables(out)

    return run


def count_phrases(docs: DataFrame, least: int = 100, budget: int = GROUP_OCCURRENCES, text_col: str = "text",
                  lang_col: str = "lang", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, totals): lang, phrase (ids), a of all phrases of 2 to 5 words found least times or
    more; id, lang, word, f of such words; lang, n (all word occurrences).

    The prefixes that are extended, and so sent to all tasks, each occur more than budget times, which
    bounds their number by five times the words of the corpus over budget.
    """
    spark = docs.sparkSession
    texts = docs.select(F.lit(0).cast("long").alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    buckets = bucket_count(texts, "text", 1 / 40)
    blocks = settle_blocks(texts.mapInArrow(_to_blocks(buckets, block_bytes), BLOCK), "phrase_blocks")
    sent = "bucket int, block long, lang string, sizes binary, counts binary, words binary"
    answers = settle(blocks.select("block", "lang", "cuts", "sizes", "counts", "words").mapInArrow(_send, sent)
                     .groupBy("bucket").applyInArrow(_count_words(least, budget), ANSWER), "phrase-words")
    words = answers.where("id is not null").select("id", "lang", "word", "f", "hot")
    totals = answers.where("id is null and block is null").groupBy("lang").agg(F.sum("f").alias("n"))
    coded = rejoin(blocks.select("block", "lang", "places", "breaks"), answers.where("block is not null").select("bucket", "block", "ids", "groups"),
                   ["ids", "groups"])
    hot = words.where("hot").select(F.array("id").alias("phrase"), F.col("f").alias("a")).collect()
    extended = [_extended(hot, 1)]
    shared = spark.sparkContext.broadcast(list(extended))
    links = settle(coded.mapInArrow(_pairs(shared, budget), GROUP).groupBy("lang", "grp", "part").applyInArrow(_count_pairs(least), LINK), "phrase-pairs")
    by_block = links.where("block is not null").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("grp", "part", "often"))).alias("links"))
    leaves = settle(coded.join(by_block, "block", "left").mapInArrow(_suffixes(shared, budget), LEAF), "phrase-leaves")
    pairs = links.where("block is null").select("lang", "phrase", "a")
    counted = [pairs]
    for depth in range(2, LONGEST):
        if depth == 2:
            more = pairs.where(F.col("a") > budget).select("phrase", "a")
        else:
            shared = spark.sparkContext.broadcast(list(extended))
            more = (leaves.select("ids", "codes", "counts").mapInArrow(_prefix_counts(shared, depth - 1), "phrase array<long>, a long")
                    .groupBy("phrase").agg(F.sum("a").alias("a")).where(F.col("a") > budget))
        hot = more.collect() if hot else []
        extended.append(_extended(hot, depth))
        if hot and depth > 2:
            whole = spark.createDataFrame([(list(r.phrase), r.a) for r in hot], "phrase array<long>, a long")
            counted.append(whole.join(words.select("lang", "id"), F.col("phrase")[0] == F.col("id")).select("lang", "phrase", "a"))
    shared = spark.sparkContext.broadcast(extended)
    phrases = (leaves.mapInArrow(_deal(shared, budget), GROUP).groupBy("lang", "grp", "part")
               .applyInArrow(_subtrees(shared, least), "lang string, phrase array<long>, a long"))
    return settle(reduce(DataFrame.unionByName, counted, phrases), "phrases"), words.drop("hot"), totals


def _extended(rows, depth: int) -> Extended:
    return Extended(np.array([r.phrase for r in rows], np.int64).reshape(-1, depth).T, np.array([r.a for r in rows], np.int64))


def _exact(column: Column) -> Column:
    return column.cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, budget: int = GROUP_OCCURRENCES, text_col: str = "text",
                 lang_col: str = "lang", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the top phrases of each language.

    A phrase's score is the least of floor(1000 a n / (l r)) over its cuts, the first cut of equals.
    Phrases inside a longer candidate that is found as often are dropped. Null texts are empty, a null
    language is und, together with any that is named so. Repeated rows count as often as they stand.
    An empty table, or one without a candidate, gives no rows. Other columns are not read.
    """
    phrases, words, totals = count_phrases(docs, least, budget, text_col, lang_col, block_bytes)
    counts = phrases.select("phrase", "a").unionByName(words.select(F.array("id").alias("phrase"), F.col("f").alias("a")))
    # A longer phrase as frequent as a part of it is so at every length between, so one word more tells.
    inner = F.explode(F.array(F.expr("slice(phrase, 1, size(phrase) - 1)"), F.expr("slice(phrase, 2, size(phrase) - 1)")))
    covered = phrases.where(F.size("phrase") > 2).select(inner.alias("phrase"), "a").groupBy("phrase").agg(F.max("a").alias("longer"))
    cuts = (phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)))
            .withColumn("head", F.expr("slice(phrase, 1, k)")).withColumn("rest", F.expr("slice(phrase, k + 1, size(phrase) - k)")))
    cuts = (cuts.join(counts.select(F.col("phrase").alias("head"), F.col("a").alias("l")), "head")
            .join(counts.select(F.col("phrase").alias("rest"), F.col("a").alias("r")), "rest")
            .join(small_side(totals), "lang")
            .withColumn("over", _exact(F.col("a")) * _exact(F.col("n")) * F.lit(1000).cast("decimal(4,0)"))
            .withColumn("under", _exact(F.col("l")) * _exact(F.col("r")))
            .withColumn("score", F.expr("over div under")))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    kept = (best.join(covered, "phrase", "left").where(F.coalesce(F.col("longer") < F.col("a"), F.lit(True)))
            .select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score"))
    by_lang = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = kept.withColumn("place", F.rank().over(by_lang)).where(F.col("place") <= top).drop("place")
    spelled = (first.select("phrase", F.posexplode("phrase").alias("at", "id")).join(words.select("id", "word"), "id")
               .groupBy("phrase").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("text")))
    named = first.join(spelled, "phrase").drop("phrase").withColumnRenamed("text", "phrase")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return named.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
