"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, linked groups."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from wearline.llm.links import components
from wearline.llm.words import LOWER, SPACED, find_words, pieces
from wearline.session import settle

SEED = 42
BITS = 64
#: The fingerprint is cut into this many parts; any two fingerprints within max_bits share
#: PARTS - max_bits of them.
PARTS = 6
#: Up to this many fingerprints of one block are compared pair by pair; beyond it, neighbours are
#: looked up by flipping bits, whose cost grows in proportion to the block.
PAIRWISE = 4096


def fingerprint(words: list[bytes], shingle: int) -> int:
    """One text's SimHash as an unsigned number; 0 without words."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    if len(words) <= shingle:
        spans = [(0, len(joined))]
    else:
        spans = zip(starts, ends[shingle - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = hashes[first:first + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist())


def fingerprint_column(text, shingle: int = 3):
    """The fingerprint of each text as a signed long (the same 64 bits)."""
    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), np.uint64)
        for first, part in pieces(texts):
            words = find_words(part, SPACED)
            data = LOWER[words.data].tobytes()
            spans = list(zip(words.start.tolist(), words.end.tolist()))
            doc = words.doc.tolist()
            for i in range(len(part)):
                out[first + i] = fingerprint([data[a:b] for a, b in spans[doc[i]:doc[i + 1]]], shingle)
        return pa.array(out.view(np.int64))

    return run(text)


def block_masks(max_bits: int, parts: int) -> list[int]:
    """The bits that are compared in each block table."""
    edges = np.linspace(0, BITS, parts + 1).round().astype(int).tolist()
    cells = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(kept) for kept in combinations(cells, parts - max_bits)]


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of i[k] and j[k] for every k; a label is the smallest index of its set."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return
        i, j = i[open_], j[open_]
        np.minimum.at(label, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
        while not np.array_equal(label, label[label]):
            label[:] = label[label]


def local_groups(prints: np.ndarray, mask: int, max_bits: int) -> np.ndarray:
    """For sorted distinct fingerprints of one block, the index of the smallest of each group."""
    label = np.arange(len(prints))
    if len(prints) <= PAIRWISE:
        for first in range(0, len(prints), 512):
            near = np.bitwise_count(prints[first:first + 512, None] ^ prints[None, :]) <= max_bits
            i, j = np.nonzero(near)
            _unite(label, i + first, j)
        return label
    free = [1 << b for b in range(BITS) if not mask >> b & 1]
    here = np.arange(len(prints))
    for n in range(1, max_bits + 1):
        for flipped in combinations(free, n):
            wanted = prints ^ np.uint64(sum(flipped))
            at = np.minimum(np.searchsorted(prints, wanted), len(prints) - 1)
            found = prints[at] == wanted
            if found.any():
                _unite(label, here[found], at[found])
    return label


def _links_of(prints: np.ndarray, mask: int, max_bits: int):
    prints = np.unique(prints)
    root = prints[local_groups(prints, mask, max_bits)]
    moved = root != prints
    return prints[moved], root[moved]


def near_links(prints: DataFrame, max_bits: int = 3, parts: int = PARTS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) within max_bits.

    Every block is walked as sorted rows of its partition. It gives one link for each fingerprint
    and the smallest of its local group, never all pairs.
    """
    masks = block_masks(max_bits, parts)
    tables = F.explode(F.array(*[F.struct(F.lit(k).alias("table"), F.col("fp").bitwiseAND(
        F.lit(m - (1 << 64) if m >> 63 else m)).alias("key")) for k, m in enumerate(masks)])).alias("b")
    dealt = (prints.select("fp", tables).select("b.table", "b.key", "fp")
             .repartition("table", "key").sortWithinPartitions("table", "key"))

    def walk(batches):
        held: list = []

        def flush():
            if not held:
                return
            table, mine = held[0][0], np.concatenate([p for _, p in held])
            held.clear()
            if len(mine) > 1:
                a, b = _links_of(mine, masks[table], max_bits)
                if len(a):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        last = None
        for batch in batches:
            table = batch.column(0).to_numpy(zero_copy_only=False)
            key = batch.column(1).to_numpy(zero_copy_only=False)
            fp = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(fp):
                continue
            new = np.flatnonzero((table[1:] != table[:-1]) | (key[1:] != key[:-1])) + 1
            cuts = [0, *new.tolist(), len(fp)]
            if last != (table[0], key[0]):
                yield from flush()
            for first, end in zip(cuts, cuts[1:]):
                if first:
                    yield from flush()
                    if end - first == 1 and end < len(fp):
                        continue
                held.append((int(table[first]), fp[first:end].copy()))
            last = (table[-1], key[-1])
        yield from flush()

    return dealt.mapInArrow(walk, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per input row: id, fingerprint (hex), component_id, group_print.

    component_id is the smallest id among all rows reachable by links of at most max_bits;
    group_print names the group itself. A null text counts as empty, a text without words has
    fingerprint zero. A null id takes part in links but is never a component_id unless a group has
    no other. Repeated rows give repeated rows; an empty table gives none. Other columns are ignored.
    """
    prints = settle(docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp")),
                    "simhash")
    return _grouped(prints, id_col, max_bits)


def _grouped(prints: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """near_duplicates for settled rows (id, fp)."""
    distinct = prints.groupBy("fp").agg(F.min("id").alias("first_id"))
    links = settle(near_links(distinct.select("fp"), max_bits), "simhash-links")
    roots = components(links)
    members = (distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
               .withColumn("root", F.coalesce("root", "fp")))
    firsts = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = members.join(firsts, "root").select("fp", "root", "component_id")
    hexed = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return prints.join(groups, "fp").select(
        F.col("id").alias(id_col), hexed("fp").alias("fingerprint"), "component_id",
        hexed("root").alias("group_print"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The documents with one row of each near-duplicate group: that with the smallest id.

    An id that stands on unrelated texts is judged in each of their groups. Ties, as between
    repeated rows, go to the smallest text and then to any one of equal rows. A row without an id cannot be told from others like it and stays.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    printed = settle(docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp"), row.alias("row")),
                     "simhash-rows")
    groups = _grouped(printed.select("id", "fp"), id_col, max_bits)
    kept = (groups.where(F.col(id_col) == F.col("component_id"))
            .select(F.col(id_col).alias("kept_id"), F.col("fingerprint").alias("kept_print"), "group_print").distinct())
    mine = printed.where("id is not null").withColumn("print", F.lower(F.lpad(F.hex("fp"), 16, "0")))
    once = Window.partitionBy("group_print").orderBy(F.col("row").getField(text_col).asc_nulls_last())
    chosen = (mine.join(kept, (F.col("id") == F.col("kept_id")) & (F.col("print") == F.col("kept_print")))
              .withColumn("rank", F.row_number().over(once)).where("rank = 1").select("row.*"))
    return chosen.unionByName(printed.where("id is null").select("row.*"))
