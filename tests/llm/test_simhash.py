import random
import re

import numpy as np
import pytest
import xxhash

from wearline.llm import simhash
from wearline.llm.links import components


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(ids, prints, bits=3):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= bits:
                root[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for i, p in zip(ids, prints):
        low[find(p)] = min(low.get(find(p), i), i)
    return [low[find(p)] for p in prints]


def corpus():
    rnd = random.Random(3)
    words = ["Alpha", "be", "ça", "delta", "e", "fox", "gé", "hat", "is", "jay"]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 300))) for _ in range(60)]
    for _ in range(60):
        base = rnd.choice(texts).split()
        if base:
            base[rnd.randrange(len(base))] = rnd.choice(words)
        texts.append(" \n".join(base))
    return texts + ["", "   ", None, "one", "ONE", "two words", texts[0], texts[0], "x" * 50000, "a b " * 20000]


def test_groups_equal_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "noise") for i, t in enumerate(texts)],
                                 "doc_id long, text string, fp string").repartition(3)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [brute_print(t) for t in texts]
    assert [int(got[i].fingerprint, 16) for i in range(len(texts))] == prints
    assert all(len(r.fingerprint) == 16 for r in got.values())
    assert [got[i].component_id for i in range(len(texts))] == brute_groups(range(len(texts)), prints)


@pytest.mark.parametrize("pairwise", [4096, 10])
def test_blocks_lose_no_link(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rnd = random.Random(5)
    seeds = [rnd.getrandbits(64) for _ in range(12)]
    prints = sorted({s ^ sum({1 << rnd.randrange(64) for _ in range(rnd.randint(0, 4))}) for s in seeds for _ in range(25)})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 3)
    root = {r.node % 2 ** 64: r.root for r in components(links).collect()}
    want = brute_groups(prints, prints)
    groups = {}
    for p, w in zip(prints, want):
        groups.setdefault(w, set()).add(root.get(p, p if p < 2 ** 63 else p - 2 ** 64))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_flip_search_equals_pairs():
    rnd = np.random.default_rng(1)
    mask = simhash.block_masks(3, 6)[4]
    free = [b for b in range(64) if not mask >> b & 1]
    base = np.array([sum(1 << int(b) for b in rnd.choice(free, rnd.integers(0, 9), replace=False)) for _ in range(120)], np.uint64)
    prints = np.unique(base | np.uint64(mask))
    pairs = simhash.local_groups(prints, mask, 3)
    simhash.PAIRWISE, kept = 0, simhash.PAIRWISE
    try:
        assert np.array_equal(simhash.local_groups(prints, mask, 3), pairs)
    finally:
        simhash.PAIRWISE = kept


def test_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 40)], "a long, b long")
    assert {r.root for r in components(chain).collect()} == {1}


def test_edges(spark):
    schema = "doc_id long, text string, row string, rank int"
    empty = spark.createDataFrame([], schema)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    rows = [(1, "a b c", "r", 1), (1, "a b c", "r", 1), (2, "a b c", None, None), (None, "a b c", "s", 1),
            (4, None, "t", 2), (5, "", "u", 2), (6, "other words here now", "v", 3)]
    kept = simhash.keep_one(spark.createDataFrame(rows, schema))
    assert kept.columns == ["doc_id", "text", "row", "rank"]
    assert sorted((r.doc_id or 0, r.row) for r in kept.collect()) == [(0, "s"), (1, "r"), (4, "t"), (6, "v")]


def test_one_id_on_unrelated_texts(spark):
    one, two = "alpha beta gamma delta epsilon", "zeta eta theta iota kappa"
    rows = [(1, one), (1, one), (2, one), (3, two), (5, two), (3, "a first text of its own"), (0, "a first text of its own"),
            (1, "other words stand here now")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(0, "a first text of its own"), (1, one), (1, "other words stand here now"), (3, two)]
