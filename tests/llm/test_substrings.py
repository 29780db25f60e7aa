import hashlib
import random
import re

import numpy as np
import pytest

from wearline.llm import blocks, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    first, out = {}, []
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    for i, w in split:
        gone = set()
        for k in range(len(w) - width + 1):
            least = first.get(tuple(w[k:k + width]))
            if least is not None and (i is None or least < i):
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def corpus():
    rnd = random.Random(2)
    some = ["a", "bé", "c", "Dd", "e"]
    passages = [rnd.choices(some, k=rnd.randint(5, 30)) for _ in range(6)]
    rows = []
    for i in range(150):
        body = rnd.choices(some, k=rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(body))
            body[at:at] = rnd.choice(passages)
        rows.append((i * 3, rnd.choice([" ", "\n", "  ", "  "]).join(body)))
    rows += [(1000, None), (1001, ""), (1002, " \t "), (1003, rows[5][1]), (1003, rows[5][1]), (-4, rows[5][1]),
             (None, rows[5][1]), (None, rows[7][1]), (2000, "a " * 30000), (2001, "x" * 100000)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_bytes", [8 << 20, 900])
def test_equals_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(blocks, "BUCKET_ENTRIES", 1000)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, block string").repartition(3)
    got = substrings.remove_repeats(docs, width=8, block_bytes=block_bytes).collect()
    key = lambda r: (str(r[0]), r[4], r[2])
    want = sorted(brute(rows, 8), key=key)
    mine = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got), key=key)
    assert mine == want
    assert all(sum(s.end - s.start for s in r.removed) == r.n_removed for r in got)
    assert sum(r[2] > 0 for r in want) > 20


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, ids int")
    assert substrings.remove_repeats(none).count() == 0


@pytest.mark.parametrize("kind", ["<u8", "<i4", "<u2", "|u1", "<f4"])
def test_pack(kind):
    for n in (0, 1, 1000):
        a = np.arange(n).astype(kind)
        assert np.array_equal(blocks.unpack(blocks.pack(a)), a)
