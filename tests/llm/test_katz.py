import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wearline.llm import katz

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


class Model:
    """Plain dictionaries, for comparison."""

    def __init__(self, texts):
        self.c, self.pairs = Counter(), defaultdict(Counter)
        for t in texts:
            last = "<start>"
            for w in tokens(t):
                self.c[w] += 1
                self.pairs[last][w] += 1
                last = w
        self.n, self.v = sum(self.c.values()), len(self.c)
        size = lambda counts: [sum(x == r for x in counts) for r in range(1, 7)]
        n1 = size(self.c.values())
        self.d1 = katz.good_turing(n1)
        self.d2 = katz.good_turing(size([x for f in self.pairs.values() for x in f.values()]))
        left = sum((1 - self.d1[r]) * r * n1[r - 1] for r in range(1, 6))
        self.base = self.n if left > 0 else self.n + 1
        self.unknown = (left if left > 0 else 1) / self.base

    def one(self, w):
        c = self.c[w]
        return (self.d1[c] if c <= 5 else 1) * c / self.base if c else self.unknown

    def two(self, h, w):
        f = self.pairs.get(h)
        if not f:
            return self.one(w)
        kept = sum((self.d2[x] if x <= 5 else 1) * x for x in f.values())
        left = sum(f.values()) - kept
        left = left if left > 1e-9 else 1.0
        if f[w]:
            return (self.d2[f[w]] if f[w] <= 5 else 1) * f[w] / (kept + left)
        return left / (kept + left) / (1 - sum(self.one(x) for x in f if f[x])) * self.one(w)

    def score(self, text):
        total, last = 0.0, "<start>"
        for w in tokens(text):
            total += math.log10(self.two(last, w))
            last = w
        return total


def corpus():
    rnd = random.Random(12)
    some = [f"w{i}" for i in range(60)] + ["É"]
    weights = [1 / (i + 1) for i in range(61)]
    texts = [" ".join(rnd.choices(some, weights, k=rnd.randint(0, 60))) for _ in range(120)]
    texts += [f"rare{i} The THE w1" for i in range(12)]
    return texts + [None, "", " \n", "w0 " * 5000, texts[0], texts[0], "never seen words", "x" * 30000]


@pytest.mark.parametrize("split,block_bytes", [(1 << 20, 8 << 20), (40, 2000)])
def test_equals_dictionaries(spark, split, block_bytes):
    texts = corpus()
    rows = [(i, t, i % 7 != 2 and i < len(texts) - 2, "k") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean, block string").repartition(3)
    model = Model([t for _, t, learn, _ in rows if learn])
    out = katz.score_documents(docs, train=F.col("learn"), split=split, block_bytes=block_bytes).collect()
    assert len(out) == len(texts)
    for r in out:
        t = texts[r.doc_id]
        w = tokens(t)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.train) == (
            len(w), sum(model.c[x] > 0 for x in w), model.n, rows[r.doc_id][2])
        base = sum(math.log10((model.c[x] + 1) / (model.n + model.v + 1)) for x in w)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(model.score(t), rel=1e-7), t


def test_plain_model_is_normalised():
    model = Model(corpus())
    for h in ("w0", "w3", "<start>", "rare1", "unheard"):
        assert sum(model.two(h, w) for w in [*model.c, "unheard"]) == pytest.approx(1, abs=1e-9)


def test_edges(spark):
    schema = "doc_id long, text string, train string"
    assert katz.score_documents(spark.createDataFrame([], schema)).count() == 0
    rows = spark.createDataFrame([(1, "a b", "x"), (None, None, None)], schema)
    out = katz.score_documents(rows, train=F.lit(False)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.score, r.base_score) for r in out) == [(0, 1, 0, 0, 0), (1, 3, 0, 0, 0)]
