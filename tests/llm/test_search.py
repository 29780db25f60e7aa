import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from wearline.llm import search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_words = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    out = []
    for item, text in items:
        scores = []
        for i, bag, n in bags:
            score = 0
            for t in terms(text):
                if bag[t]:
                    df = sum(1 for _, b, _ in bags if b[t])
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * (25 + 75 * n * n_docs // n_words)))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def corpus():
    rnd = random.Random(4)
    some = ["the", "of", "Zürich", "ÉCOLE", "x1", "日本", "CAT", "cat", "a", "rare"] + [f"w{i}" for i in range(30)]
    text = lambda n: rnd.choice([" ", "-", "_", "\n"]).join(rnd.choices(some, k=rnd.randint(0, n)))
    docs = [(i, text(40)) for i in range(60)] + [(100, "the cat"), (101, "the cat"), (101, "the cat"), (None, "the cat rare"), (102, None),
                                                  (103, ""), (104, "!?"), (105, "the " * 30_000 + "cat")]
    items = [(i, text(25)) for i in range(25)] + [(30, None), (31, ""), (32, "unknown"), (33, "the the the cat"), (33, "the the the cat"), (None, "rare cat")]
    return docs, items


@pytest.mark.parametrize("group_terms, cells", [(1 << 20, 1 << 22), (60, 100)])
def test_equals_brute_force(spark, monkeypatch, group_terms, cells):
    monkeypatch.setattr(search, "CELLS", cells)
    docs, items = corpus()
    d = spark.createDataFrame([(*x, 7) for x in docs], "doc_id long, text string, score int").repartition(3)
    b = spark.createDataFrame([(*x, 8) for x in items], "item_id long, text string, term int")
    out = search.rank_documents(d, b, k=5, group_terms=group_terms)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(docs, items, 5)


def test_plan_shares_and_keeps_sums():
    rnd = random.Random(5)
    rows = [(i, f"t{t}".encode(), n) for i in range(40) for t, n in Counter(rnd.choices(range(20), k=15)).items()]
    plan = search.make_plan(rows)
    value = np.array(rnd.choices(range(100), k=len(plan.terms)) + [0] * (plan.nodes - len(plan.terms)))
    weight = dict(zip(plan.terms, value.tolist()))
    for node, left, right in plan.steps:
        value[node] = value[left] + value[right]
    ends = [*plan.starts[1:].tolist(), len(plan.sequence)]
    for item, a, b in zip(plan.items.tolist(), plan.starts.tolist(), ends):
        assert value[plan.sequence[a:b]].sum() == sum(weight[t] * n for i, t, n in rows if i == item)
    asked = sum(n for _, _, n in rows)
    assert len(plan.sequence) + plan.nodes - len(plan.terms) < asked
    assert search.make_plan([(1, b"a", 5)]).nodes >= 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search.rank_documents(docs, items).collect() == []
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    out = search.rank_documents(some, items.limit(0))
    assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]
