import random
import re

import pytest
from pyspark.sql import functions as F

from wearline.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for key, item in items:
            v = words(item)
            size = min(10, len(v))
            if not size:
                continue
            windows = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)}
            for p in range(len(w) - size + 1):
                if tuple(w[p:p + size]) in windows:
                    hit.update(range(p, p + size))
                    found.add(str(key))
        out.append((len(w), len(hit), sorted(found)))
    return out


def corpus():
    rnd = random.Random(8)
    some = ["the", "cat", "Éa", "x1", "dog", "of", "on", "ñu"]
    items = [(i, " ".join(rnd.choices(some, k=rnd.choice([1, 3, 8, 9, 10, 11, 25, 60])))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "--- !"), (93, items[3][1])]
    texts = []
    for _ in range(60):
        body = rnd.choices(some, k=rnd.randint(0, 80))
        v = words(rnd.choice(items)[1])
        if v:
            a = rnd.randrange(len(v))
            body[5:5] = v[a:a + rnd.randint(5, 30)]
        texts.append(rnd.choice([" ", ", ", "\n"]).join(body).upper() if rnd.random() < .2 else " - ".join(body))
    return texts + [None, "", " ", "the " * 30000, texts[0], texts[0]], items


@pytest.mark.parametrize("index_bytes", [1 << 20, 0])
def test_equals_brute_force(spark, index_bytes):
    texts, items = corpus()
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, fp int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r._hits for r in decontaminate.with_hits(docs, bench, index_bytes=index_bytes).collect()}
    want = brute(texts, items)
    assert [(got[i].n_words, got[i].n_hit, got[i]["items"]) for i in range(len(texts))] == want
    assert any(h for _, h, _ in want) and any(not h for _, h, _ in want)


@pytest.mark.parametrize("index_bytes", [1 << 20, 0])
def test_edges(spark, index_bytes):
    docs = spark.createDataFrame([(None, "a b c", 1), (1, None, 2), (2, "zz", 3), (2, "zz", 3)], "doc_id long, text string, item int")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, none, index_bytes=index_bytes).count() == 4
    assert decontaminate.decontaminate(docs.limit(0), none, index_bytes=index_bytes).count() == 0
    bench = spark.createDataFrame([(None, "b c")], "item_id long, text string")
    out = decontaminate.with_hits(docs, bench, index_bytes=index_bytes)
    assert out.columns == ["doc_id", "text", "item", "_hits"]
    assert out.where(F.col("_hits.n_hit") == 2).first()._hits["items"] == ["null"]
    assert decontaminate.decontaminate(docs, bench, index_bytes=index_bytes).count() == 3
