import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wearline.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def corpus():
    rnd = random.Random(1)
    bits = ["a", "bb", "é", "日本", "#", "$x", "\n", "\n\n", "\t", "the cat sat", "|", "\x0b"]
    return [" ".join(rnd.choices(bits, k=rnd.randint(0, 90))) for _ in range(120)] + [
        None, "", " ", "\n\n", "x\nx\n x\nx", "go " * 30000, "y" * 90000]


def test_base_equals_brute_force():
    texts = corpus()
    got = quality.base_counts(pa.array(texts, pa.string()))
    assert [tuple(int(got[c][i]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            for i in range(len(texts))] == [brute(t) for t in texts]


def test_distance():
    a, b = np.array([[1, 1, 0], [0, 0, 0], [2, 2, 4]]), np.array([1.0, 1.0, 2.0])
    got = quality.distance(a, b)
    p, q = [.5, .5, 0], [.25, .25, .5]
    m = [(x + y) / 2 for x, y in zip(p, q)]
    kl = lambda x: sum(i * math.log2(i / j) for i, j in zip(x, m) if i)
    assert got == pytest.approx([math.sqrt((kl(p) + kl(q)) / 2), 1, 0])


def prose(rnd, n):
    common = ["the", "of", "and", "to", "in"]
    return " ".join(rnd.choice(common) if rnd.random() < .4 else "".join(rnd.choices("aeinorst", k=6)) for _ in range(n))


def test_junk_fails_and_prose_stays(spark):
    rnd = random.Random(3)
    rows = [(i, prose(rnd, 150), "en", "k") for i in range(150)]
    bad = [(200, "".join(f"{w}### " for w in prose(rnd, 150).split()), "en", "k"), (201, prose(rnd, 150).upper(), "en", "k"),
           (202, prose(rnd, 20), "en", "k"), (203, None, "en", "k"), (204, "", None, "k"), (205, "same word again " * 60, "xx", "k")]
    docs = spark.createDataFrame(rows + bad + [rows[0], (None, *rows[1][1:])], "doc_id long, text string, lang string, kept string").repartition(3)
    known = quality.references(docs)
    assert known.languages == ["en", "xx"]
    out = docs.withColumn("q", quality.verdict_column(spark, known, F.col("text"))).select("doc_id", "q.*").collect()
    kept = {r.doc_id: r.kept for r in out}
    assert all(kept[i] for i in range(150)) and kept[None] and not any(kept[i] for i in range(200, 206))
    assert len(out) == 158


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    known = quality.references(none)
    assert known.languages == []
    some = spark.createDataFrame([(1, "a " * 60), (2, " ".join(f"w{i}" for i in range(60)))], "doc_id long, text string")
    out = some.withColumn("q", quality.verdict_column(spark, known, F.col("text"))).collect()
    assert [r.q.kept for r in out] == [False, True]
