import random
import re
from collections import Counter

import pytest

from wearline.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    covered = {part for p, a in found.items() if len(p) > 3 for i in range(1, len(p)) for j in range(i + 2, len(p) + 1)
               for part in [(p[0], *p[i:j])] if j - i < len(p) - 1 and found.get(part) == a}
    out = []
    for lang in sorted(n):
        kept = []
        for p, a in found.items():
            if p[0] == lang and p not in covered:
                cuts = [(1000 * a * n[lang] // (f[p[:k + 1]] * f[(lang, *p[k + 1:])]), k) for k in range(1, len(p) - 1)]
                score, k = min(cuts)
                kept.append((-score, -a, " ".join(p[1:]).encode(), f[p[:k + 1]], f[(lang, *p[k + 1:])]))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return out


def corpus(seed):
    rnd = random.Random(seed)
    some = ["the", "of", "THE", "é", "École", "a\x01b", "日本", "x"] + [f"w{i}" for i in range(40)]
    weight = [40, 20, 10, 5, 5, 3, 3, 3] + [1] * 40

    def text(n):
        return "".join(w + rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ", "]) for w in rnd.choices(some, weight, k=rnd.randint(0, n)))

    rows = [(rnd.choice(["en", "de", None, "und", ""]), text(60)) for _ in range(500)]
    same = "of the same old passage again. of the same"
    return rows + [("en", same)] * 9 + [("en", None), (None, ""), ("de", " .,; "), ("fr", "the " * 20_000), ("fr", "ab" * 50_000)]


@pytest.mark.parametrize("budget, block_bytes", [(1 << 21, 4 << 20), (60, 700), (5, 3000)])
def test_equals_brute_force(spark, budget, block_bytes):
    rows = corpus(budget)
    docs = spark.createDataFrame([(i, t, l, 1, "w") for i, (l, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, rank int, word string").repartition(3)
    out = phrases.collocations(docs, least=6, top=40, budget=budget, block_bytes=block_bytes)
    assert out.columns == COLUMNS
    got = [tuple(r) for r in out.orderBy("lang", "rank").collect()]
    assert got == brute(rows, 6, 40) and len(got) > 100


def test_large_counts_stay_exact(spark):
    # 1000 a n passes 64 bits; the division must still be exact.
    df = spark.createDataFrame([(3_000_000_007, 9_000_000_000_000_001, 3_000_000_011, 4_000_000_009)], "a long, n long, l long, r long")
    e = phrases._exact
    over = e(df.a) * e(df.n) * phrases.F.lit(1000).cast("decimal(4,0)")
    got = df.select(over.alias("over"), (e(df.l) * e(df.r)).alias("under")).selectExpr("over div under AS s").first().s
    assert got == 1000 * 3_000_000_007 * 9_000_000_000_000_001 // (3_000_000_011 * 4_000_000_009)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.collocations(docs).collect() == []
    few = spark.createDataFrame([(1, "a b c", "en")], "doc_id long, text string, lang string")
    assert phrases.collocations(few).collect() == []
