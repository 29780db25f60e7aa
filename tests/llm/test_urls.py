import random

import pytest

from wearline.llm import urls

RULES = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1")]


def names(n, seed):
    rnd = random.Random(seed)
    return sorted({".".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(rnd.randint(1, 5))) for _ in range(n)})


@pytest.mark.parametrize("share", [0, 0.01, 0.5, 0.99, 1])
def test_levels_are_exact(share):
    keys = [f"host{i}.example".encode() for i in range(3000)]
    listed, others = keys[:int(3000 * share)], keys[int(3000 * share):]
    levels = urls.build_levels(listed, others)
    assert urls.is_listed(levels, listed).all() and not urls.is_listed(levels, others).any()
    assert urls.is_listed(levels, []).tolist() == []
    if share == 0.01:
        assert sum(len(v.bits) for v in levels) < 30 * 8  # 30 keys among 3,000, far less than the keys


def test_domains():
    assert urls.domains("a.b.c", 9, 99) == ["c", "b.c", "a.b.c"]
    assert urls.domains("a.b.c", 2, 99) == ["c", "b.c"]
    assert urls.domains("a.b.c", 9, 3) == ["c", "b.c"]
    assert urls.domains("", 9, 9) == [] and urls.domains("a.", 9, 9) == ["a."] and urls.domains(".a", 9, 9) == ["a", ".a"]
    assert urls.domains("." * 500_000 + "x", 2, 9) == ["x", ".x"]


@pytest.mark.parametrize("shard_keys, pass_bytes", [(1 << 18, 1 << 26), (40, 30)])
def test_judge_equals_brute_force(spark, shard_keys, pass_bytes):
    hosts = names(400, 1)
    listed = random.Random(2).sample(hosts, 60) + ["not.in.corpus", None, "", hosts[0], hosts[0]]
    data = [(i, f"http://{h}/x?q=://y", h) for i, h in enumerate(hosts)] + [(None, None, "n"), (-1, "no scheme", "n"), (-2, "", "n"),
            (-3, f"http://{hosts[0].upper()}#z/", "n"), (-3, f"http://{hosts[0].upper()}#z/", "n"), (-4, "x://" + "q." * 100_000 + hosts[0], "n")]
    pages = spark.createDataFrame(data, "page_id long, url string, key string")
    out = urls.judge(pages, RULES, spark.createDataFrame([(x,) for x in listed], "anything string"), shard_keys=shard_keys, pass_bytes=pass_bytes)
    rows = out.collect()
    assert len(rows) == len(data) and out.columns == ["page_id", "url", "key", "host", "path", "rule", "verdict"]
    bad = {x for x in listed if x}
    for r in rows:
        want = any(r.host == b or r.host.endswith("." + b) for b in bad)
        assert r.rule is None and r.verdict == ("block" if want else "allow"), r
    special = {r.page_id: (r.host, r.path) for r in rows}
    assert special[None] == special[-1] == special[-2] == ("", "") and special[-3] == (hosts[0], "")


def test_rules_longest_first(spark):
    data = ["https://example.org/es/1", "https://www.Example.ORG/en/12", "http://example.org/en/2", "http://org", "http://xexample.org/es/",
            "http://a.com/es/?x", "ftp://org/#"]
    pages = spark.createDataFrame([(x,) for x in data], "url string")
    nothing = spark.createDataFrame([], "k string")
    got = {r.url: (r.rule, r.verdict) for r in urls.judge(pages, RULES, nothing).collect()}
    assert [got[x] for x in data] == [("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"), (None, "allow"),
                                      ("org/", "allow"), (None, "allow"), ("org/", "allow")]


def test_empty_tables_and_clashing_names(spark):
    listed = spark.createDataFrame([("a.b",)], "k string")
    empty = spark.createDataFrame([], "url string")
    assert urls.judge(empty, RULES, listed).collect() == []
    with pytest.raises(ValueError, match="host"):
        urls.judge(spark.createDataFrame([("x", "y")], "url string, host string"), RULES, listed)
