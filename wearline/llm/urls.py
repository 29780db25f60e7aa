"""Url filters: longest-prefix rules, then exact membership of hosts in a list by Bloom filter cascades.

A cascade holds the listed keys in its first level, the unlisted keys of the universe that this level
lets through in the second, the listed keys that the second lets through in the third, and so on until
a level lets nothing wrong through. It is exact for every key of the universe it was built over, which
here are all host names of the corpus and their parent domains, so a lookup needs no join. Keys are
dealt over shards by hash; a shard's cascade is built by one task from a bounded number of keys.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wearline.session import settle

#: Keys of the universe that one shard is meant to hold.
SHARD_KEYS = 1 << 18
#: Bytes of cascades that one pass over the corpus holds in memory; more take further passes.
PASS_BYTES = 64 << 20
SHARD_SEED = 42

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #; empty without ://."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


class Rule(NamedTuple):
    verdict: str    # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule_column(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, nulls if none does.

    A rule fits its host and all subdomains, where the path starts with the rule's. Of equally long
    ones the first of the list counts.
    """
    found = None
    for r in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    nothing = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    return nothing if found is None else found.otherwise(nothing)


def domains(host: str, max_labels: int, max_bytes: int) -> list[str]:
    """The host and its parent domains, shortest first, as far as a listed key can be one of them."""
    out, end = [], len(host)
    while len(out) < max_labels and end >= 0:
        end = host.rfind(".", 0, end) if end else -1
        key = host[end + 1:]
        if len(key) > max_bytes:
            break
        if key:
            out.append(key)
    return out


class Level(NamedTuple):
    bits: np.ndarray
    size: int
    hashes: int


class Cascades(NamedTuple):
    shards: DataFrame       # shard int, levels array<struct<bits binary, size long, hashes int>>
    count: int
    max_labels: int
    max_bytes: int


def _positions(keys: list[bytes], level: int, size: int, hashes: int) -> np.ndarray:
    """Bit numbers, one row per key. Every level has hash functions of its own."""
    codes = [xxhash.xxh3_128_intdigest(k, level) for k in keys]
    low = np.array([c & 0xFFFFFFFFFFFFFFFF for c in codes], np.uint64)
    high = np.array([c >> 64 for c in codes], np.uint64) | np.uint64(1)
    return (low[:, None] + np.arange(hashes, dtype=np.uint64) * high[:, None]) % np.uint64(size)


def _holds(level: Level, number: int, keys: list[bytes]) -> np.ndarray:
    at = _positions(keys, number, level.size, level.hashes)
    return ((level.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def build_levels(listed: list[bytes], others: list[bytes]) -> list[Level]:
    """A cascade that tells listed from others exactly. Both are distinct keys without a common one."""
    levels, inside, outside = [], listed, others
    while inside:
        # The first level pays for a low rate, the later ones hold few keys and halve the rest.
        rate = min(0.5, max(len(inside) / (1.5 * len(outside)), 1e-6)) if outside and not levels else 0.5
        hashes = max(1, round(-math.log2(rate)))
        size = max(8, math.ceil(len(inside) * hashes / math.log(2)))
        bits = np.zeros((size + 7) // 8, np.uint8)
        at = _positions(inside, len(levels), size, hashes).reshape(-1)
        np.bitwise_or.at(bits, at >> np.uint64(3), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
        levels.append(Level(bits, size, hashes))
        through = _holds(levels[-1], len(levels) - 1, outside) if outside else np.empty(0, bool)
        inside, outside = [k for k, t in zip(outside, through.tolist()) if t], inside
    return levels


def is_listed(levels: list[Level], keys: list[bytes]) -> np.ndarray:
    """Exact for the keys of the universe. The first level without the key tells: even ones (from
    0) hold listed keys, so missing there means not listed."""
    out = np.full(len(keys), len(levels) % 2 == 1)
    left = np.arange(len(keys))
    for number, level in enumerate(levels):
        if not len(left):
            break
        holds = _holds(level, number, [keys[i] for i in left.tolist()])
        out[left[~holds]] = number % 2 == 1
        left = left[holds]
    return out


def _build(table: pa.Table) -> pa.Table:
    keys = [k.encode() for k in table.column("key").to_pylist()]
    marks = table.column("listed").to_pylist()
    levels = build_levels([k for k, m in zip(keys, marks) if m], [k for k, m in zip(keys, marks) if not m])
    rows = [{"bits": v.bits.tobytes(), "size": v.size, "hashes": v.hashes} for v in levels]
    return pa.table({"shard": table.column("shard").slice(0, 1), "levels": pa.array(
        [rows], pa.list_(pa.struct([("bits", pa.binary()), ("size", pa.int64()), ("hashes", pa.int32())])))})


SHARDS = "shard int, levels array<struct<bits:binary,size:long,hashes:int>>"


def _parents(max_labels: int, max_bytes: int):
    def run(batches):
        for batch in batches:
            keys = {k for h in batch.column(0).to_pylist() for k in domains(h, max_labels, max_bytes)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(keys), pa.string())], names=["key"])

    return run


def fit(hosts: DataFrame, listed: DataFrame, shard_keys: int = SHARD_KEYS) -> Cascades:
    """Cascades over all hosts of the corpus and their parent domains.

    hosts and listed have one string column each; nulls and repeats do not matter, other names
    neither. A listed key covers itself and its subdomains. Keys with more labels or bytes than any
    listed one cannot be listed and stay out of the universe. Listed keys outside it need no bits.
    An empty list or corpus gives no shards with levels, and nothing is then listed.
    """
    listed = listed.toDF("key").where(F.coalesce(F.length("key"), F.lit(0)) > 0).distinct()
    span = listed.agg(F.max(F.size(F.split("key", r"\."))), F.max(F.length("key"))).first()
    max_labels, max_bytes = span[0] or 0, span[1] or 0
    names = hosts.toDF("host").where(F.col("host").isNotNull()).distinct()
    keys = names.mapInArrow(_parents(max_labels, max_bytes), "key string")
    universe = settle(
        keys.select("key", F.lit(False).alias("listed"), F.lit(True).alias("seen"))
        .unionByName(listed.select("key", F.lit(True).alias("listed"), F.lit(False).alias("seen")))
        .groupBy("key").agg(F.max("listed").alias("listed"), F.max("seen").alias("seen"))
        .where("seen").drop("seen"), "url-keys")
    count = max(1, -(-universe.count() // shard_keys))
    shard = (F.shiftrightunsigned(F.xxhash64("key"), 33) % count).cast("int")
    shards = universe.withColumn("shard", shard).groupBy("shard").applyInArrow(_build, SHARDS)
    return Cascades(settle(shards, "url-cascades"), count, max_labels, max_bytes)


def _passes(cascades: Cascades, pass_bytes: int):
    """Runs of shards whose bits together stay below pass_bytes; a shard has a bounded size."""
    sizes = cascades.shards.select("shard", F.aggregate(
        "levels", F.lit(0).cast("long"), lambda s, v: s + F.length(v["bits"])).alias("n")).where("n > 0").orderBy("shard")
    run, held = [], 0
    for row in sizes.toLocalIterator():
        if run and held + row.n > pass_bytes:
            yield run
            run, held = [], 0
        run.append(row.shard)
        held += row.n
    if run:
        yield run


def with_listed(df: DataFrame, host_col: str, cascades: Cascades, name: str = "listed",
                pass_bytes: int = PASS_BYTES) -> DataFrame:
    """df with a boolean column: whether the host or a parent domain is listed.

    The hosts must be among those the cascades were fitted to. Null and empty hosts are not listed;
    rows and all other columns stay, and name must be a new one.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    out, first = df.withColumn(name, F.lit(False)), True
    for run in _passes(cascades, pass_bytes):
        if not first:
            out = settle(out, "url-pass")
        rows = cascades.shards.where(F.col("shard").between(run[0], run[-1])).collect()
        held = {r.shard: [Level(np.frombuffer(v.bits, np.uint8), v["size"], v.hashes) for v in r.levels] for r in rows}
        shared = df.sparkSession.sparkContext.broadcast((held, cascades.count, cascades.max_labels, cascades.max_bytes))
        out, first = out.withColumn(name, F.col(name) | _lookup(shared)(F.col(host_col))), False
    return out


def _lookup(shared):
    @F.arrow_udf("boolean")
    def listed(hosts: pa.Array) -> pa.Array:
        held, count, max_labels, max_bytes = shared.value
        coded = hosts.fill_null("").dictionary_encode()
        by_shard: dict[int, list[tuple[bytes, int]]] = {}
        for i, host in enumerate(coded.dictionary.to_pylist()):
            for key in domains(host, max_labels, max_bytes):
                key = key.encode()
                shard = (xxhash.xxh64_intdigest(key, SHARD_SEED) >> 33) % count
                if shard in held:
                    by_shard.setdefault(shard, []).append((key, i))
        found = np.zeros(len(coded.dictionary), bool)
        for shard, pairs in by_shard.items():
            hit = is_listed(held[shard], [k for k, _ in pairs])
            found[[i for (_, i), h in zip(pairs, hit.tolist()) if h]] = True
        return pa.array(found[coded.indices.to_numpy(zero_copy_only=False)] if len(hosts) else [], pa.bool_())

    return listed


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame, url_col: str = "url",
          shard_keys: int = SHARD_KEYS, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """pages with host, path, rule and verdict: the longest rule's verdict, else block for listed hosts.

    A null url or one without :// has an empty host and path and is allowed. Rows that repeat are
    judged alike. Columns of these four names, or named listed, are refused.
    """
    clash = {"host", "path", "rule", "verdict", "listed"} & set(pages.columns)
    if clash:
        raise ValueError(f"columns of these names exist: {sorted(clash)}")
    url = F.col(url_col)
    parts = pages.withColumn("host", F.coalesce(host_of(url), F.lit(""))).withColumn("path", F.coalesce(path_of(url), F.lit("")))
    cascades = fit(parts.select("host"), listed, shard_keys)
    found = rule_column(F.col("host"), F.col("path"), rules)
    return (with_listed(parts, "host", cascades, pass_bytes=pass_bytes)
            .withColumn("rule", found["rule"])
            .withColumn("verdict", F.coalesce(found["verdict"], F.when(F.col("listed"), "block").otherwise("allow")))
            .drop("listed"))


#: Parts of host names, between dots and hyphens, that put a host on the list of the query.
LISTED_WORDS = ["ads", "adult", "bet", "bets", "casino", "escort", "pills", "poker", "porn", "sex", "spam", "viagra", "warez", "xxx"]
LISTED_PATTERN = rf"(^|[.-])({'|'.join(LISTED_WORDS)})([.-]|$)"


def listed_hosts(hosts: DataFrame) -> DataFrame:
    """The hosts with a part of LISTED_WORDS, each once."""
    return hosts.toDF("host").where(F.col("host").rlike(LISTED_PATTERN)).distinct()
