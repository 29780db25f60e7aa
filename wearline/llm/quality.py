"""Quality rules: divergence of a document's histograms from those of its language."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wearline.llm.words import (
    ALPHANUMERIC, SPACED, Words, find_words, mix, pieces, text_bytes, window_hashes, window_starts, word_hashes,
)

#: Character classes: lower, upper, digit, white space, sentence marks, other ASCII, beyond ASCII.
CLASSES = 7
_CLASS = np.array([
    0 if 0x61 <= b <= 0x7A else 1 if 0x41 <= b <= 0x5A else 2 if 0x30 <= b <= 0x39 else
    3 if b == 0x20 or 0x09 <= b <= 0x0D else 4 if chr(b) in ".,;:!?'\"()-" else 6 if b >= 0x80 else 5
    for b in range(256)], np.int64)
_SYMBOL = np.array([chr(b) in "#*$%&|<>" for b in range(256)])

COMMON_WORDS = 64
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_LANGUAGES = 2000


@dataclass(frozen=True)
class Limits:
    """Largest Jensen-Shannon distances (base 2, so 0 to 1) that pass, and the lengths from which
    they are judged; a shorter text's histogram says too little. The bar for common words is
    words + noise / sqrt(number of words), since a short sample strays from its own source."""

    chars: float = 0.30
    words: float = 0.30
    noise: float = 1.2
    min_chars: int = 200
    min_words: int = 60


def class_counts(texts: pa.Array) -> np.ndarray:
    """Code points of each character class, one row per text."""
    data, at = text_bytes(texts)
    first = (data & 0xC0) != 0x80
    row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(at))[first]
    return np.bincount(row * CLASSES + _CLASS[data[first]], minlength=len(texts) * CLASSES).reshape(-1, CLASSES)


def word_counts(words: Words, hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Counts of the (sorted) common words and, last, of all others, one row per text."""
    n = len(common) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        slot = np.where(common[at] == hashes, at, len(common))
    else:
        slot = np.zeros(len(hashes), np.int64)
    texts = len(words.doc) - 1
    return np.bincount(words.doc_of() * n + slot, minlength=texts * n).reshape(-1, n)


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to a reference histogram; 1 for an empty one."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    q = (reference / max(reference.sum(), 1))[None, :]
    m = (p + q) / 2

    def part(x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / np.where(m > 0, m, 1)), 0).sum(axis=1)

    out = np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))
    return np.where(total[:, 0] > 0, out, 1.0)


@dataclass
class References:
    languages: list[str]
    chars: np.ndarray            # one row per language
    words: list[np.ndarray]      # sorted hashes of each language's common words
    shares: list[np.ndarray]     # their counts and, last, that of all other words


def _by_language(langs: pa.Array):
    coded = langs.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: int = COMMON_WORDS) -> References:
    """Histograms of every language over all its documents, in two passes.

    The first counts classes and every word; a piece sends each of its words once, and Spark combines
    them before and after the shuffle. The most frequent are taken, the smaller hash on a tie. The
    second counts all other words together. Rows without a text or a language are left out.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL")

    def scan(batches):
        for batch in batches:
            for first, part in pieces(batch.column(0)):
                names, code = _by_language(batch.column(1).slice(first, len(part)))
                chars = class_counts(part)
                words = find_words(part, ALPHANUMERIC, lower=True)
                hashes = word_hashes(words)
                of = code[words.doc_of()]
                for k, name in enumerate(names):
                    found, n = np.unique(hashes[of == k], return_counts=True)
                    keys = np.concatenate([np.arange(CLASSES), found.view(np.int64)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(keys), pa.string()), pa.array(np.arange(len(keys)) >= CLASSES),
                         pa.array(keys), pa.array(np.concatenate([chars[code == k].sum(axis=0), n]))],
                        names=["lang", "is_word", "key", "n"])

    sums = (rows.mapInArrow(scan, "lang string, is_word boolean, key long, n long")
            .groupBy("lang", "is_word", "key").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang", "is_word").orderBy(F.desc("n"), "key"))
    first = (sums.withColumn("rank", rank).where(F.col("rank") <= max(common, CLASSES))
             .where(~F.col("is_word") | (F.col("rank") <= common)).drop("rank")
             .limit(MAX_LANGUAGES * (common + CLASSES) + 1).collect())
    if len(first) > MAX_LANGUAGES * (common + CLASSES):
        raise ValueError(f"{lang_col} has more than {MAX_LANGUAGES} values")
    languages = sorted({r["lang"] for r in first})
    place = {name: i for i, name in enumerate(languages)}
    chars = np.zeros((len(languages), CLASSES))
    words: list[list[int]] = [[] for _ in languages]
    for r in first:
        if r["is_word"]:
            words[place[r["lang"]]].append(r["key"])
        else:
            chars[place[r["lang"]], r["key"]] = r["n"]
    chosen = [np.sort(np.array(w, np.int64).view(np.uint64)) for w in words]
    shared = rows.sparkSession.sparkContext.broadcast((place, chosen))

    def count(batches):
        index, mine = shared.value
        totals = [np.zeros(len(c) + 1, np.int64) for c in mine]
        for batch in batches:
            for at, part in pieces(batch.column(0)):
                names, code = _by_language(batch.column(1).slice(at, len(part)))
                for k, name in enumerate(names):
                    if name in index:
                        i = index[name]
                        found = find_words(part.filter(pa.array(code == k)), ALPHANUMERIC, lower=True)
                        totals[i] += word_counts(found, word_hashes(found), mine[i]).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, t in enumerate(totals) for _ in t], pa.int32()),
             pa.array([j for t in totals for j in range(len(t))], pa.int32()),
             pa.array(np.concatenate(totals) if totals else np.empty(0, np.int64), pa.int64())],
            names=["lang", "slot", "n"])

    shares = [np.zeros(len(c) + 1) for c in chosen]
    for r in (rows.mapInArrow(count, "lang int, slot int, n long").groupBy("lang", "slot")
              .agg(F.sum("n").alias("n")).collect()):
        shares[r["lang"]][r["slot"]] = r["n"]
    return References(languages, chars, chosen, shares)


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Words, their code points, symbols, repeated lines and repeated words of each text."""
    words = find_words(texts, SPACED)
    data, at = text_bytes(texts)
    first = (data & 0xC0) != 0x80

    def per_text(mask, ends=at):
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[ends[1:]] - total[ends[:-1]]

    starts = window_starts(words, 3)
    hashes = window_hashes(word_hashes(words), starts, 3)
    owner = words.doc_of()
    own = mix(hashes + (owner[starts].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own)
    ranked = own[order]
    twice = np.zeros(len(own), bool)
    if len(own) > 1:
        same = ranked[1:] == ranked[:-1]
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
    covered = np.zeros(len(words.start), bool)
    for k in range(3):
        covered[starts[twice] + k] = True
    lines = np.zeros(len(texts), np.int64)
    whole = data.tobytes()
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        if whole.find(b"\n", a, b) >= 0:
            said = [line for line in whole[a:b].split(b"\n") if line and not line.isspace()]
            lines[i] = len(said) - len(set(said))
    return {"n_words": words.counts, "word_chars": per_text(first & SPACED[data]), "n_symbols": per_text(_SYMBOL[data]),
            "n_dup_lines": lines, "n_repeat_words": per_text(covered, words.doc)}


OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def verdict_column(spark, known: References, text, limits: Limits = Limits()):
    """struct of the base counts, base_failed, kept and the two distances.

    A text is compared with the language whose class histogram and common words are nearest to its
    own, so a wrong or missing label doesn't matter. Below the lengths in limits, or without
    references, only the base rules decide. Null and empty texts have no words and fail.
    """
    shared = spark.sparkContext.broadcast((known, limits))

    @F.arrow_udf("struct<" + ",".join(f"{c}:long" for c in OUT)
                 + ",base_failed:boolean,kept:boolean,char_distance:double,word_distance:double>")
    def run(texts: pa.Array) -> pa.Array:
        ref, bar = shared.value
        parts = []
        for _, part in pieces(texts):
            base = base_counts(part)
            failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PCT * base["n_words"])
            chars = class_counts(part)
            found = find_words(part, ALPHANUMERIC, lower=True)
            hashes = word_hashes(found)
            by_char = np.ones((len(part), len(ref.languages)))
            by_word = np.ones_like(by_char)
            for k in range(len(ref.languages)):
                by_char[:, k] = distance(chars, ref.chars[k])
                by_word[:, k] = distance(word_counts(found, hashes, ref.words[k]), ref.shares[k])
            if len(ref.languages):
                best = (by_char + by_word).argmin(axis=1)
                rows = np.arange(len(part))
                char_d, word_d = by_char[rows, best], by_word[rows, best]
            else:
                char_d = word_d = np.zeros(len(part))
            far = (char_d > bar.chars) & (chars.sum(axis=1) >= bar.min_chars)
            many = found.counts
            far |= (word_d > bar.words + bar.noise / np.sqrt(np.maximum(many, 1))) & (many >= bar.min_words)
            parts.append(pa.StructArray.from_arrays(
                [*(pa.array(base[c].astype(np.int64)) for c in OUT), pa.array(failed), pa.array(~failed & ~far),
                 pa.array(char_d), pa.array(word_d)],
                names=[*OUT, "base_failed", "kept", "char_distance", "word_distance"]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(
            [(c, pa.int64()) for c in OUT] + [("base_failed", pa.bool_()), ("kept", pa.bool_()),
                                              ("char_distance", pa.float64()), ("word_distance", pa.float64())]))

    return run(text)
