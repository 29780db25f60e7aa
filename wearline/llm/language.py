"""Language identification: TF-IDF n-gram vectors against clustered centroids per language."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from wearline.llm.words import pieces, text_bytes

DIMS = 4096
CENTROIDS = 4
#: About this many labelled documents of each language are clustered. Document frequencies are
#: counted over all training documents.
SAMPLE = 400
#: A document is rejected if its similarity to the nearest centroid is below this share of what
#: the least similar of that centroid's own documents have.
REJECT_SHARE = 0.35
#: Short texts are less similar to anything, so below this many n-grams the bar falls with the
#: square root of their number.
FULL_GRAMS = 200
ROWS = 256
MAX_LANGUAGES = 2000
UNKNOWN = "und"

_FOLD = np.array([b if b >= 0x80 or 0x61 <= b <= 0x7A or b == 0x27 else 0x20 for b in range(256)], np.uint32)


def counts_of(texts: pa.Array) -> np.ndarray:
    """Hashed counts of byte pairs and triples of lower-cased texts, one row per text."""
    data, at = text_bytes(pc.utf8_lower(texts.fill_null("")))
    out = np.zeros(len(texts) * DIMS, np.int64)
    if len(data) < 3:
        return out.reshape(-1, DIMS)
    b = _FOLD[data]
    row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(at))
    again = np.zeros(len(b), bool)
    again[1:] = (b[1:] == 0x20) & (b[:-1] == 0x20)
    b, row = b[~again], row[~again]
    if len(b) < 3:
        return out.reshape(-1, DIMS)
    pair = b[:-1] | (b[1:] << np.uint32(8))
    triple = pair[:-1] | (b[2:] << np.uint32(16))
    for codes, width, salt in ((pair, 2, 0x9E3779B1), (triple, 3, 0x85EBCA6B)):
        same = row[:len(codes)] == row[width - 1:width - 1 + len(codes)]
        slot = ((codes[same] + np.uint32(1)) * np.uint32(salt)) >> np.uint32(20)
        out += np.bincount(row[:len(codes)][same] * DIMS + slot, minlength=len(out))
    return out.reshape(-1, DIMS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts).astype(np.float32) * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def _small(texts: pa.Array):
    for first, part in pieces(texts):
        for k in range(0, len(part), ROWS):
            yield first + k, part.slice(k, ROWS)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out starts: unit centroids, and each row's centroid."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    middle = x[chosen]
    for _ in range(rounds):
        own = (x @ middle.T).argmax(axis=1)
        middle = np.stack([x[own == j].mean(axis=0) if (own == j).any() else middle[j] for j in range(len(middle))])
        middle /= np.maximum(np.linalg.norm(middle, axis=1, keepdims=True), 1e-9)
    return middle, (x @ middle.T).argmax(axis=1)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]    # of each centroid
    floors: np.ndarray      # of each centroid


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
        sample: int = SAMPLE, k: int = CENTROIDS) -> Model:
    """Learns from the rows of train with a text and a language.

    key_col only picks the rows to cluster. Without such rows the model knows no language.
    """
    rows = train.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
                        F.pmod(F.xxhash64(F.col(key_col), F.col(lang_col)), F.lit(1 << 30)).alias("draw")).where(
        "text IS NOT NULL AND lang IS NOT NULL")

    def frequencies(batches):
        seen, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for _, part in _small(batch.column(0)):
                seen += (counts_of(part) > 0).sum(axis=0)
                n += len(part)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1)), pa.array(np.append(seen, n))],
                                         names=["slot", "n"])

    by_slot = dict(rows.select("text").mapInArrow(frequencies, "slot long, n long")
                   .groupBy("slot").agg(F.sum("n").alias("n")).collect())
    total = by_slot.get(DIMS, 0)
    idf = np.log((1 + total) / (1 + np.array([by_slot.get(i, 0) for i in range(DIMS)]))).astype(np.float32) + 0.1
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MAX_LANGUAGES} values")
    if not sizes:
        return Model(idf, np.zeros((0, DIMS), np.float32), [], np.zeros(0))
    shares = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1.0, sample / r["count"]))])
    drawn = rows.where(F.col("draw") < shares[F.col("lang")] * (1 << 30))

    def centroids(key, table):
        texts = table.column("text").combine_chunks()
        x = np.concatenate([vectors(counts_of(part), idf) for _, part in _small(texts)])
        middle, own = cluster(x, k)
        near = (x * middle[own]).sum(axis=1)
        floors = [float(np.quantile(near[own == j], 0.01)) if (own == j).any() else 0.0 for j in range(len(middle))]
        return pa.table({"lang": [key[0].as_py()] * len(middle), "floor": pa.array(floors, pa.float64()),
                         "middle": pa.array([m.astype("<f4").tobytes() for m in middle], pa.binary())})

    found = (drawn.select("lang", "text").groupBy("lang")
             .applyInArrow(centroids, "lang string, floor double, middle binary").collect())
    found.sort(key=lambda r: (r["lang"], bytes(r["middle"])))
    middles = [np.frombuffer(bytes(r["middle"]), "<f4") for r in found]
    return Model(idf, np.stack(middles) if middles else np.zeros((0, DIMS), np.float32),
                 [r["lang"] for r in found], np.array([r["floor"] for r in found]))


def predict_column(spark, model: Model, text, reject_share: float = REJECT_SHARE):
    """struct(lang, score, rejected) of each text.

    score is the cosine to the nearest centroid. A null text, one without a letter, or any text if
    the model knows no language, is "und", 0 and rejected; one too far from all centroids keeps the
    nearest language and is rejected.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def run(texts: pa.Array) -> pa.Array:
        m, out = shared.value, []
        letters = pc.match_substring_regex(texts.fill_null(""), r"\p{L}").to_pylist()
        for first, part in _small(texts):
            if not len(m.languages):
                out += [{"lang": UNKNOWN, "score": 0.0, "rejected": True}] * len(part)
                continue
            counts = counts_of(part)
            near = vectors(counts, m.idf) @ m.centroids.T
            best = near.argmax(axis=1)
            bar = reject_share * m.floors[best] * np.sqrt(np.minimum(1, counts.sum(axis=1) / FULL_GRAMS))
            for i, j in enumerate(best.tolist()):
                score = min(1.0, max(0.0, float(near[i, j])))
                out.append({"lang": m.languages[j], "score": score, "rejected": score < float(bar[i])}
                           if letters[first + i] else {"lang": UNKNOWN, "score": 0.0, "rejected": True})
        return pa.array(out, pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]))

    return run(text)
