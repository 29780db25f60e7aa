import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from wearline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


def corpus():
    rnd = random.Random(6)
    bits = ["the", " cat", "'s", "'ll", "  ", "\n\n", "\t", "é", "naïve", "😀", "中文字", "123", "4567", "!?", "\x1c", "\x85", " ",
            "　", "<|endoftext|>", "Zürich", "ñ", "\r\n", "_", "𝔘", "½", " x", "​", "á"]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(0, 60))) for _ in range(150)]
    return texts + [None, "", " ", "\n", "ab" * 20000, " " * 30000, "word " * 20000, texts[0], texts[0]]


@pytest.mark.parametrize("block_bytes", [8 << 20, 700])
def test_equals_library(spark, ranks, block_bytes):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "b") for i, t in enumerate(texts)] + [(None, "none", "c")],
                                 "doc_id long, text string, block string").repartition(3)
    out = bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, block_bytes=block_bytes)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(texts) + 1 and got[None].n_tokens == 1
    for i, t in enumerate(texts):
        ids = own.encode_ordinary(t or "")
        assert got[i].token_ids == ids, t
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_decode(spark, ranks):
    df = spark.createDataFrame([([464, 3797],), ([],), (None,)], "token_ids array<int>")
    assert [None if r.decoded is None else bytes(r.decoded) for r in bpe.decode_documents(df, ranks).collect()] == [
        b"The cat", b"", None]


def test_empty(spark, ranks):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_documents(none, ranks, public_tokenizers.PATTERN).count() == 0
