"""What Python workers hold at a time stays small beside the heap of their executor."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, near_dedup, quality
from tidemark.llm.common import small_batches


def test_batches_that_python_gets(spark):
    docs = spark.range(0, 3000, 1, 1).select("id", F.repeat(F.lit("some words "), 1000).alias("text"))  # 33 MB
    sizes = [r["n"] for r in small_batches(docs).mapInArrow(lambda batches: (pa.record_batch({"n": [b.nbytes]}) for b in batches), "n long").collect()]
    assert sum(sizes) > 33e6 and max(sizes) < 5e6


@pytest.fixture(scope="module")
def batch():
    """12 MB of documents, of words of which a third is new."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) if rng.random() < 2 / 3 else f"{rng.randrange(10**6):x}" for _ in range(700)) for _ in range(3000)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])


def peak(work) -> float:
    """Most MB held at a time, by Python and numpy or by Arrow, beyond what was held before."""
    pool, usual = pa.proxy_memory_pool(pa.default_memory_pool()), pa.default_memory_pool()
    pa.set_memory_pool(pool)
    tracemalloc.start()
    try:
        work()
        return (tracemalloc.get_traced_memory()[1] + pool.max_memory()) / 1e6
    finally:
        tracemalloc.stop()
        pa.set_memory_pool(usual)


def test_bpe_holds_little_beside_its_memory_of_pieces(batch):
    coder = bpe.BytePairEncoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)

    def work():
        for part in bpe.chunks(batch):
            coder.decode(*coder.encode(part["text"]))
            coder.pieces.forget()

    assert peak(work) < 60  # 33, and 122 of chunks of 4 MB


def test_scores_and_sets_are_made_of_small_chunks(batch):
    score = quality.Model(np.zeros((quality.BUCKETS, 3), np.float32), np.zeros(3)).scorer()
    for most in (quality.CHUNK_BYTES, near_dedup.CHUNK_BYTES):
        parts = list(bpe.chunks(batch, most=most))
        assert sum(p.num_rows for p in parts) == batch.num_rows
        assert peak(lambda p=parts[0]: (score(p["text"]), near_dedup.shingle_sets(p["text"], 5))) < 45  # 32, and 65 of chunks of 2 MB
