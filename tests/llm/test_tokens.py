import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm.bpe import WIDE, BytePairEncoder, bpe_round_trip
from tidemark.llm.common import fresh_path
from tidemark.llm.queries import op1_bpe, op10_token_files
from tidemark.llm.token_files import BATCH_ROWS, SequenceFile, WordEncoder, read_token_files, write_token_files

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LETTERS = " abcdeABZéñß'stredÉİΣς\n\t\r0123  .,!🙂  \x1c\x85́中文字'llS﻿​　"


@pytest.fixture(scope="module")
def coder():
    return BytePairEncoder(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def public():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strings(n, most=50):
    rng = random.Random(6)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(most))) for _ in range(n)]


def encoded(coder, texts):
    ids, starts = coder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]


def test_encoder_equals_the_public_library(coder, public):
    rng = random.Random(7)
    long = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (300, WIDE - 1, WIDE, WIDE + 1, 9000, 60_000)]
    texts = strings(2000) + ["".join(rng.choice("ab cdé,.\n the s") for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts += long + ["a" * 9000, " " * 5000, "\n" * 300 + "x", "<|endoftext|>", "", "a b.\nC d, e", "x\n", "\nx", "It's 's don't,", "é" * 3000 + "."]
    assert encoded(coder, texts) == [public.encode_ordinary(t) for t in texts]
    ids, starts = coder.encode(pa.array(texts))
    assert coder.decode(ids, starts).to_pylist() == [t.encode() for t in texts]
    assert encoded(coder, []) == [] and encoded(coder, [""]) == [[]] and encoded(coder, ["a b"]) == [public.encode_ordinary("a b")]


def test_long_pieces_merge_alike(coder):
    rng = random.Random(8)
    pieces = ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 400))).encode() for letters in ("abctheionr", "ab", "a", "the") for _ in range(60)]
    pieces = [p for p in pieces if p not in coder.ranks]
    flat, sizes = coder.merge(pieces)
    assert np.split(flat, np.cumsum(sizes)[:-1])[3].tolist() == coder._merge_long(pieces[3]).tolist()
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [coder._merge_long(p).tolist() for p in pieces]


def test_the_memo_starts_anew_without_a_change(coder, public):
    small = BytePairEncoder(RANKS, public_tokenizers.PATTERN)
    small.pieces.limit = 2000
    held = []
    for k in range(3):
        texts = [f"{t} w{k}x" for t in strings(100)]
        assert encoded(small, texts) == [public.encode_ordinary(t) for t in texts]
        held.append(small.pieces.bytes)
    assert max(held) < 1.1 * held[0]


def test_bpe_query_and_odd_rows(spark, public, odd_docs, no_docs):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op1_bpe(spark, SF).collect():
        ids = public.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    found = bpe_round_trip(odd_docs, RANKS, public_tokenizers.PATTERN).collect()
    want = sorted(((r["doc_id"], (r["text"] or "").encode()) for r in odd_docs.collect()), key=repr)
    assert sorted(((r["doc_id"], bytes(r["decoded"])) for r in found), key=repr) == want
    assert bpe_round_trip(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_word_encoder_equals_the_public_library():
    whole, own = Tokenizer.from_file(WORDS), WordEncoder(WORDS)
    texts = strings(2000) + [f"{a}{b}{c}" for a in ("", "x ", "é") for b in ("<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>") for c in ("", ".", ", a")] + ["İ, A.", "don't. I'LL,", "Σς. ", ""]
    assert encoded(own, texts) == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def brute(rows):
    whole, start, out = Tokenizer.from_file(WORDS), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_token_files_query_and_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, op10_token_files(spark, SF).collect()), key=repr) == brute(rows)
    files = write_token_files(odd_docs, fresh_path(spark, "t"), WORDS, 2, length=16)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, read_token_files(spark, files).collect()), key=repr) == brute(rows)
    assert read_token_files(spark, write_token_files(no_docs, fresh_path(spark, "t"), WORDS, 2)).count() == 0


def test_rows_without_an_identifier_spread_over_files(spark):
    rows = [(None if i % 3 else i, f"{i} of the texts") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = write_token_files(docs, fresh_path(spark, "t"), WORDS, 2, length=16)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files) > 2 and max(f.n_docs for f in files) < 300
    assert sorted(map(tuple, read_token_files(spark, files).collect()), key=repr) == brute(rows)


def test_sequences_are_views_of_the_file(spark):
    rows = [(i, f"word{i} " * 40) for i in range(60)]
    files = write_token_files(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), fresh_path(spark, "t"), WORDS, 2, length=32)
    for meta in files:
        file = SequenceFile(meta.tokens_path)
        n = -(-meta.n_tokens // 32)
        found = [file.sequence(i) for i in range(n)]
        assert all(len(ids) == len(mask) == 32 and not ids.flags.writeable and not ids.flags.owndata for ids, mask in found)
        assert sum(sum(mask.to_pylist()) for _, mask in found) == meta.n_tokens
        assert n > BATCH_ROWS or meta.n_docs < 60
