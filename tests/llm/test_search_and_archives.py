import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_path
from tidemark.llm.files import resolve
from tidemark.llm.top_k import BlockIndex, top_k
from tidemark.llm.warc import WarcError, read_archive, read_warc, record, write_warc

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_top(rows, k, scale, step):
    own = [(i, np.floor(scale * np.array(x, np.float32).astype(np.float64)).astype(np.int64)) for i, x in rows if i is not None and x is not None and all(v is not None and np.isfinite(v) for v in x)]
    score = lambda a, b: int(sum(p * q for p, q in zip(a.tolist(), b.tolist(), strict=False)))
    out = []
    for i, x in own:
        if i % step == 0:
            best = sorted((-score(x, y), j) for j, y in own if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), np.round(rng.normal(0, 0.2, 8), 2).tolist()) for i in range(700)]
    rows += [(i, rows[50][1]) for i in range(700, 720)]  # ties
    rows += [(800, None), (850, []), (900, [0.1, None]), (950, [float("nan")] * 8), (1000, [float("inf")] * 8), (1050, [0.5, -0.5]), (None, [0.1] * 8), (1100, [1e7, 9e6, -9.5e6]), (1101, [1e7] * 8), (1102, [9.5e6] * 8)]
    rows += [(1150, [0.0] * 7 + [1e11]), (1151, [0.0] * 7 + [1.1e11])]  # scores of over 2 ** 62
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], VECTORS).repartition(4)
    found = top_k(df, 5, 256, F.col("vec_id") % 50 == 0)
    least, most = -(2**63), 2**63 - 1
    assert sorted(map(tuple, found.collect())) == [(*r[:3], min(max(r[3], least), most)) for r in brute_top(rows, 5, 256, 50)]
    huge = spark.createDataFrame([(0, [3e38], 0), (1, [3e38], 0), (2, [2e38], 0), (3, [-3e38], 0), (4, [1e7], 0)], VECTORS)
    assert [r["vec_id"] for r in top_k(huge, 5, 256, F.col("vec_id") == 0).orderBy("rank").collect()] == [1, 2, 4, 3]
    assert top_k(df.limit(0), 5, 256, F.col("vec_id") % 50 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0], 0), (1, [2.0], 0)], VECTORS)
    assert [tuple(r) for r in top_k(few, 5, 1, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 2)]


def test_blocks_are_skipped():
    rng = np.random.default_rng(10)
    blocks = [(np.arange(b * 50, b * 50 + 50), (rng.normal(0, 3, (50, 4)) + 100 * np.eye(4)[b % 4]).astype(np.int32)) for b in range(40)]
    index, q = BlockIndex(blocks), np.array([[100, 0, 0, 0]], np.int32)
    best, scored = index.search(np.array([-1]), q, 5)
    every = sorted((-int(x @ q[0]), i) for ids, xs in blocks for i, x in zip(ids.tolist(), xs, strict=True))[:5]
    assert [(-s, i) for s, i in zip(*map(np.ndarray.tolist, best[0]), strict=True)] == every and scored < 20


PAGES = "page_id long, url string, html string, lang string, digest string"


def brute_pages(rows):
    first = {}
    for i, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 100 and first.get(h or "") is not None and first[h or ""] != i
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out, key=repr)


def test_archives_read_back(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice(["é" * 50, "x" * 99, "y" * 100, None, "", f"own {i} " * rng.randrange(60), "a\r\n\r\nWARC/1.1\r\n" * 9, "z" * 300_000])) for i in range(200)]
    rows += [(5, "y" * 100), (5, "y" * 100), (None, "y" * 100), (None, "only here " * 20)]
    df = spark.createDataFrame([(i, None if i == 3 else f"http://h/{i}\n", h, "en", "d") for i, h in rows], PAGES).repartition(6)
    paths = write_warc(df, fresh_path(spark, "w"))
    assert sorted(map(tuple, read_warc(spark, paths).collect()), key=repr) == brute_pages(rows)
    assert read_warc(spark, write_warc(df.limit(0), fresh_path(spark, "w"))).count() == 0
    raw = resolve(paths[0])[0].open_input_stream(resolve(paths[0])[1], compression=None).read()
    unpacker = zlib.decompressobj(31)
    one = unpacker.decompress(raw)
    assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n") and unpacker.unused_data[:2] == b"\x1f\x8b"


@pytest.mark.parametrize("damage", [lambda b: b[:-20], lambda b: zlib.compress(zlib.decompress(b, 31).replace(b"payload", b"PAYLOAD"), wbits=31), lambda b: zlib.compress(zlib.decompress(b, 31)[:-2], wbits=31), lambda b: zlib.compress(b"no record", wbits=31)])
def test_damaged_archives_are_refused(tmp_path, damage):
    payload = b"the payload of a page"
    good = record(1, "http://a", payload, hashlib.sha256(payload).hexdigest(), None)
    (tmp_path / "good").write_bytes(good + good)
    assert [r["payload"] for r in read_archive(f"file://{tmp_path}/good")] == [payload] * 2
    (tmp_path / "bad").write_bytes(good + damage(good))
    with pytest.raises(WarcError):
        list(read_archive(f"file://{tmp_path}/bad"))
