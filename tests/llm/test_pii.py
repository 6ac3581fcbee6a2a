import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.boosting import boost
from tidemark.llm.pii import KINDS, base_spans, examples, find_pii, redact, span_text
from tidemark.llm.queries import op3_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def right(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    spans = [(m.start(), k, m.end()) for k, kind in enumerate(KINDS) for m in re.finditer(PATTERNS[kind], text or "") if right(kind, m.group())]
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(5)
    parts = ["a.b@c-d.ef", "x@y", "@", ".", "1.2.3.4", "999.1.1.1", "0001.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (913) 555-3797", "+", "-", " ", "7", "12", "é🙂", "b_c", "%", "\n", "(", ")", "378282246310005"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(1500)] + [None, "", "1" * 50_000, "a" * 50_000 + "@", "1.2.3.4 " * 3000, "a.b.c." * 9000, "x@" + "y.z" * 9000, "1 " * 20_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(8)
    got = {r["i"]: r["s"] for r in rows.select("i", base_spans(F.coalesce("t", F.lit(""))).alias("b")).select("i", span_text("b").alias("s")).collect()}
    assert {i: got[i] for i in range(len(texts))} == {i: brute(t) for i, t in enumerate(texts)}


def test_query_equals_brute_force_and_keeps_base_spans(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op3_pii(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
        assert [base.count(f"{k}:") for k in KINDS] == [r[f"n_{k}"] for k in KINDS]


def test_added_spans_are_other_writings_and_secrets(spark):
    """Trees learned on a test table's base spans select other writings of the same kinds, and leave numbers alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    personal = {
        "email": ["jane.roe[at]mail.example.com", "jane.roe (at) mail.example.com"],
        "phone": ["(913) 555-3797", "913-555-3797"],
        "ip": ["65[.]95[.]187[.]82"],
        "secret": ["9f8b2c7d4e1a6f3b5c8d7e2a1b4f6c9d0e3a5b7c", "AbC9dEf8GhI7jKl6MnO5pQr4StU3"],
    }
    plain = ["2024-01-05", "12:30:45:01", "version 10.12.3000.4", "the years 1914-1918", "order 4999123", "internationalization", "a-long-word-of-parts", "4111111111111112"]
    cases = [(kind, s) for kind, ss in personal.items() for s in ss] + [("", s) for s in plain]
    texts = [(10_000 + i, f"The line before it {s} and more words.") for i, (_, s) in enumerate(cases)]
    found = {r["doc_id"]: r["spans"] for r in find_pii(docs.unionByName(spark.createDataFrame(texts, "doc_id long, text string"))).select("doc_id", span_text("spans").alias("spans")).collect()}
    at = len("The line before it ")
    for i, (kind, s) in enumerate(cases):
        assert found[10_000 + i] == (f"{kind}:{at}:{at + len(s)}" if kind else ""), s
    tokens = {r["doc_id"]: [(m.start(1), m.end(1)) for m in re.finditer('token = "([0-9a-f]{40})"', r["text"] or "")] for r in docs.collect()}
    assert sum(map(len, tokens.values())) > 5
    for d, spans in tokens.items():
        assert {f"secret:{a}:{b}" for a, b in spans} <= set(found[d].split(",")) | {""}


def test_odd_rows(odd_docs, no_docs):
    assert find_pii(odd_docs).filter(F.size("base") == 0).count() == odd_docs.count()
    assert find_pii(no_docs).count() == 0


def test_examples_have_both_labels_of_each_kind():
    sample = [(0, "a.b@c.de", "mail ", " x", True), (1, "1.2.3.4", "", "", True), (2, "4111 1111 1111 1111", "", "", True), (3, "+1 (913) 555-3797", "", "", True), (3, "1234567", "", "", False), (2, "1234567", "", "", False)]
    made = examples(sample)
    assert {(k, y) for k, *_, y in made} >= {(k, y) for k in range(1, 5) for y in (0, 1)} | {(0, 1)}
    assert {s for k, s, *_, y in made if k == 0 and y} >= {"a.b@c.de", "a.b (at) c.de", "a.b[at]c.de"}
    assert examples([])


def test_redaction(spark):
    row = spark.createDataFrame([("é mail a.b@c.de, ip 1.2.3.4.",)], "t string")
    assert row.select(redact(F.col("t"), base_spans(F.col("t")))).first()[0] == "é mail [email], ip [ip]."


def test_trees_as_columns_equal_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, (400, 3)).astype(float)
    y = ((x[:, 0] > 4) & (x[:, 1] < 6)).astype(float)
    model = boost(x, y)
    assert ((model.margin(x) > 0) == (y == 1)).mean() > 0.99
    frame = spark.createDataFrame(x.tolist(), "a double, b double, c double")
    got = [r[0] for r in frame.select(model.column([F.col(c) for c in "abc"])).collect()]
    assert np.allclose(got, model.margin(x))
