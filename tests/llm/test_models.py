import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.common import written
from tidemark.llm.mixing import copies, domain_tokens, fit_rates, mixed, targets
from tidemark.llm.quality import PRIOR, held_out, labelled_sample, pair_features, score_documents, train, with_posteriors, word_features
from tidemark.llm.queries import op5_quality, op6_mixing

SF = "/root/testdata/sf0.01"


def test_word_features_depend_on_the_word_alone():
    words = ["a", "abc", "é🙂", "x" * 500, "abc"]
    features, counts, hashes = word_features(words)
    ends = np.cumsum(counts)
    for i, w in enumerate(words):
        one, n, h = word_features([w])
        assert (features[ends[i] - counts[i] : ends[i]] == one).all() and n[0] == counts[i] and h[0] == hashes[i]
    assert len(set(pair_features(np.array([5, 5, 9, 9], np.uint64)).tolist())) == 2


def test_held_out_accuracy(spark):
    scores = op5_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    good, bad = ([r["score"] for r in scores if r["quality"] == q] for q in (1, 0))
    ordered = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert ordered > 0.97 and np.mean([r["predicted"] == r["quality"] for r in scores]) > 0.95
    assert np.mean([g >= 0.3 for g in good]) > 0.98


def test_no_leak_of_held_out_labels_or_other_columns(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one = labelled_sample(docs, labels, F.col("quality"), ~held_out())
    assert one == labelled_sample(docs.withColumn("lang", F.lit("x")), flipped, F.col("quality"), ~held_out())
    assert len(one[0]) == labels.filter(~held_out()).count()
    assert len(labelled_sample(docs, labels, F.col("quality"), ~held_out(), most=50)[0]) == 50


def test_scores_of_odd_rows(spark, odd_docs, no_docs):
    model = train(["good words here", "bad bad bad", "good text", "bad bad"], [1, 0, 1, 0])
    found = score_documents(odd_docs, model).collect()
    assert len(found) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert {r["score"] for r in found if r["doc_id"] in (1, 2, 3)} == {0.5}
    assert score_documents(no_docs, model).count() == 0
    assert {r["score"] for r in score_documents(odd_docs, train([], [])).collect()} == {0.5}
    kept = with_posteriors(odd_docs, model)
    assert kept.select("doc.*").columns == odd_docs.columns
    assert sorted(kept.select("doc.*").collect(), key=repr) == sorted(odd_docs.collect(), key=repr)


def test_three_classes():
    texts = ["red red blue", "tree leaf", "cat dog"] * 20
    p = train(texts, [0, 1, 2] * 20, 3).scorer()(pa.array(texts[:3]))[0]
    assert p.argmax(axis=1).tolist() == [0, 1, 2] and np.allclose(p.sum(axis=1), 1)


def rows(spark, n=400, seed=12):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([0.3, 0.3, 0.3], n)
    data = [(i, int(rng.integers(1, 900)), p[i].tolist()) for i in range(n)]
    return spark.createDataFrame(data, "doc_id long, n_tokens long, posterior array<double>").withColumn("doc", F.struct("doc_id"))


def expected(df, rate, k):
    return df.agg(*(F.sum(rate * F.col("n_tokens") * F.col("posterior")[i]) for i in range(k))).first()


def test_rates_meet_targets(spark):
    df = written(rows(spark), "rows")
    for weights in ([0.6, 0.3, 0.1], [1, 1, 1]):
        wanted = targets(weights, domain_tokens(df, 3))
        fit = fit_rates(df, wanted)
        assert fit.met and np.allclose(fit.have, wanted, rtol=2e-3)
        assert np.allclose(expected(df, fit.rate, 3), fit.have) and df.filter(fit.rate < 0).count() == 0


def test_rates_equal_brute_force(spark):
    """Least squares with bounds, solved in numpy over documents; weights that no document's rate must be cut for have one solution of this form."""
    df = written(rows(spark, 60), "rows")
    wanted = targets([0.2, 0.2, 0.6], domain_tokens(df, 3))
    data = df.orderBy("doc_id").collect()
    n, p = np.array([r["n_tokens"] for r in data], float), np.array([r["posterior"] for r in data])
    own, r = (p * n[:, None]).T @ p, np.ones(60)
    mass = own.sum(axis=1)

    def step(r, moments):
        root = 1 / np.sqrt(mass)
        return np.maximum(r - p @ (root * (np.linalg.pinv(root[:, None] * moments * root) @ (root * ((r * n) @ p - wanted)))), 0)

    error = lambda r: ((r * n) @ p - wanted) @ np.linalg.inv(own) @ ((r * n) @ p - wanted)
    while (np.abs((r * n) @ p - wanted) > 1e-3 * wanted).any():
        inside = (p * (n * (r > 0))[:, None]).T @ p
        then = step(r, inside)
        r = then if error(then) < error(r) else step(r, own)
    assert np.allclose([x[0] for x in df.orderBy("doc_id").select(fit_rates(df, wanted).rate).collect()], r, atol=1e-8)


def test_targets_that_no_rates_reach_are_told(spark):
    """Posteriors that are all alike can't be told apart: rates stay alike, and the miss is returned with a warning."""
    alike = written(spark.range(200).selectExpr("id AS doc_id", "10L AS n_tokens", "array(0.1D, 0.9D) AS posterior"), "rows")
    with pytest.warns(UserWarning, match="mixing"):
        fit = fit_rates(alike, targets([0.5, 0.5], domain_tokens(alike, 2)))
    assert not fit.met and alike.select(fit.rate.alias("r")).distinct().count() == 1


def test_copies_follow_rates(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.struct("id").alias("doc"))
    taken = df.select(copies(F.lit(1.3), F.col("doc_id")).alias("n"))
    assert {r["n"] for r in taken.distinct().collect()} == {1, 2}
    assert taken.agg(F.avg("n")).first()[0] == pytest.approx(1.3, abs=0.02)
    assert mixed(df, F.lit(1.0), F.col("doc_id")).count() == 20_000 and mixed(df, F.lit(0.0), F.col("doc_id")).count() == 0


def test_mixing_of_nothing(spark, no_docs):
    df = written(with_posteriors(no_docs, train([], [])), "rows")
    assert df.select(fit_rates(df, targets([1, 1], domain_tokens(df, 2))).rate).count() == 0


def test_mixing_query_meets_its_targets(spark):
    found = written(op6_mixing(spark, "/root/testdata/sf0.001"), "mixing")
    assert found.filter("rate < 0 OR copies < 0 OR abs(p_low + p_clean - 1) > 1e-9").count() == 0
    assert found.count() == 200
    low, clean, all_of = found.selectExpr("sum(rate * n_tokens * p_low)", "sum(rate * n_tokens * p_clean)", "sum(n_tokens)").first()
    assert low == pytest.approx(0.05 * all_of, rel=2e-3) and clean == pytest.approx(0.95 * all_of, rel=2e-3)


def brute_scores(model, texts):
    """Scores word by word and pair by pair."""
    out = []
    for t in texts:
        words = [w for w in re.split("[\t-\r ]+", t or "") if w]
        features, _, hashes = word_features(words)
        values = [*model.weights[features, 0].tolist(), *model.weights[pair_features(hashes), 0].tolist()]
        out.append(1 / (1 + np.exp(-(model.bias[0] + sum(values) / (len(values) + PRIOR)))))
    return out


def test_quality_query_equals_scores_word_by_word(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = train(*labelled_sample(docs, spark.read.parquet(f"{sf}/labels.parquet"), F.col("quality"), ~held_out()))
    found = {r["doc_id"]: r for r in op5_quality(spark, sf).collect()}
    data = docs.collect()
    want = brute_scores(model, [r["text"] for r in data])
    assert np.allclose([found[r["doc_id"]]["score"] for r in data], want, atol=1e-9)
    assert all(found[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in data)
    texts = ["a b", "", "c", " a  b\tc ", None, "x" * 5000]
    joint = model.scorer()(pa.array([t or "" for t in texts]))[0][:, 1]
    assert np.allclose(joint, brute_scores(model, texts), atol=1e-9)


def test_pipeline_equals_its_stages_by_hand(spark):
    from test_dedup import brute_lines, brute_near

    sf = "/root/testdata/sf0.001"
    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), name.replace(" ", "-"))
        kept.append(docs)
    quality, lines, near, mix, tokens = kept
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert [x.columns for x in kept[:4]] == [columns] * 4
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in quality.collect()}
    assert np.mean([d in ids for d, q in labels.items() if q == 1]) > 0.97 and np.mean([d in ids for d, q in labels.items() if q == 0]) < 0.3
    text = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    want = brute_lines(text(quality), 10)
    assert sorted(text(lines), key=repr) == sorted([w[:2] for w in want], key=repr)
    assert sorted(d for d, _ in text(near)) == sorted(d for d, _, _, stays in brute_near(text(lines), 5) if stays)
    assert {d for d, _ in text(near)} >= {d for d, _ in text(mix)} and len({d for d, _ in text(mix)}) >= 0.95 * len(text(near))
    whole = {d: t for d, t in text(mix)}
    import hashlib

    assert sorted(r["doc_id"] for r in tokens.collect()) == sorted(d for d, _ in text(mix))
    assert all(r["decoded_sha256"] == hashlib.sha256(whole[r["doc_id"]].encode()).hexdigest() for r in tokens.collect())


def test_mixing_stage_gives_languages_their_shares(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows, fit = corpus_pipeline.mixing_rows(spark, docs, sf)
    wanted = np.array(list(corpus_pipeline.LANGUAGES.values()))
    assert fit.met and np.allclose(fit.have / fit.have.sum(), wanted / wanted.sum(), rtol=2e-3)
    taken = mixed(rows, fit.rate, F.struct("doc.doc_id", "doc.text")).groupBy("lang").agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).collect()
    total = sum(r["n"] for r in taken)
    assert all(abs(r["n"] / total - corpus_pipeline.LANGUAGES[r["lang"]]) < 0.06 for r in taken)
    assert docs.join(mixed(rows, fit.rate, F.struct("doc.doc_id", "doc.text")), "doc_id", "left_anti").count() <= 0.02 * docs.count()


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs, stage):
    name, run = corpus_pipeline.STAGES[stage]
    for docs in (odd_docs, no_docs):
        docs = docs.withColumns({"source": F.lit("s"), "n_chars": F.lit(3).cast("long"), "posterior": F.lit("own"), "stay_id": F.lit(7), "rate": F.lit(2.0)})
        found = run(spark, docs, "/root/testdata/sf0.001").collect()
        if stage < 4:
            assert all(r.asDict().keys() == set(docs.columns) for r in found)
            assert len(found) <= 3 * docs.count()
        else:
            assert len(found) == docs.count()
        if stage in (1, 2) and docs is not no_docs and found:
            assert {r["posterior"] for r in found} == {"own"} and {None} <= {r["doc_id"] for r in found}
