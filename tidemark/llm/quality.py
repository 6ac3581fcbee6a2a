"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of hashed features: each of its words, the character n-grams of each
word between boundary marks, and each pair of neighbouring words (whose hash is the exclusive or of the two, so that a
word said twice is one feature whatever the word). PRIOR empty features belong to each document, so that a text of
few words stays near the labels' share. A softmax over that average gives the label. Vectors and output weights are trained on
the driver with numpy stochastic gradient descent over a bounded sample of labelled documents (SAMPLE_DOCS, those
with the smallest hashes of their identifiers); every document is scored whole.

Beside the plain method: the pairs of words are added features, the step of a document's vectors is taken relative to
the largest share in its average (else long documents would hardly move theirs), and the biases stay at the labels'
shares, so that a text without features has just these.

As the output is linear in the average, a feature's vector acts on a score only through its product with the output
weights: executors get that one number per feature, and remember the sum for each word they have met, up to a number
of bytes (words.MEMO_BYTES). Words are what ASCII white space separates.

Defined results: a null text counts as empty. A text without words has the score of the labels' share (0.5 without
any label). Where labels repeat an identifier, the smallest label counts; where documents do, the least text is
learned from. Null labels and labels of absent documents
are ignored. Identifiers, null or repeated, pass through, a row for each row; other columns are ignored. Empty tables
give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import chunks
from tidemark.llm.common import small_batches, smallest_hashes
from tidemark.llm.words import Memo, hold, release, run_sums, words_of

#: Labelled documents to learn from, at most, and bytes of their texts, at most.
SAMPLE_DOCS = 4000
SAMPLE_BYTES = 64 << 20
#: Hash buckets of features, and length of their vectors.
BUCKETS = 1 << 17
DIM = 16
#: Lengths of character n-grams.
NGRAMS = (2, 3, 4)
#: Features without a vector that count in every average.
PRIOR = 40
EPOCHS = 5
RATE = 2.0
SEED = 7
#: Bytes of text scored at a time.
CHUNK_BYTES = 1_000_000
#: Characters of new words whose features are made at a time.
PART_CHARS = 100_000

_M = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(29))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the words, one after the other; the number of features of each; and a hash of each word."""
    hashes = np.zeros(len(words), np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = 1 + sum(np.maximum(lengths + 3 - n, 0) for n in NGRAMS)
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(words) else 0, np.int64)
    order = np.argsort(lengths, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(words) else []:
        length = int(lengths[rows[0]])
        width = length + 2
        for k in range(0, len(rows), max(1, 2_000_000 // width)):
            part = rows[k : k + max(1, 2_000_000 // width)]
            raw = "".join([f"<{words[i]}>" for i in part]).encode("utf-32-le", "surrogatepass")
            codes = np.frombuffer(raw, np.uint32).reshape(-1, width).astype(np.uint64) + np.uint64(1)
            powers = np.cumprod(np.full(width, _M))
            whole = (codes * powers).sum(axis=1, dtype=np.uint64) + np.uint64(width)
            hashes[part] = whole
            found = [whole[:, None]]
            for n in NGRAMS:
                if width >= n:
                    h = np.zeros((len(part), width - n + 1), np.uint64)
                    for j in range(n):
                        h = h * _M + codes[:, j : width - n + 1 + j]
                    found.append(h + np.uint64(n))
            features = _mixed(np.concatenate(found, axis=1))
            at = (ends[part] - counts[part])[:, None] + np.arange(features.shape[1])
            out[at] = features
    return out, counts, hashes


def pair_features(hashes: np.ndarray) -> np.ndarray:
    """Features of neighbouring words, by the words' hashes."""
    return _mixed((hashes[:-1] ^ hashes[1:]) + np.uint64(1))


@dataclass
class Model:
    """What a score needs, relative to class 0: the weight of every feature (a column per further class), and the biases."""

    weights: np.ndarray
    bias: np.ndarray

    def scorer(self):
        """Function from an array of texts to posteriors (a column per class) and word counts; it remembers words between calls."""
        width = len(self.bias) + 2  # of a word: the sum of its weights for each further class, its features, its hash

        def make(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            held = np.empty((len(words), width), np.uint64)
            parts = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) // PART_CHARS
            for rows in np.split(np.arange(len(words)), np.flatnonzero(np.diff(parts)) + 1):  # features take a hundred times their word
                features, counts, hashes = word_features([words[i] for i in rows.tolist()])
                held[rows, :-2] = np.add.reduceat(self.weights[features], np.cumsum(counts) - counts, axis=0, dtype=np.float64).view(np.uint64)
                held[rows, -2], held[rows, -1] = counts, hashes
            return held.reshape(-1), np.full(len(words), width)

        memo = Memo(make, np.uint64)

        def score(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            codes, starts, words = words_of(texts)
            first, _ = memo.find(words)
            held = memo.flat[first[:, None] + np.arange(width)]
            sums, counts, hashes = held[:, :-2].copy().view(np.float64), held[:, -2].astype(np.float64), held[:, -1]
            n = np.diff(starts)
            values = sums[codes]
            if len(codes) > 1:
                pairs = self.weights[pair_features(hashes[codes])].astype(np.float64)
                between = starts[1:-1][(starts[1:-1] > 0) & (starts[1:-1] < len(codes))]
                pairs[between - 1] = 0  # a text's last word and the next one's first are no pair
                values[:-1] += pairs
            features = run_sums(counts[codes], starts) + np.maximum(n - 1, 0) + PRIOR
            z = np.zeros((len(n), len(self.bias) + 1))
            z[:, 1:] = self.bias + run_sums(values, starts) / features[:, None]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            return p / p.sum(axis=1, keepdims=True), n

        return score


def train(texts: list[str], labels: list[int], classes: int = 2) -> Model:
    """A model of labels 0 to classes - 1, by stochastic gradient descent over the documents in a fixed random order."""
    y = np.array(labels, np.int64)
    if not len(y):
        return Model(np.zeros((BUCKETS, classes - 1), np.float32), np.zeros(classes - 1))
    share = (np.bincount(y, minlength=classes) + 1) / (len(y) + classes)
    random = np.random.default_rng(SEED)
    vectors = (random.random((BUCKETS, DIM), np.float32) - np.float32(0.5)) / DIM
    out = np.zeros((DIM, classes), np.float32)
    bias = np.log(share).astype(np.float32)  # fixed: a text without features has the share
    docs = []
    for text in texts:
        codes, _, words = words_of(pa.array([text], pa.string()))
        features, _, hashes = word_features(words.take(pa.array(codes)).to_pylist())
        at, n = np.unique(np.concatenate([features, pair_features(hashes)]), return_counts=True)
        docs.append((at, (n / (n.sum() + PRIOR)).astype(np.float32)))
    steps, step = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(docs)):
            at, weight = docs[i]
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            if not len(at):
                continue
            mean = weight @ vectors[at]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1  # the gradient of the loss by z
            back = out @ p
            out -= rate * np.outer(mean, p)
            # every vector's share of the average scales its gradient; the step is taken relative to the largest share
            vectors[at] -= rate * np.outer(weight / weight.max(), back)
    return Model((vectors @ (out[:, 1:] - out[:, :1])).astype(np.float32), (bias[1:] - bias[0]).astype(np.float64))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, learn: Column, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE_DOCS) -> tuple[list[str], list[int]]:
    """Texts and labels of at most `most` labelled documents for which `learn` (a condition on doc_id) holds."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), label.cast("int").alias("label"))
    known = known.filter(learn & F.col("doc_id").isNotNull() & F.col("label").isNotNull()).groupBy("doc_id").agg(F.min("label").alias("label"))
    picked = smallest_hashes(known.withColumn("h", F.xxhash64("doc_id")), "h", ["doc_id"], most).drop("h")  # a bounded number of rows: broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    # by rising identifier as many as SAMPLE_BYTES hold; what the driver gets first are sizes
    sizes = sorted(one.select("doc_id", F.octet_length("text").alias("n")).collect())
    fits = np.cumsum([r["n"] for r in sizes]) <= SAMPLE_BYTES
    chosen = rows.sparkSession.createDataFrame([(r["doc_id"],) for r, ok in zip(sizes, fits, strict=True) if ok], "doc_id long")
    found = sorted(one.join(F.broadcast(chosen), "doc_id", "left_semi").collect()) if fits.any() else []
    return [r["text"] for r in found], [r["label"] for r in found]


def posteriors(model: Model, text: Column) -> Column:
    """Struct of a text's words counted (n_tokens) and its posteriors. Only texts go to Python."""

    @F.arrow_udf("n_tokens long, posterior array<double>")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hold()  # what another operator keeps
        score = model.scorer()
        for batch in texts:
            found, counts = [], []
            for part in chunks(pa.RecordBatch.from_arrays([batch], ["text"]), most=CHUNK_BYTES):
                p, n = score(part["text"])
                found.append(p)
                counts.append(n)
            p = np.concatenate(found) if found else np.zeros((0, len(model.bias) + 1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.reshape(-1)))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(counts) if counts else [], pa.int64()), lists], ["n_tokens", "posterior"])
            release()

    return scored(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the score of every whole text: the posterior of class 1."""
    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), posteriors(model, F.col(text_col)).alias("s"))
    return rows.select("doc_id", F.col("s.posterior")[1].alias("score"))


def with_posteriors(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every row of docs as a struct `doc`, with its words counted (n_tokens) and its posteriors."""
    return small_batches(docs).select(F.struct("*").alias("doc"), posteriors(model, F.col(text_col)).alias("s")).select("doc", "s.n_tokens", "s.posterior")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its identifier as text, mod 5, is 0; false for a null one."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
