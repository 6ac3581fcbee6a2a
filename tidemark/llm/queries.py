"""The operators applied to the driver's tables with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import bpe_round_trip, ids_text
from tidemark.llm.common import fresh_path, written
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.mixing import copies, domain_tokens, fit_rates, targets
from tidemark.llm.near_dedup import near_dedup
from tidemark.llm.pii import KINDS, find_pii, span_text
from tidemark.llm.quality import held_out, labelled_sample, score_documents, train, with_posteriors
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.top_k import top_k
from tidemark.llm.warc import read_warc, write_warc

#: Score from which a document counts as good.
QUALITY_THRESHOLD = 0.3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    found = exact_dedup(table(spark, sf_dir, "documents"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op4_exact_dedup"] = f"""
WITH n AS (SELECT doc_id, {_LOWER_SQL} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from every document."""
    found = line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_key=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_STRIP_SQL = "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
ORACLES["op8_line_dedup"] = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM split),
keyed AS (SELECT doc_id, pos, line,
    translate({_STRIP_SQL}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the multi-language rank file, decoded again."""
    found = bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids_text("ids"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives with payload deduplication and read back."""
    paths = write_warc(table(spark, sf_dir, "pages"), fresh_path(spark, "warc"), least_bytes=100)
    return read_warc(spark, paths)


ORACLES["op2_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM g
"""


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document packed into files and read back."""
    files = write_token_files(table(spark, sf_dir, "documents"), fresh_path(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_token_files(spark, files)


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return top_k(table(spark, sf_dir, "embeddings"), k=5, scale=256, query=F.col("vec_id") % 50 == 0)


ORACLES["op9_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, learned from labelled documents that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(*labelled_sample(docs, table(spark, sf_dir, "labels"), F.col("quality"), ~held_out()))
    return score_documents(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document; the counts are those of base spans."""
    found = find_pii(table(spark, sf_dir, "documents"))
    of = lambda k: F.filter("base", lambda s: s["kind"] == k)
    counts = [F.size(of(k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles have a similarity of 0.8 or more."""
    return near_dedup(table(spark, sf_dir, "documents"), words=2, percent=80)


ORACLES["op7_near_dedup"] = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex({_LOWER_SQL}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
        WHEN len(w) = 1 THEN [w[1]]
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
    FROM w
), c AS (SELECT s AS set_, list_sort(s) AS k, doc_id FROM s WHERE len(s) > 0),
first AS (SELECT k, min(doc_id) AS id, len(k) AS n FROM c GROUP BY k),
x AS (SELECT id, n, unnest(k) AS g FROM first),
pairs AS (
    SELECT a.id AS a, b.id AS b FROM x a JOIN x b ON a.g = b.g AND a.id < b.id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), e AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(id, to_) AS (SELECT id, id FROM first UNION SELECT r.id, e.b FROM reach r JOIN e ON r.to_ = e.a),
label AS (SELECT id, min(to_) AS component_id FROM reach GROUP BY id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(l.component_id, s.doc_id) AS kept
FROM s LEFT JOIN c ON c.doc_id = s.doc_id LEFT JOIN first f ON f.k = c.k LEFT JOIN label l ON l.id = f.id
"""

#: Domains in the order of label quality, and the share of tokens that each is to have in the mixture.
DOMAINS = {"low": 0.05, "clean": 0.95}


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, expected domains, rate, and how often the mixture takes it."""
    docs = table(spark, sf_dir, "documents")
    model = train(*labelled_sample(docs, table(spark, sf_dir, "labels"), F.col("quality"), ~held_out()), classes=len(DOMAINS))
    rows = written(with_posteriors(docs.select("doc_id", "text"), model).select("doc.doc_id", "n_tokens", "posterior"), "posteriors")
    rate = fit_rates(rows, targets(list(DOMAINS.values()), domain_tokens(rows, len(DOMAINS)))).rate
    return rows.select("doc_id", "n_tokens", *(F.col("posterior")[k].alias(f"p_{name}") for k, name in enumerate(DOMAINS)), rate.alias("rate"), copies(rate, F.col("doc_id")).alias("copies"))
