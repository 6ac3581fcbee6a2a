"""A training corpus from `documents`, in five stages.

Each stage takes what the one before it kept, and its decisions take effect: rejected documents and dropped lines are
gone, one document of each near-duplicate group stays, and the mixture takes a document as often as its rate says.

Defined results, for all stages: a null text counts as empty (and becomes empty where lines are dropped). Columns of
any further names pass through the first four stages unchanged, except that n_chars, where there is one, follows the
text. Repeated rows are rows of their own, but for near-duplicates, where rows of one identifier are one document. A
row without an identifier is never learned from, links with nothing and stays. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import bpe_round_trip, ids_text
from tidemark.llm.common import written
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.mixing import Fit, domain_tokens, fit_rates, mixed, targets
from tidemark.llm.near_dedup import near_dedup
from tidemark.llm.quality import held_out, labelled_sample, train, with_posteriors
from tidemark.llm.queries import QUALITY_THRESHOLD, table

#: Share of tokens that documents of each language are to have; the first language keeps all of its tokens.
LANGUAGES = {"en": 0.55, "fr": 0.15, "de": 0.15, "es": 0.15}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject. Without any usable label none is rejected."""
    model = train(*labelled_sample(docs, table(spark, sf_dir, "labels"), F.col("quality"), ~held_out()))
    return with_posteriors(docs, model).filter(F.col("posterior")[1] >= QUALITY_THRESHOLD).select("doc.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; a document may become empty and stays."""
    found = line_dedup(docs, min_docs=10)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*(F.col(f"`{c}`") for c in docs.columns))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles have a similarity of 0.8 or more.

    All rows of the identifier that stays are kept, also repeated ones.
    """
    stay = near_dedup(docs, words=5, percent=80).filter("kept").select("doc_id").distinct()
    return docs.join(stay, "doc_id", "left_semi").unionByName(docs.filter(F.col("doc_id").isNull())).select(*docs.columns)


def mixing_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> tuple[DataFrame, Fit]:
    """Documents with their tokens (words) and posteriors of LANGUAGES, and the rates that give these their shares.

    The labelled table are the languages of the documents in `labels`; null and other languages are not learned from.
    """
    names = list(LANGUAGES)
    place = F.array_position(F.array(*map(F.lit, names)), F.col("lang")) - 1
    known = docs.select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    model = train(*labelled_sample(docs, known, F.when(place >= 0, place), ~held_out()), classes=len(names))
    rows = written(with_posteriors(docs, model), "posteriors")
    return rows, fit_rates(rows, targets(list(LANGUAGES.values()), domain_tokens(rows, len(names)), whole=0))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as a mixture takes them that raises the languages with too few tokens; rates round by a hash of identifier and text."""
    rows, fit = mixing_rows(spark, docs, sf_dir)
    return mixed(rows, fit.rate, F.struct("doc.doc_id", "doc.text"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document; a text that its ids don't decode to ends the job."""
    found = bpe_round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, check=True)
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids_text("ids"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing to target weights", mixing_stage),
    ("byte-level BPE", token_stage),
]

#: SQL can't express a trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
