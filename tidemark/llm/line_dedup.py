"""Line deduplication with DataFrame functions only.

Every line is exploded with its position, and its key is hashed to 128 bits. Keys that occur `min_docs` times or more
are the only ones that can be in so many documents; for these, documents are counted. The lines that go are then
(document, position), and a document is put together again, by position, of the lines that stay. All of this is
linear in the lines of a document.

Only hashes and positions are shuffled to count. A very common key is one partial count per task on the way there,
and on the way back it is joined by broadcast (see skew_join). Documents meet their positions by a name of 128 bits
of identifier and text; where many rows are alike in both, Spark's skew join splits them.

Defined results: a null or empty text is one empty line. A key shorter than `min_key` code points is never counted
and its line stays. A document is an identifier with a text: rows that repeat both count once and are treated alike;
the same identifier with another text counts again. Null identifiers are kept. Other columns pass through, but for own
ones named n_lines or n_dropped, which are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, skew_join, written

#: Characters stripped at both ends of a line.
_SPACE = " \t\x0b\x0c\r\n"


def line_key(line: Column) -> Column:
    """The line stripped of white space at both ends, with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_SPACE)), UPPER, LOWER)


def _named(row: list[str], values: list[Column], salt: str) -> list[Column]:
    """128 bits of some values, as two columns."""
    return [F.xxhash64(*values).alias(row[0]), F.xxhash64(F.lit(salt), *values).alias(row[1])]


def line_dedup(docs: DataFrame, min_docs: int = 10, min_key: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with its text replaced by the lines that stay, and the counts n_lines and n_dropped."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    row, key = ["line_row_1", "line_row_2"], ["line_key_1", "line_key_2"]
    name = _named(row, [F.col(f"`{id_col}`"), text], "row")
    each = docs.select(*name, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line")).select(*row, "pos", line_key(F.col("line")).alias("key"))
    lines = written(each.filter(F.char_length("key") >= min_key).select(*row, "pos", *_named(key, [F.col("key")], "line")), "lines")
    often = written(lines.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs), "frequent-lines")
    hits = written(skew_join(lines, often, key, "n", lines.count()).select(*row, "pos", *key), "line-hits")
    # documents of a key: one row for each, then a partial count per task
    common = hits.select(*row, *key).distinct().groupBy(*key).agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs)
    sizes = hits.groupBy(*key).agg(F.count("*").alias("n"))
    common = written(common.join(sizes, key).select(*key, "n"), "common-lines")
    gone = skew_join(hits, common, key, "n", hits.count()).groupBy(*row).agg(F.collect_set("pos").alias("gone"))
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rest = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in others if c != text_col)).alias("doc")
    joined = docs.select(rest, F.split(text, "\n", -1).alias("lines"), *name).join(gone, row, "left")
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    stay = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(places, lambda i: F.get(F.col("lines"), i)))
    return joined.select(
        *(F.array_join(stay, "\n").alias(c) if c == text_col else F.col(f"doc.`{c}`") for c in others),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
    )
