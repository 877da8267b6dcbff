"""The corpus pipeline: quality classifier, line dedup, SimHash near-dedup, suffix-array
dedup, packing.

Each stage takes the documents that the stage before left (columns as in ``documents``),
and its decisions take effect: rejected documents go, dropped lines and repeated
passages leave the text (``n_chars`` follows), one document of each near-duplicate group
stays.  The last stage returns the packed pieces with their token ids.

Defined results: ``doc_id`` and ``text`` are needed, other columns of whatever names are
handed on as they are (``n_chars`` is made anew if it is there); null and empty texts are
judged as empty ones and, if kept, are packed as the end id; texts of any length are read whole; a null
doc_id is an id of its own; repeated rows are near copies of each other, so one stays;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbis.llm import line_dedup, packing, quality_classifier, simhash, suffix_dedup
from orbis.llm.common import written
from orbis.llm.queries import tokenizer_path


def _with_text(row: str, text: str, columns: list[str]) -> list:
    """The columns of the documents with another text and its length."""
    new = {"text": F.col(text), "n_chars": F.char_length(text).cast("long")}
    return [new[c].alias(c) if c in new else F.col(f"{row}.`{c}`") for c in columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score 0.7 or more)."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_classifier.quality_filter(docs, labels)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds go; documents stay."""
    return line_dedup.line_dedup(docs).select(*_with_text("row", "text", docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash links (3-word shingles, 2 bits) stays."""
    return simhash.near_dedup(docs, shingle=3, max_bits=2)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes inside repeated 200-byte strings go.  A character of which a cut left only a
    part goes too, so that the text stays valid UTF-8."""
    cut = suffix_dedup.suffix_dedup(docs)
    whole = suffix_dedup.whole_characters(F.when(F.col("n_removed") > 0, F.col("kept")))
    text = F.coalesce(whole, F.col("kept").cast("string"))
    named = cut.withColumn("text", text)
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"),
           "n_chars": F.char_length("text").cast("long")}
    return named.select(*[new[c].alias(c) if c in new else F.col(f"rest.`{c}`").alias(c)
                          for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document, with their ids."""
    return packing.pack(docs, tokenizer_path(), max_length=4096, end_id=2, keep_ids=True)


STAGES = [("quality classifier", keep_quality), ("line dedup", drop_lines),
          ("SimHash near-dedup", drop_near_copies), ("suffix-array dedup", drop_passages),
          ("packing", pack)]

#: none: the classifier, the fingerprints and the tokenizer are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a written table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{k}")
    return docs
