"""Exact dedup by a tree merge of sorted digest runs (operator 1, DataFrame only).

Every scan partition starts one run: its texts' digests, sorted and merged to
one row per digest.  Runs are numbered with ``rounds`` digits of base ``radix``.
In round *r* the ``radix`` runs that differ in digit *r* only exchange pieces:
a run keeps the digests whose own bucket has its digit and sends the rest to its
partners, and each merges what it gets (``min`` of the identifiers, sum of the
counts).  After the last round bucket *b* of the digests lies merged in run *b*.
A digest that a third of all rows carry is one row per run from the start and
shrinks ``radix``-fold a round, so no task ever gathers a hot group.  The way back
hands each group's answer down the same tree.

Equality is decided on SHA-256, the length and an independent 64-bit hash of the
normalised text together, at every level.

Defined results: null text counts as empty; a null doc_id sorts after all
others; of rows that agree in doc_id and text one (the first read) is kept; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbis.llm.common import ASCII_SPACE_CLASS, doc_view, written

KEY = ["digest", "n_bytes", "check"]


def _digit(slot: Column, r: int, radix: int) -> Column:
    return F.floor(slot / F.lit(radix ** r)) % radix


def _exchange(level: DataFrame, r: int, radix: int, width: int) -> Column:
    """The run that holds a row after round ``r``: digit r now the digest's own."""
    bucket = F.pmod(F.xxhash64("digest"), F.lit(width))
    return (F.col("slot") + (_digit(bucket, r, radix) - _digit(F.col("slot"), r, radix))
            * radix ** r).cast("long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                radix: int = 16, rounds: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    width = radix ** rounds
    norm = F.regexp_replace("text", ASCII_SPACE_CLASS + "+", " ")
    rows = (doc_view(docs, id_col, text_col)
            .select("doc_id", norm.alias("norm"))
            .select("doc_id", F.unhex(F.sha2("norm", 256)).alias("digest"),
                    F.octet_length("norm").alias("n_bytes"), F.xxhash64("norm").alias("check"),
                    F.pmod(F.spark_partition_id(), F.lit(width)).cast("long").alias("slot"),
                    F.monotonically_increasing_id().alias("row")))
    rows = written(rows, "op1-digests")

    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    levels = [rows.groupBy("slot", *KEY).agg(F.min(first).alias("first"), F.count("*").alias("n"))]
    for r in range(rounds):
        levels.append(levels[-1].withColumn("slot", _exchange(levels[-1], r, radix, width))
                      .groupBy("slot", *KEY)
                      .agg(F.min("first").alias("first"), F.sum("n").alias("n")))

    # the answers of groups of two or more, handed down run by run
    answer = levels[-1].where("n > 1")
    for r in reversed(range(rounds)):
        lower = levels[r].select(*KEY, "slot", _exchange(levels[r], r, radix, width).alias("up"))
        above = answer.select(*KEY, F.col("slot").alias("up"), "first", "n")
        answer = lower.join(above, ["up", *KEY]).select("slot", *KEY, "first", "n")

    out = rows.join(answer, ["slot", *KEY], "left")
    return out.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
