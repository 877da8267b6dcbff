r"""Line dedup (operator 10, DataFrame only).

Every line of at least ``min_chars`` code points becomes (hash of its key,
document, position).  These rows are range-partitioned by hash -- and by a salt
made from the document, one salt per shuffle partition, so a line that a third
of all documents hold is spread over all ranges -- and sorted by document and
position within the range.  A running first value streams over each sorted group:
lines of any other document than the group's first one go at once.  Only the
first occurrences (one document per line and salt) meet again, in a second range
partitioning by hash alone, where the same stream settles the smallest document.

What comes back are compressed keep bitmaps, one row per document that loses a
line: the 64-line words in which some bit is 0 (a missing word keeps all its lines).

Defined results: null or empty text is one empty line; a null doc_id sorts first
(smallest) and counts as one document; rows that repeat a doc_id count as the same
document, each with its own bitmap; an empty table gives no rows.
A key is known by 128 bits (two 64-bit hashes of different seeds).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbis.llm.common import ASCII_SPACE, doc_view, lower_ascii, shuffle_width, written

WORD = 64


def _lines() -> Column:
    return F.split("text", "\n")


def _version() -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64("text").alias("version")


def _first_seen(rows: DataFrame, *group: str) -> DataFrame:
    w = (Window.partitionBy(*group).orderBy("doc_id", "version", "pos")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.repartitionByRange(*group).withColumn("first_doc", F.first_value("doc_id").over(w))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 10) -> DataFrame:
    """``(doc_id, version, keep map<word, bits>)`` of the documents that lose lines."""
    spark = docs.sparkSession
    key = lower_ascii(F.btrim(F.col("line"), F.lit(ASCII_SPACE)))
    lines = (doc_view(docs, id_col, text_col)
             .select("doc_id", _version(), F.posexplode(_lines()).alias("pos", "line"))
             .select("doc_id", "version", "pos", key.alias("key"))
             .where(F.char_length("key") >= min_chars)
             .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                     F.pmod(F.xxhash64("doc_id"), F.lit(shuffle_width(spark))).cast("int").alias("salt"),
                     "doc_id", "version", "pos"))
    lines = written(lines, "op10-lines")
    own = F.col("doc_id").eqNullSafe(F.col("first_doc"))
    part = _first_seen(lines, "h1", "h2", "salt")
    heads = part.where(own).select("h1", "h2", "doc_id", "version", "pos")
    place = ["doc_id", "version", "pos"]
    drops = (part.where(~own).select(*place)
             .unionAll(_first_seen(heads, "h1", "h2").where(~own).select(*place)))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % WORD).cast("int"))
    words = (drops.groupBy("doc_id", "version", F.floor(F.col("pos") / WORD).cast("int").alias("word"))
             .agg(F.bitwise_not(F.bit_or(bit)).alias("bits")))
    return words.groupBy("doc_id", "version").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def _dropped_positions(keep: Column) -> Column:
    """Positions of the 0 bits of a keep bitmap."""
    def of_word(e: Column) -> Column:
        at = F.sequence(e["key"] * WORD, e["key"] * WORD + (WORD - 1))
        return F.filter(at, lambda p: F.getbit(e["value"], (p % WORD).cast("int")) == 0)
    return F.flatten(F.transform(F.map_entries(keep), of_word))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 10) -> DataFrame:
    """``docs`` as they are, in a struct ``row``, with the lines' verdict: kept
    text, n_lines, n_dropped."""
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_chars)
    all_rows = doc_view(docs, id_col, text_col, F.struct(F.col("*")).alias("row")) \
        .select("*", _version())
    joined = all_rows.alias("d").join(
        bitmaps.hint("shuffle_hash").alias("b"),
        F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.version") == F.col("b.version")),
        "left").select("d.row", "d.doc_id", "d.text", "b.keep")
    lines = _lines()
    # lines are cut and joined again only where a bitmap says so
    dropped = F.when(F.col("keep").isNotNull(), _dropped_positions(F.col("keep")))
    out = joined.select("row", "doc_id", "text", F.size(lines).cast("long").alias("n_lines"),
                        dropped.alias("dropped"))
    left = F.array_except(F.sequence(F.lit(0), (F.col("n_lines") - 1).cast("int")), F.col("dropped"))
    # the lines are bound once (else the lambda would split the text for every line)
    kept = F.transform(F.array(lines), lambda ls: F.array_join(
        F.transform(left, lambda p: F.get(ls, p)), "\n"))[0]
    return out.select(
        "row", "doc_id", "n_lines",
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("text"))
