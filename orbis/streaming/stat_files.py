"""Incremental statistics load (S5 + K5 as a Structured Streaming job).

New statistic CSV files dropped into a directory are picked up by a file
stream, and read by column name (files may differ in their headers); each micro-batch is joined to the locality dictionary and written
to its own ``epoch=<n>`` folder (overwrite, so a retried batch replaces
itself: exactly-once output).  ``latest_stats`` reads the folders back and
keeps, per (id, indicator, year), the row of the newest epoch -- the
cell-level upsert of the old store, as a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orbis.operators.statistics import build_names
from orbis.functions.parse import to_double, to_int
from orbis.sources.stats import read_stat_csv

# files of one micro-batch
MAX_FILES = 1000


def _facts(batch: DataFrame, names: DataFrame) -> DataFrame:
    nm = build_names(names)
    return batch.join(nm, batch.CITIES == nm.name).select(
        nm.id, nm.name, F.col("INDIC_UR").alias("indicator"), to_int("TIME").alias("year"),
        to_double("Value").alias("value"), F.col("Value").alias("value_raw"))


def _read_new(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """The statistics in the files of a micro-batch.  A file's header is one of its lines; files are read
    together by header, so that columns go by name whatever their order."""
    files = lines.groupBy("path").agg(F.max(F.when(F.col("value").contains("INDIC_UR") & F.col("value").contains("CITIES"),
                                                   F.col("value"))).alias("header"))
    groups: dict[str | None, list[str]] = {}
    for r in files.collect():                          # at most MAX_FILES rows
        groups.setdefault(r.header, []).append(r.path)
    if None in groups:
        raise ValueError(f"no header with CITIES and INDIC_UR in {groups[None][0]}")
    out = None
    for paths in groups.values():
        rows = read_stat_csv(spark, paths)
        out = rows if out is None else out.unionByName(rows)
    return out


def start_stat_stream(spark: SparkSession, stats_dir: str, names: DataFrame, out_path: str,
                      checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Stream ``stats_dir`` (CSV with header) into ``out_path``."""
    lines = spark.readStream.option("maxFilesPerTrigger", MAX_FILES).text(stats_dir) \
        .select("value", F.col("_metadata.file_path").alias("path"))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        if not batch.isEmpty():
            _facts(_read_new(batch.sparkSession, batch), names).write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")

    w = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def latest_stats(spark: SparkSession, out_path: str) -> DataFrame:
    """Upserted view: per (id, indicator, year) the value of the newest epoch."""
    all_rows = spark.read.parquet(out_path)
    best = all_rows.groupBy("id", "indicator", "year").agg(
        F.max_by(F.struct("name", "value", "value_raw"), "epoch").alias("r"))
    return best.select("id", F.col("r.name").alias("name"), "indicator", "year",
                       F.col("r.value").alias("value"), F.col("r.value_raw").alias("value_raw"))
