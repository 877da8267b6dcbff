"""City statistics sources.

The statistics CSV has a header and four text columns; a whole directory is
read at once (every file, not just the first, Q8), with the file each row
came from kept as ``source_file``.  Locality ids become ``r<id>`` (Q8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAT_CSV_SCHEMA = T.StructType([
    T.StructField("TIME", T.StringType()),
    T.StructField("CITIES", T.StringType()),
    T.StructField("INDIC_UR", T.StringType()),
    T.StructField("Value", T.StringType()),
])

NAMES_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
])


def _read_named(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """A headed CSV read by column *name*, all text; other columns are not kept.
    Raises if a column is missing, or if the files under ``path`` have different
    headers (Spark reads a folder by its first file's)."""
    raw = spark.read.option("header", True).option("enforceSchema", False) \
        .option("inferSchema", False).csv(path)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}; the header has {raw.columns}")
    return raw.select(*[F.col(f"`{f.name}`") for f in schema.fields],
                      F.col("_metadata.file_path").alias("source_file"))


def read_stat_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S4 + S5: all statistic files under ``path``, all columns as text, with the
    file each row came from."""
    return _read_named(spark, path, STAT_CSV_SCHEMA)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """The ``id,name`` dictionary of localities."""
    return _read_named(spark, path, NAMES_SCHEMA).select("id", "name")
