"""What the operators of this folder share: text rules, shared-folder tables,
shipping of Python helpers, connected components."""

from __future__ import annotations

import ctypes
import sys
import uuid
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbis.session import table_path

# fixed values: the six ASCII white-space characters U+0020 and U+0009..U+000D
ASCII_SPACE = " \t\n\x0b\x0c\r"
ASCII_SPACE_CLASS = r"[\x20\x09-\x0D]"
BATCH_SETTING, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship(module_name: str) -> None:
    """Pickle the functions of a module by value, so that executors need not
    have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def process_cache() -> dict:
    """A dictionary that lives as long as the Python process: functions pickled by
    value get new module globals in each task, this stays.  Only for bounded,
    recomputable look-ups."""
    holder = sys.modules.setdefault("_orbis_llm_process_cache", ModuleType("_orbis_llm_process_cache"))
    return holder.__dict__.setdefault("kept", {})


def drop_caches() -> None:
    """Forget what other operators' tasks left in this Python worker (workers are reused)."""
    process_cache().clear()


def release_memory() -> None:
    """Hand freed memory back to the system.  Python workers outlive their tasks and
    wait beside the JVM; what they hold counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc only
    if trim is not None:
        trim(0)


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """White-space words (ASCII) of a block of texts, found by Arrow's kernels:
    (offsets of the texts, number of each word, distinct words by number).  A text without
    words has the one word ``""``."""
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    coded = words.values.slice(words.offsets[0].as_py(), len(words.flatten())).dictionary_encode()
    offsets = words.offsets.to_numpy(zero_copy_only=False)
    return offsets - offsets[0], coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def gather(parts: list[bytes], number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenates ``parts[i]`` (unsigned 32-bit integers as bytes) for i in ``number``:
    (all integers, end of each part)."""
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    flat = np.frombuffer(b"".join(parts), "<u4")
    size_of = size[number]
    ends = np.cumsum(size_of)
    shift = (np.cumsum(size) - size)[number] - (ends - size_of)
    at = np.repeat(shift, size_of) + np.arange(ends[-1] if len(ends) else 0)
    return flat[at], ends


def lower_ascii(col: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(col, UPPER, UPPER.lower())


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def limit_batches(spark: SparkSession) -> None:
    """Python tasks get Arrow batches of about ``BATCH_BYTES`` instead of Spark's default of
    64 MB, whatever the length of the texts.  This is a setting of the session (it is
    read when the plan runs); a value that the user has set stays."""
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def doc_view(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             *extra: Column) -> DataFrame:
    """Only the id and the text (null: empty) under names of our own, so that
    no other column of ``docs`` can clash with a working column."""
    limit_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), *extra)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir`` and read
    it back: the lineage ends there, so a lost executor costs a re-read."""
    spark = df.sparkSession
    path = table_path(spark, "orbis-llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("error").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table made by ``written`` that no later plan reads."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``edges (a long, b long)`` -> ``(node, root)``: one row for each node
    that an edge names, ``root`` the smallest node reachable from it.

    Each round hooks every node below the smallest neighbour's parent and then
    halves the paths (label = label of the label), so rounds grow with the
    logarithm of a component's width.  All steps are joins and grouped minima
    with map-side combining; a hub node is split by AQE's skew join, and every
    round is a written table.  Edges inside one component are dropped as soon as
    both ends carry the same label."""
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"),
                                                 F.greatest("a", "b").alias("b")).distinct(), f"{name}-e")
    label = written(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                    .select("node", F.col("node").alias("root")), f"{name}-0")
    live, step = edges, 0
    while not live.isEmpty():
        step += 1
        # live edges join *labels*: a and b are roots of two different trees.
        # Every root hooks onto its smallest neighbour if that one is smaller.
        hook = (live.select("a", "b").union(live.select("b", "a"))
                .groupBy(F.col("a").alias("r")).agg(F.min("b").alias("m"))
                .select("r", F.least("r", "m").alias("to")))
        hook = written(hook, f"{name}-h{step}")
        while True:                    # pointer jumping until the hooks are flat
            up = hook.select(F.col("r").alias("to"), F.col("to").alias("to2"))
            jumped = written(hook.join(up, "to", "left")
                             .select("r", F.coalesce("to2", "to").alias("to"),
                                     (F.coalesce("to2", "to") < F.col("to")).alias("moved")),
                             f"{name}-j{step}")
            hook = jumped.select("r", "to")
            if jumped.where("moved").isEmpty():
                break
        label = written(label.join(hook, label["root"] == hook["r"], "left")
                        .select("node", F.coalesce("to", "root").alias("root")), f"{name}-{step}")
        ha = hook.select(F.col("r").alias("a"), F.col("to").alias("ta"))
        hb = hook.select(F.col("r").alias("b"), F.col("to").alias("tb"))
        live = written(live.join(ha, "a").join(hb, "b").where("ta <> tb")
                       .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
                       .distinct(), f"{name}-e{step}")
    return label
