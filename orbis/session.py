"""Session helpers.

Library code never builds its own session: every public function takes the
caller's ``SparkSession`` or DataFrames.  ``local_session`` is for tests, the
bench and the command line only.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings of the sessions made here.  The library changes none of a caller's session: it relies on
# Spark's defaults (AQE re-plans joins from runtime sizes, splits skewed shuffle partitions and
# coalesces small ones) and on no time zone or map policy.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# scratch folders of local applications without a checkpoint folder
_SCRATCH: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "orbis") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised tables and checkpoints.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system); without it this raises, since a folder of one machine is not seen by
    the others.  Only on one host (``local[..]``: tests, the bench) an unset folder
    is a scratch folder, the same one for the life of the application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _SCRATCH:
            _SCRATCH[app] = tempfile.mkdtemp(prefix="orbis-ckpt-")
        root = _SCRATCH[app]
    return root.rstrip("/")


def table_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([checkpoint_root(spark)] + [p.strip("/") for p in parts])


def committed(spark: SparkSession, path: str) -> bool:
    """True when a finished write (its ``_SUCCESS`` marker) is at ``path``,
    on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    marker = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return bool(marker.getFileSystem(conf).exists(marker))
