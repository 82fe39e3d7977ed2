"""Session helpers for tests, the bench and the driver entry point.

The library itself never creates a session: every operator takes and
returns DataFrames. These helpers only exist so that tests and the bench
start Spark the same way, and so that jobs that must write intermediate
data find the shared folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "entiscore",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UI off).
    ``conf`` adds settings (e.g. an event-log folder for the bench)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; without it this raises, for a folder of one machine would lose data.
    Only a ``local`` master (tests, bench) gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="entiscore-ckpt-")
    sc.setCheckpointDir(shared)
    return sc.getCheckpointDir() or shared


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared checkpoint folder and read back, so that
    later jobs survive lost executors and do not run its plan again."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    frame = df.sparkSession.read.schema(df.schema).parquet(path)
    frame._stored_at = path
    return frame


def discard(*frames: DataFrame) -> None:
    """Delete the tables of frames that :func:`stored` returned, once every
    frame that reads them has itself been stored (later reads of them fail)."""
    for frame in frames:
        sc = frame.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(frame._stored_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
