"""Session settings the package relies on, and lineage cuts that survive executor loss."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job needs for right results.
#   timeZone            window labels and ISO text are UTC, whatever the host says
#   allowDuplicateKeys  a repeated JSON key keeps its last value instead of failing the parse
#   overwrite mode      a replayed micro-batch replaces only its own partitions
#   arrow batches       bound what a Python task holds, by rows and for long bodies by bytes (Spark's own limit is 64 MB)
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

# Settings that only matter for speed; a cluster's own choice wins where it is already set.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "newsflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING_CONF, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session, where driver and tasks share one disk, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="newsflow-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


_run: ContextVar[str | None] = ContextVar("run_folder", default=None)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Keep what ``materialize`` stores meanwhile in one folder, and remove it at the end.

    For jobs that write their results inside: a DataFrame that reads the stored tables later would miss them.
    """
    folder = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a scan of it.

    Unlike a cache it survives lost executors, and later passes read only the columns they need; of the columns in ``by``
    each value has files of its own.
    """
    spark = df.sparkSession
    path = f"{_run.get() or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
