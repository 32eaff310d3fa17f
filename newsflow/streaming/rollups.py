"""Live log rollups: every micro-batch adds its counts, and reading sums them up.

The counts of a batch are small and additive, so they need no state and a late line is never lost: it is counted into its
minute, and told apart in ``late`` if that lies more than ``delay`` before the latest minute of earlier batches. A batch that
runs again replaces its counts. The folder grows by one small file per batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import monitor
from ..operators.rollups import LOG_KEYS, log_counts

DELAY = "10 minutes"
_SUMS = ("lines", "attempts", "with_attempt", "tickers", "with_tickers")
_SCHEMA = (
    "minute timestamp, logger string, level string, event string, ticker string, lines long, attempts long, with_attempt long, "
    "tickers long, with_tickers long, most_tickers long, late long, batch long"
)


def start_rollups(
    logs: DataFrame, output: str, checkpoint: str, *, delay: str = DELAY, available_now: bool = False, interval: str = "1 minute"
) -> StreamingQuery:
    """Start the job on a stream of service log lines (see ``schema.SERVICE_LOG``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # A number per batch is what keeps a batch that runs again from counting twice.
        add_counts(batch, output, batch_id, delay)

    writer = logs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def add_counts(logs: DataFrame, output: str, batch_id: int, delay: str = DELAY) -> None:
    """Add the counts of one batch of log lines."""
    counts = log_counts(monitor.log_fields(logs))
    seen = _stored(logs.sparkSession, output).where(F.col("batch") < batch_id).agg(F.max("minute")).first()[0]
    is_late: Column = F.lit(False) if seen is None else F.coalesce(F.col("minute") < F.lit(seen) - F.expr(f"INTERVAL {delay}"), F.lit(False))
    told = counts.withColumn("late", F.when(is_late, F.col("lines")).otherwise(F.lit(0))).withColumn("batch", F.lit(batch_id).cast("long"))
    _replace(told, output)


def _replace(rows: DataFrame, output: str) -> None:
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(output)


def _stored(spark: SparkSession, output: str) -> DataFrame:
    root = spark._jvm.org.apache.hadoop.fs.Path(output)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(output)


def read_counts(spark: SparkSession, output: str) -> DataFrame:
    """All counts so far, one row per minute, logger, level, event and ticker: the input of the functions in ``operators.rollups``."""
    sums = [F.sum(c).alias(c) for c in (*_SUMS, "late")]
    return _stored(spark, output).groupBy(*LOG_KEYS).agg(*sums, F.max("most_tickers").alias("most_tickers"))

