"""The live form of the batch job.

The ingest time is the trigger time of the micro-batch. It is part of the streaming plan and stored
with the batch's offsets, so a batch that runs again after a failure gets the same time, the same
paths, and replaces its earlier output. A batch that crosses a window border belongs to the window it
started in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import enrich
from ..plans.pipeline import run_batch


def start(
    messages: DataFrame,
    output: str,
    rejects: str | None,
    checkpoint: str,
    factory: Callable[[], enrich.Invoke] | None = None,
    policy: enrich.CallPolicy | None = None,
    *,
    available_now: bool = False,
    interval: str = "30 seconds",
    max_object_bytes: int | None = None,
    **options,
) -> StreamingQuery:
    """Start the job on a stream with a ``raw`` column; stop it with ``query.stop()``.

    ``available_now`` handles what is there and ends. Every batch writes files of its own. By default the write needs
    no shuffle; ``max_object_bytes`` rotates the files of each batch by size, as the batch job does. With ``writer`` batches
    fill up the files that earlier ones left open (see ``objects.write_objects``), and with ``rejects=None`` the rejects of a batch are
    committed with its records.
    """
    timed = messages.withColumn("ingest_ts", F.current_timestamp())

    def write(batch: DataFrame, batch_id: int) -> None:
        run_batch(
            batch, output, rejects, factory, policy, batch_id=batch_id, max_object_bytes=max_object_bytes, **options
        )

    writer = timed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
