"""Re-runnable load driven by Structured Streaming.

New payload documents landed in a folder are picked up by a file stream and
loaded into the warehouse by ``foreachBatch``.  The stream's checkpoint tracks
which files were read; a batch is loaded under an id made of that checkpoint
and the epoch, and a load replaces whatever an earlier run of the same id
wrote.  So a batch that is replayed (after a driver or executor loss, at any
point of the load) leaves the tables as one run does, and streams with
different checkpoints never share an id.  One stream loads a warehouse at a time.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wagelens.sources import landing as L
from wagelens.sources.warehouse import Warehouse
from wagelens.session import scratch_path
from wagelens.streaming.gold_view import GoldView


def batch_load_id(checkpoint: str, epoch_id: int) -> str:
    """The load id of one batch of the stream that keeps its state in ``checkpoint``."""
    return f"{hashlib.sha1(checkpoint.rstrip('/').encode()).hexdigest()[:16]}-{epoch_id}"


def start(spark: SparkSession, landing_dir: str, warehouse_root: str, checkpoint: str | None = None,
          available_now: bool = True, keep_view: bool = False) -> StreamingQuery:
    """Stream ``<code>.json`` documents from ``landing_dir`` into the warehouse at ``warehouse_root``.

    ``keep_view`` also writes each batch's moments for the summaries (``gold_view``).
    """
    checkpoint = checkpoint or scratch_path(spark, "stream-" + warehouse_root.rstrip("/").split("/")[-1])
    wh = Warehouse(spark, warehouse_root)
    raw = (spark.readStream.format("text").option("wholetext", True).load(landing_dir)
           .select(F.col("_metadata.file_path").alias("file"), "value"))

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        wh.load(L.observations_from_documents(L.documents(batch)), load_id=batch_load_id(checkpoint, epoch_id))
        if keep_view:
            GoldView(wh).refresh()

    writer = raw.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
