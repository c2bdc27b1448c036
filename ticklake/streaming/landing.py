"""Continuous loading of telemetry files dropped into a landing folder.

Structured Streaming reads new TSV files as text; every micro-batch is handed
to the same validated load as the batch path (``IngestJob``) through
``foreachBatch``. The load's batch id is the stream's own id and the micro-batch
epoch, and both outputs replace that batch's partition, so an epoch that is
replayed after a failure rewrites the same rows instead of appending twice
(exactly-once end to end with the file source's checkpoint). The stream id is
drawn once and kept beside the checkpoint: streams into one fact, or a stream
that starts over with a new checkpoint, never share batch ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake.plans.ingest import IngestJob
from ticklake.sinks.tables import path_exists
from ticklake.sources.tsv import parse_lines


def stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The id of the stream with this checkpoint; drawn and stored at its first start."""
    path = f"{checkpoint_location.rstrip('/')}/stream_id"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(uuid.uuid4().hex[:12],)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).head()[0]


def start_landing_stream(spark: SparkSession, landing_dir: str, job: IngestJob,
                         checkpoint_location: str, available_now: bool = True,
                         max_files_per_trigger: int | None = None,
                         query_name: str = "telemetry_landing") -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(landing_dir).select(
        "value", F.col("_metadata.file_path").alias("archivo_origen"),
        F.col("_metadata.file_block_start").alias("block_start"))

    own = stream_id(spark, checkpoint_location)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        job.run(parse_lines(batch), f"stream-{own}-{epoch_id:08d}", stats=False)

    writer = (lines.writeStream.queryName(query_name).foreachBatch(load_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
