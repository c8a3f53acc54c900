"""Incremental ingestion of session logs with Structured Streaming.

The batch pipeline has no streaming operator of its own; what arrives
continuously is the session log. ``ingest_sessions`` keeps the canonical
event table current: new JSON-lines files in a folder are parsed with the
fixed session schema, flattened to ``(session, pos, ts, type, aid)`` and
appended to a Parquet table. The checkpoint (offsets and the file-source log)
lives under the shared ``spark.checkpoint.dir``, so a restarted query resumes
where it stopped and never writes a file twice.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from covisit_spark.session import ensure_checkpoint_dir
from covisit_spark.sources.jsonl import SESSION_SCHEMA, flatten_sessions


def ingest_sessions(
    spark: SparkSession,
    source_dir: str,
    table_dir: str,
    name: str = "sessions",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the ingestion query; ``available_now`` processes what is there
    and stops (batch-like scheduling), otherwise it runs continuously."""
    reader = spark.readStream.schema(SESSION_SCHEMA).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = flatten_sessions(reader.json(source_dir))
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    writer = events.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(table_dir)
