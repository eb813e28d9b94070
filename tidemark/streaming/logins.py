"""Login log as a stateless stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.logins import ingest_logins
from tidemark.schemas import LOGIN_EVENT
from tidemark.sources.sinks import append_once


def read_login_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Login events from parquet files as they arrive."""
    reader = spark.readStream.schema(LOGIN_EVENT)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def ingest_logins_stream(
    events: DataFrame, sink: str, checkpoint: str, as_of: datetime | None = None
) -> StreamingQuery:
    """Append the log rows of everything that has arrived, then stop.

    No state and no watermark: each event becomes one row. The checkpoint and the
    file sink's log make a restart continue without repeating rows.
    """
    return (
        ingest_logins(events, as_of)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_logins_into(
    events: DataFrame, sink: str, checkpoint: str, stream: str, as_of: datetime | None = None
) -> StreamingQuery:
    """Append the log rows of everything that has arrived to a table, then stop.

    The table is one of :func:`ensure_batch_table`. Each batch is a load named by the
    stream and its number, visible in one call, so that a batch that is run again, after
    a failure or from a checkpoint that was lost, is ignored. Any reader of the table sees
    whole batches.
    """

    def add(rows: DataFrame, number: int) -> None:
        append_once(rows, sink, f"{stream}-{number:010d}")

    return (
        ingest_logins(events, as_of)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
