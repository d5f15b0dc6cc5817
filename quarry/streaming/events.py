"""Incremental event loading as a Structured Streaming job (INC-3).

Landed event pages are a file stream. Each micro-batch is typed, rows older
than the watermark are dropped as late, and ids seen within the watermark are
dropped as repeats (``dropDuplicatesWithinWatermark``); what is left is
appended to a Parquet table partitioned by event type (SNK-2, SNK-3). The
stream's checkpoint holds both the file progress and the de-duplication
state, so a restarted run — or a lost executor — picks up exactly where the
last committed micro-batch ended.

A repeat that arrives more than the delay after its first copy is late or,
if it is itself young enough, appended again: the state forgets an id once the
watermark has passed it. Rows the watermark dropped are counted by
``late_count`` and found by ``late_rows``.

``run_into_tables`` is the exact form: each micro-batch is a run of an
``IncrementalTable``, so repeats of any age are told by the id index, late and broken
rows go to their own tables in the same batch, every event type has a table, and a
batch that comes again after a crash is known by its token and adds nothing.

``trigger(availableNow=True)`` makes it a scheduled job: read everything
landed since the last run, in bounded micro-batches, then stop.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry import schemas
from quarry.functions.naming import iso_text
from quarry.operators.incremental import IncrementalTable, events_from_feed
from quarry.sinks import type_tables
from quarry.sinks.ledger import Folder
from quarry.sinks.warehouse import Warehouse
from quarry.sources import landing


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.EVENT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    typed = events_from_feed(reader.json(landing_dir))
    # Watermarks need a zoned timestamp; the stored column stays TIMESTAMP_NTZ (UTC).
    return typed.withColumn("_instant", F.to_timestamp(iso_text(F.col("created_at"))))


def deduplicated(events: DataFrame, delay: str, key: str = "id") -> DataFrame:
    """Late rows (older than max seen time minus ``delay``) are dropped and a
    key is kept once while it is within the watermark."""
    return (
        events.withWatermark("_instant", delay)
        .dropDuplicatesWithinWatermark([key])
        .drop("_instant")
    )


def run_available(
    spark: SparkSession,
    landing_dir: str,
    target_path: str,
    checkpoint_path: str,
    delay: str = "1 day",
    key: str = "id",
    max_files_per_trigger: int | None = None,
    partition_by: tuple[str, ...] = ("type",),
) -> StreamingQuery:
    """Process everything landed so far, then stop; returns the finished query."""
    # Ids of the whole delay are state: keep them off the heap.
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    out = deduplicated(event_stream(spark, landing_dir, max_files_per_trigger), delay, key)
    query = (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target_path)
        .option("checkpointLocation", checkpoint_path)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def landed_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed event pages as a stream, broken lines marked (as ``landing.read_events``)."""
    reader = spark.readStream.schema(landing.with_corrupt(schemas.EVENT)).option("columnNameOfCorruptRecord", landing.CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return landing.marked_events(reader.json(landing_dir))


def run_into_tables(
    spark: SparkSession,
    landing_dir: str,
    table: IncrementalTable,
    checkpoint_path: str,
    warehouse: Warehouse,
    database: str = "repo_events",
    max_files_per_trigger: int | None = None,
) -> list[str]:
    """Load everything landed so far into ``table`` and a table for each event type,
    then stop; returns the names of the type tables.

    The token of a batch is the stream's own id (made with its checkpoint) and the
    batch's number, which Spark keeps for a batch that comes again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stream_id = json.loads(Folder(spark, checkpoint_path).read("metadata"))["id"]
        table.load(batch, token=f"{stream_id}:{batch_id}")
        type_tables.publish_types(table, warehouse, database)

    events = events_from_feed(landed_stream(spark, landing_dir, max_files_per_trigger), "page_path")
    query = (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return type_tables.publish_types(table, warehouse, database)


def late_count(query: StreamingQuery) -> int:
    """Rows that the watermark dropped in the batches of a finished run."""
    return sum(
        op["numRowsDroppedByWatermark"] for batch in query.recentProgress for op in batch["stateOperators"]
    )


def late_rows(spark: SparkSession, landing_dir: str, target_path: str, late_path: str, key: str = "id") -> DataFrame:
    """Landed events that never reached the target, written to a side table."""
    landed = events_from_feed(spark.read.schema(schemas.EVENT).json(landing_dir))
    there = spark.read.schema(landed.schema).parquet(target_path).select(key)
    landed.join(there, key, "left_anti").write.mode("overwrite").parquet(late_path)
    return spark.read.parquet(late_path)
