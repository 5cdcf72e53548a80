"""The stage chain as a stream: events name batches, each micro-batch runs the stages for those it brings.

An event is at-least-once; the stages write by key, so a repeated one changes nothing. A batch that a stage refuses
(unknown, not completed) is a permanent fault: an event on the faults topic, and the stream goes on. Other faults stop
the query, which resumes from its checkpoint."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import runs
from ..sources.store import Store

EVENT = "topic string, key string, value string, at timestamp"
INGESTED, DONE, FAULTS = "batch.ingested", "golden.updated", "faults"


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of JSON events from files in a folder; a Kafka source with the same columns can stand in."""
    return spark.readStream.schema(EVENT).json(folder)


def publish(events: DataFrame, folder: str) -> None:
    """Append events (topic, key, value, at) to a folder as JSON lines; for Kafka, write the same columns to its sink."""
    events.select("topic", "key", "value", "at").write.mode("append").json(folder)


def announce(store: Store, folder: str, at: datetime) -> int:
    """Publish completed batches that have not been, then mark them."""
    new = store.table("batch").where("status = 'completed' AND events_published_at IS NULL")
    n = new.count()
    if n:
        publish(new.select(F.lit(INGESTED).alias("topic"), F.col("batch_id").alias("key"), F.to_json(F.struct("batch_id", "source_id", "entity_type", "rows_ingested")).alias("value"), F.lit(at).alias("at")), folder)
        store.commit({"batch": store.merged("batch", new.withColumn("events_published_at", F.lit(at)))})
    return n


def process(store: Store, batch_id: str, at: datetime) -> None:
    """The stages after ingestion for one batch."""
    runs.map_batch(store, batch_id, at)
    runs.normalize_batch(store, batch_id)
    runs.validate_batch(store, batch_id, at)
    runs.resolve_batch(store, batch_id, at)
    runs.golden_batch(store, batch_id, at)


def start(store: Store, inbox: str, outbox: str, checkpoint: str) -> StreamingQuery:
    """Run the stages for each batch that the inbox announces, in the order of its batches; results to the outbox."""

    def stage(events: DataFrame, _: int) -> None:
        # events name batches: a few rows, never data
        ids = [r[0] for r in events.where(F.col("topic") == INGESTED).select("key").distinct().join(store.table("batch").select(F.col("batch_id").alias("key"), "seq"), "key", "left").orderBy("seq", "key").collect()]
        for batch_id in ids:
            at = datetime.now(timezone.utc)
            try:
                process(store, batch_id, at)
                topic, value = DONE, "{}"
            except (KeyError, ValueError) as e:
                topic, value = FAULTS, str(e)[:1000]
            publish(store.spark.createDataFrame([(topic, batch_id, value, at)], EVENT), outbox)

    return events_of(store.spark, inbox).writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
