"""S4, S5, U1-U3 on streams: upload events to a catalogue of current files.

Events arrive as JSON values (a Kafka topic in production; any stream with
a ``value`` column works, e.g. JSON-lines files in tests).  Two forms:

* ``start_catalogue``: each micro-batch reduces its valid events to the latest
  one per name (grouped max, partial aggregation).
* ``start_catalogue_state``: the latest event per name is the state of a
  streaming aggregation, and a batch hands on the names it touched.  Late
  events (older than the state) change nothing.  State grows with the names,
  not the events; for very many names set the RocksDB state store.

Either way a batch's rows go to a ``RunStore``: runs in levels, so a read takes
few files however many batches there were; replays replace.  Rejected events
go to their own folder instead of being lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logscan.operators.uploads import decode_event, encode_event, landing_key, latest_uploads, object_key
from logscan.sources.run_store import RunStore

# Fixed values (as in the reference): topic and consumer group.
UPLOAD_TOPIC = "logs.upload"
UPLOAD_GROUP = "upload-group"


def kafka_events(spark: SparkSession, servers: str, topic: str = UPLOAD_TOPIC,
                 group: str = UPLOAD_GROUP, starting_offsets: str = "earliest") -> DataFrame:
    """Upload events from Kafka (needs the spark-sql-kafka package)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("kafka.group.id", group)
            .option("startingOffsets", starting_offsets).load())


def publish_events(events: DataFrame, servers: str, topic: str = UPLOAD_TOPIC) -> None:
    """Publish batch events as JSON values without key (Kafka sink)."""
    (encode_event(events).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def json_line_events(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stand-in for the topic: every line of every file is one value."""
    r = spark.readStream.format("text")
    return (r.option("maxFilesPerTrigger", int(max_files_per_trigger)) if max_files_per_trigger else r).load(folder)


def catalogue_store(spark: SparkSession, path: str, fanout: int = 4, buckets: int = 8) -> RunStore:
    return RunStore(spark, path, "fileName", latest_uploads, fanout, buckets)


def _entries(current: DataFrame) -> DataFrame:
    return (current.select("fileName", "uploadTime", "filePath").withColumn("object_key", object_key("filePath"))
            .withColumn("landing_key", landing_key("fileName", "uploadTime")))


def _decoded(events: DataFrame) -> DataFrame:
    return decode_event(events.withColumn("raw", F.col("value").cast("string")), keep=["raw"])


def _write_rejects(rows: DataFrame, batch_id: int, path: str) -> None:
    (rows.select("raw", F.lit(batch_id).alias("batch_id"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def _started(writer, checkpoint: str, available_now: bool, trigger: str) -> StreamingQuery:
    w = writer.option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()


def start_catalogue(spark: SparkSession, events: DataFrame, catalogue_path: str, reject_path: str,
                    checkpoint: str, available_now: bool = True, trigger: str = "1 minute",
                    fanout: int = 4, buckets: int = 8) -> StreamingQuery:
    store = catalogue_store(spark, catalogue_path, fanout, buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            _write_rejects(batch.where(~F.col("is_valid")), batch_id, reject_path)
            store.commit(batch_id, _entries(latest_uploads(
                batch.where("is_valid").select("fileName", "uploadTime", "filePath"))))
        finally:
            batch.unpersist()

    return _started(_decoded(events).writeStream.foreachBatch(write), checkpoint, available_now, trigger)


def start_catalogue_state(spark: SparkSession, events: DataFrame, catalogue_path: str, checkpoint: str,
                          available_now: bool = True, trigger: str = "1 minute",
                          fanout: int = 4, buckets: int = 8) -> StreamingQuery:
    """U3 as state: groupBy and max in update mode.  Rejected events are the
    work of ``start_rejects``, a query of its own over the same events."""
    store = catalogue_store(spark, catalogue_path, fanout, buckets)
    valid = _decoded(events).where("is_valid")
    state = valid.groupBy("fileName").agg(F.max(F.struct("uploadTime", "filePath")).alias("m"))

    def write(batch: DataFrame, batch_id: int) -> None:
        store.commit(batch_id, _entries(batch.select("fileName", "m.uploadTime", "m.filePath")))

    return _started(state.writeStream.outputMode("update").foreachBatch(write), checkpoint, available_now, trigger)


def start_rejects(events: DataFrame, reject_path: str, checkpoint: str, available_now: bool = True,
                  trigger: str = "1 minute") -> StreamingQuery:
    """Events that are malformed or incomplete, by batch."""
    rejects = _decoded(events).where(~F.col("is_valid"))
    return _started(rejects.writeStream.foreachBatch(lambda b, n: _write_rejects(b, n, reject_path)), checkpoint,
                    available_now, trigger)


def read_catalogue(spark: SparkSession, catalogue_path: str) -> DataFrame:
    """U3 over the live runs: the current file of every name."""
    rows = catalogue_store(spark, catalogue_path).read()
    if rows is None:
        raise ValueError(f"no catalogue in {catalogue_path}")
    return rows
