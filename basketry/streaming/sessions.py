"""Sessions of events by event time, with a watermark, state that ends and a late table.

Events arrive as files. A first stream parts them: an event not after the
watermark (the latest event time of earlier epochs less ``delay``) is late and goes
to the side table, the others go on. The second stream builds session windows per
user over those: a session closes once the watermark has passed its end, its row
is written and its state is dropped, so that state holds open sessions only. An
event that goes on is later than every closed session's end, and a session takes an event up
to ``gap`` after its last one; the sessions are therefore those of a batch over the same events, whatever the epochs.

Each epoch of the first stream writes folders of its own and the watermark it
leaves to the next; a replayed epoch overwrites them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
_MARK_SCHEMA = T.StructType([T.StructField("latest", T.TimestampType())])


def _reader(spark: SparkSession, source: str, files_per_trigger: int):
    return (spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(source))


def part_late_events(spark: SparkSession, source: str, sink: str, checkpoint: str, delay: str,
                     files_per_trigger: int = 1):
    """Start the parting stream: ``sink/on_time``, ``sink/late`` and ``sink/marks`` per epoch.

    Events without a time are late.
    """
    sink = sink.rstrip("/")

    def part(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        before = None
        if epoch_id:
            before = session.read.schema(_MARK_SCHEMA).parquet(
                f"{sink}/marks/epoch={epoch_id - 1}").first()[0]
        mark = F.lit(before).cast("timestamp")
        held = F.col("ts").isNull() | F.coalesce(
            F.col("ts") <= mark - F.expr(f"interval {delay}"), F.lit(False))
        batch.filter(held).write.mode("overwrite").parquet(f"{sink}/late/epoch={epoch_id}")
        # One file of the second stream for each epoch keeps the order of arrival.
        batch.filter(~held).repartition(1).write.mode("overwrite").parquet(
            f"{sink}/on_time/epoch={epoch_id}")
        (batch.agg(F.greatest(F.max("ts"), mark).alias("latest")).coalesce(1)
         .write.mode("overwrite").parquet(f"{sink}/marks/epoch={epoch_id}"))

    return (_reader(spark, source, files_per_trigger).writeStream.foreachBatch(part)
            .option("checkpointLocation", checkpoint).queryName("late_events")
            .trigger(availableNow=True).start())


def start_sessions(spark: SparkSession, source: str, sink: str, checkpoint: str, gap: str,
                   delay: str, files_per_trigger: int = 1):
    """Start the session stream: closed sessions (user_id, start, end, n_events, total) in ``sink``.

    A row without a user moves the watermark and opens no session.
    """
    sessions = (_reader(spark, source, files_per_trigger).withWatermark("ts", delay)
                .filter("user_id is not null or ts is null")  # on ts: stays behind the watermark
                .groupBy("user_id", F.session_window("ts", gap).alias("session"))
                .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total"),
                     F.max("ts").alias("last_ts"))
                .select("user_id", F.col("session.start").alias("start"), "last_ts", "n_events",
                        "total"))
    return (sessions.writeStream.outputMode("append").format("parquet").option("path", sink)
            .option("checkpointLocation", checkpoint).queryName("sessions")
            .trigger(availableNow=True).start())


def write_heartbeat(spark: SparkSession, source: str, latest, gap: str, delay: str) -> None:
    """A row without a user that lies after every open session, which closes them."""
    row = spark.createDataFrame([(None, latest, None, None)], EVENT_SCHEMA)
    row.withColumn("ts", F.col("ts") + F.expr(f"interval {gap}") + F.expr(f"interval {delay}")
                   + F.expr("interval 1 second")).coalesce(1).write.mode("append").parquet(source)


def sessionise_folder(spark: SparkSession, source: str, base: str, gap: str, delay: str,
                      files_per_trigger: int = 1) -> tuple[DataFrame, DataFrame, list]:
    """Both streams over everything in ``source``: (sessions, late events, progress).

    Ends with a heartbeat, so that every session is closed; ``progress`` holds the number
    of state rows after each epoch of the session stream.
    """
    base = base.rstrip("/")
    part_late_events(spark, source, f"{base}/parted", f"{base}/parted-checkpoint", delay,
                     files_per_trigger).awaitTermination()
    on_time = f"{base}/parted/on_time"
    marks = spark.read.schema(_MARK_SCHEMA).option("recursiveFileLookup", "true").parquet(
        f"{base}/parted/marks")
    latest = marks.agg(F.max("latest")).first()[0]
    if latest is not None:
        write_heartbeat(spark, f"{on_time}/epoch=heartbeat", latest, gap, delay)
    query = start_sessions(spark, f"{on_time}/*", f"{base}/sessions", f"{base}/checkpoint", gap, delay)
    query.awaitTermination()
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress
             if p["stateOperators"]]
    late = spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(
        f"{base}/parted/late")
    return spark.read.parquet(f"{base}/sessions"), late, state
