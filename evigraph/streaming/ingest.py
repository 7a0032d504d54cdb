"""Structured Streaming: events in windows, and digests as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import run_incremental


def stream_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The files `name` below a folder as a stream, with the schema they have now."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    df = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    # a watermark needs an instant; times without a zone are UTC, the session's zone
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def windowed(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total): counts in windows; events later than `late` are dropped."""
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", window).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))
        .select(F.col("w.start").alias("start"), "event_type", "n", "total")
    )


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(user_id, start, end, n): runs of a user's events without a longer gap."""
    return events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def ingest(states: DataFrame, state_dir: str, checkpoint: str, process) -> StreamingQuery:
    """Runs run_incremental on the keys of each micro-batch of (key, token).

    A batch only upserts: its keys replace the saved ones, the rest stays, and only the ranges
    that hold changed leaves are written. Exactly once: a batch that is replayed after a
    failure finds its keys unchanged and does nothing.
    """

    def batch(df: DataFrame, _: int) -> None:
        run_incremental(df.sparkSession, df.select("key", "token"), state_dir, process, partial=True)

    return states.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
