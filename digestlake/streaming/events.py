"""Structured Streaming over events and posts. An extension: the batch operators above have no counterpart in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read(spark: SparkSession, folder: str, schema: str = EVENTS, files_a_trigger: int = 8) -> DataFrame:
    """Parquet files of a folder as they arrive, with ts in the session's time zone so that it can carry a watermark."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def dedup(events: DataFrame, key: str = "event_id", late: str = "10 minutes") -> DataFrame:
    """The first event of each key; state is kept no longer than events may be late."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def _marked(events: DataFrame, late: str | None) -> DataFrame:
    return events.withWatermark("ts", late) if late else events


def activity(events: DataFrame, group: str = "event_type", late: str | None = "10 minutes", width: str = "1 hour", step: str | None = None) -> DataFrame:
    """(start, end, group, n, total) of tumbling windows, or of sliding ones if step is given; late is None where events carry a watermark."""
    windows = F.window("ts", width, step or width)
    counted = _marked(events, late).groupBy(windows.alias("w"), group).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), group, "n", "total")


def sessions(events: DataFrame, user: str = "user_id", gap: str = "30 minutes", late: str | None = "10 minutes") -> DataFrame:
    """(start, end, user, n) of each user's sessions."""
    counted = _marked(events, late).groupBy(F.session_window("ts", gap).alias("w"), user).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), user, "n")


def run_once(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Works off all that is there, exactly once by its checkpoint, into Parquet."""
    stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path).awaitTermination()
