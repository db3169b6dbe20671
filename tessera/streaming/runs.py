"""Run events as streams: current state, stalled runs and an incremental leaderboard, each beside its batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_state(events: DataFrame) -> DataFrame:
    """The newest event of each user: streaming (update or complete mode) and batch alike."""
    return events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("last"), F.count("*").alias("events")).select("user_id", "last.ts", "last.event_id", "last.event_type", "events")


def stalled(events: DataFrame, now, seconds: int = 90, ended: tuple[str, ...] = ()) -> DataFrame:
    """The newest event of each user, its age at now (a timestamp column or literal), and whether the run has stalled: older than seconds and not ended."""
    last = latest_state(events)
    age = F.greatest(F.unix_micros(now) - F.unix_micros(F.col("ts").cast("timestamp")), F.lit(0)) / 1e6
    over = F.col("event_type").isin(*ended) if ended else F.lit(False)
    return last.withColumn("age", age).withColumn("stalled", (F.col("age") > seconds) & ~over)


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Runs of events less than gap apart, per user; with a watermark, closed sessions come out in append mode."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    found = marked.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return found.select("user_id", F.col("w.start").alias("opened"), F.col("w.end").alias("closed"), "events", "value")


def tumbling(events: DataFrame, size: str = "1 day", late: str = "1 hour") -> DataFrame:
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    return marked.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("events")).select(F.col("w.start").alias("opened"), "event_type", "events")


def merge_sums(state: DataFrame | None, batch: DataFrame) -> DataFrame:
    """(key, s, n) sums of a leaderboard after one more batch of (key, value) rows."""
    sums = batch.filter("value is not null").groupBy("key").agg(F.sum("value").alias("s"), F.count("*").alias("n"))
    both = sums if state is None else state.unionByName(sums)
    return both.groupBy("key").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def incremental_board(stream: DataFrame, path: str, checkpoint: str):
    """Start an upsert of each micro-batch into sums under path/version=k; a replayed batch writes the same version again."""
    spark = stream.sparkSession

    def upsert(batch: DataFrame, k: int) -> None:
        state = spark.read.parquet(f"{path}/version={k - 1}") if k else None
        merge_sums(state, batch).write.mode("overwrite").parquet(f"{path}/version={k}")

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
