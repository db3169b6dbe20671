"""Streams with a state of their own: runs that are flagged by an event-time timer when they fall silent, and a leaderboard that grows by micro-batch.

Each micro-batch writes what it changed under its own number, over whatever an earlier try left there, so a batch that is replayed after a
failure changes nothing. Reading back takes the newest row of each key, or adds up the parts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tessera.operators.lineage import shared_folder, ship

RUN_STATE = "user_id long, event_id long, event_type string, events long, stale boolean"


def replayed(events: DataFrame, slices: int = 4, slice_rows: int = 1 << 22) -> tuple[str, StructType]:
    """Write events in slices of time, one after the other, as a log would grow; the folder and the schema.

    Slices, at least so many, are one file each of some slice_rows at most. Rows are dealt to them in one pass over the events.
    """
    root = f"{shared_folder(events.sparkSession)}/log-{uuid.uuid4().hex}"
    folder = f"{root}/log"
    rows = events.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    slices = max(slices, -(-events.count() // slice_rows))
    bounds = rows.agg(F.percentile_approx("at", [k / slices for k in range(1, slices)], 1000 * slices).alias("b")).first()["b"] or []
    rows = rows.withColumn("at", F.timestamp_micros("at"))
    part = F.array_position(F.array_sort(F.array_append(F.lit(bounds).cast("array<bigint>"), F.unix_micros("at"))), F.unix_micros("at")) if bounds else F.lit(1)
    rows = rows.withColumn("part", part).drop("ts")
    rows.write.partitionBy("part").parquet(f"{root}/dealt")
    dealt = events.sparkSession.read.schema(rows.schema).parquet(f"{root}/dealt")
    for k in range(1, len(bounds) + 2):
        dealt.filter(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(folder)
    return folder, rows.drop("part").schema


def opened(spark: SparkSession, folder: str, schema: StructType, files: int = 1) -> DataFrame:
    """The log as a stream, so many files a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def tracked(stream: DataFrame, seconds: int = 90, ended: tuple[str, ...] = (), late: str = "1 second", buckets: int = 256) -> DataFrame:
    """A row for each change of a run: its newest event, how many it had, and whether it is stale.

    A run is stale once the watermark is seconds past its newest event, unless that ends it: a timer says so, without any further event of the run.
    Runs share a state and a timer, the earliest due, by bucket, so that a call is not for one run alone; buckets belong to the checkpoint.
    """
    ship(stream.sparkSession)
    never, nobody = (1 << 63) - 1, F.lit(-(1 << 63))  # a missing id is a number inside

    def change(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        runs = pa.ipc.open_stream(state.get[0]).read_all().to_pandas() if state.exists else None
        if not state.hasTimedOut:
            fresh = pd.concat(list(parts))[["user_id", "us", "event_id", "event_type"]].assign(events=1, due=0, touched=True)
            both = fresh if runs is None else pd.concat([fresh, runs.assign(touched=False)])
            both = both.sort_values(["user_id", "us", "event_id"], kind="stable")
            group = both.groupby("user_id", sort=False)
            sums = group[["events", "touched"]].sum()
            runs = both.drop_duplicates("user_id", keep="last").set_index("user_id")
            touched = (sums["touched"] > 0).reindex(runs.index)
            runs["events"] = sums["events"].reindex(runs.index)
            due = np.where(runs["event_type"].isin(ended), never, np.maximum(runs["us"] // 1000 + 1000 * seconds, now + 1))
            before = group["due"].max().reindex(runs.index)
            runs["due"] = np.where(touched, due, before)
            runs = runs.drop(columns="touched").reset_index()
            touched = touched.to_numpy()
        else:
            touched = np.zeros(len(runs), bool)
        stale = runs["due"].to_numpy() < now
        out = runs[touched | stale].assign(stale=stale[touched | stale])
        runs.loc[stale, "due"] = never
        sink = pa.BufferOutputStream()
        table = pa.Table.from_pandas(runs[["user_id", "us", "event_id", "event_type", "events", "due"]], preserve_index=False)
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))
        first = int(runs["due"].min())
        if first < never:
            state.setTimeoutTimestamp(max(first, now + 1))
        yield out[["user_id", "event_id", "event_type", "events", "stale"]]

    rows = stream.withColumn("us", F.unix_micros("at")).withWatermark("at", late).withColumn("user_id", F.coalesce(F.col("user_id").cast("long"), nobody))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets))).groupBy("bucket")
    return rows.applyInPandasWithState(change, RUN_STATE, "runs binary", "update", GroupStateTimeout.EventTimeTimeout).withColumn("user_id", F.nullif("user_id", nobody))


def to_parts(stream: DataFrame, path: str, checkpoint: str, mode: str = "update", shape=lambda batch: batch):
    """Start the stream: each micro-batch's rows, shaped, go to path/batch=k in place of what was there. It ends with the data at hand."""

    def write(batch: DataFrame, k: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{path}/batch={k}")

    return stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest_runs(parts: DataFrame) -> DataFrame:
    """The last row of each run among the parts that tracked() gave."""
    last = F.max_by(F.struct("event_id", "event_type", "events", "stale"), F.struct("events", "stale"))
    return parts.groupBy("user_id").agg(last.alias("last")).select("user_id", "last.*")


def sums(batch: DataFrame) -> DataFrame:
    """A micro-batch's part of a leaderboard of means: key, sum and number."""
    return batch.filter("value is not null").groupBy("key").agg(F.sum("value").alias("s"), F.count("*").alias("n"))


def board(parts: DataFrame) -> DataFrame:
    """key, n, mean and competition rank of the parts that sums() gave: a row a key, as few as there are tools."""
    whole = parts.groupBy("key").agg(F.sum("n").alias("n"), (F.sum("s") / F.sum("n")).alias("mean"))
    return whole.withColumn("place", F.rank().over(Window.orderBy(F.round("mean", 9).desc())))
