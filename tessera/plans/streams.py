"""Queries that run a stream over the event log to its end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.lineage import shared_folder
from tessera.plans.registry import query
from tessera.plans.views import Views
from tessera.streaming import state


def _folders(v: Views) -> tuple[str, str]:
    root = f"{shared_folder(v.spark)}/stream-{uuid.uuid4().hex}"
    return f"{root}/parts", f"{root}/checkpoint"


@query("p01_run_progress_stream", """
SELECT user_id, event_id, event_type, events, event_type <> 'signup' AND epoch_ms(newest) - 1000 > epoch_ms(ts) + 90000 AS stale
FROM (SELECT user_id, max(ts) AS ts, max_by(event_id, (ts, event_id)) AS event_id, max_by(event_type, (ts, event_id)) AS event_type, count(*) AS events FROM events GROUP BY user_id), (SELECT max(ts) AS newest FROM events)""")  # fmt: skip
def p01(v: Views) -> DataFrame:
    """The log in four slices, a micro-batch each: state and timers carry runs from one to the next."""
    log, schema = state.replayed(v.events.select("event_id", "user_id", "event_type", "ts"))
    parts, checkpoint = _folders(v)
    state.to_parts(state.tracked(state.opened(v.spark, log, schema), 90, ("signup",)), parts, checkpoint).awaitTermination()
    return state.newest_runs(v.spark.read.parquet(parts))


@query("p03_leaderboard_stream", "SELECT event_type AS key, n, round(mean, 6) AS mean, CAST(rank() OVER (ORDER BY round(mean, 9) DESC) AS INTEGER) AS place FROM (SELECT event_type, count(value) AS n, sum(value) / count(value) AS mean FROM events WHERE value IS NOT NULL GROUP BY event_type)")
def p03(v: Views) -> DataFrame:
    log, schema = state.replayed(v.events.select(F.col("event_type").alias("key"), "value", "ts"))
    parts, checkpoint = _folders(v)
    state.to_parts(state.opened(v.spark, log, schema), parts, checkpoint, "append", state.sums).awaitTermination()
    return state.board(v.spark.read.parquet(parts)).withColumn("mean", F.round("mean", 6))
