"""Streams of a run log: a batch that fails after its write is replayed without effect, and timers flag silent runs without further events."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tessera.streaming import state

START = datetime.datetime(2024, 1, 1)


def log(spark, rows):
    events = spark.createDataFrame([(i, u, kind, START + datetime.timedelta(seconds=s), v) for i, (u, kind, s, v) in enumerate(rows)], "event_id long, user_id long, event_type string, ts timestamp, value double")
    return state.replayed(events)


ROWS = [(1, "start", 0, 1.0), (2, "start", 1, 2.0), (3, "start", 5, 3.0), (1, "step", 60, 4.0), (3, "end", 70, None), (1, "step", 130, 6.0), (4, "start", 200, 5.0), (1, "step", 215, 7.0), (4, "step", 230, 8.0), (4, "step", 300, 9.0), (1, "step", 301, 1.0)]


def test_silent_runs_are_flagged(spark, tmp_path):
    folder, schema = log(spark, ROWS)
    state.to_parts(state.tracked(state.opened(spark, folder, schema), 90, ("end",)), f"{tmp_path}/parts", f"{tmp_path}/checkpoint").awaitTermination()
    got = {r.user_id: (r.event_type, r.events, r.stale) for r in state.newest_runs(spark.read.parquet(f"{tmp_path}/parts")).collect()}
    assert got == {1: ("step", 5, False), 2: ("start", 1, True), 3: ("end", 2, False), 4: ("step", 3, False)}


@pytest.mark.parametrize("fails_at", [0, 2])
def test_replayed_batch_changes_nothing(spark, tmp_path, fails_at):
    folder, schema = log(spark, ROWS)
    parts, checkpoint, once = f"{tmp_path}/parts", f"{tmp_path}/checkpoint", []

    def start(broken):
        stream = state.tracked(state.opened(spark, folder, schema), 90, ("end",))

        def write(batch, k):
            batch.write.mode("overwrite").parquet(f"{parts}/batch={k}")
            if broken and k == fails_at:
                once.append(k)
                raise RuntimeError("lost")

        return stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    with pytest.raises(Exception, match="lost"):
        start(True).awaitTermination()
    assert once == [fails_at]
    start(False).awaitTermination()
    got = {r.user_id: (r.event_type, r.events, r.stale) for r in state.newest_runs(spark.read.parquet(parts)).collect()}
    assert got == {1: ("step", 5, False), 2: ("start", 1, True), 3: ("end", 2, False), 4: ("step", 3, False)}


def test_board_adds_parts_up_once(spark, tmp_path):
    events = spark.createDataFrame([(k, float(v), START + datetime.timedelta(seconds=i)) for i, (k, v) in enumerate([("a", 1), ("b", 5), ("a", 3), ("c", 2), ("b", 1), ("a", 2)])] + [("c", None, START)], "key string, value double, ts timestamp")
    folder, schema = state.replayed(events)
    for _ in range(2):  # the second run finds nothing new
        state.to_parts(state.opened(spark, folder, schema), f"{tmp_path}/parts", f"{tmp_path}/checkpoint", "append", state.sums).awaitTermination()
    got = {r.key: (r.n, r.mean, r.place) for r in state.board(spark.read.parquet(f"{tmp_path}/parts")).collect()}
    assert got == {"a": (3, 2.0, 2), "b": (2, 3.0, 1), "c": (1, 2.0, 2)}


@pytest.mark.parametrize("buckets", [1, 3])
def test_runs_share_buckets_and_slices_are_bounded(spark, tmp_path, buckets):
    """Many runs in few buckets, in more slices than asked for: each run as if it were alone, an id that is missing too."""
    draw = random.Random(buckets)
    rows = [(draw.choice([None, *range(20)]), draw.choice(["start", "step", "end"]), draw.randrange(600), 1.0) for _ in range(200)] + [(5, "step", 700, 1.0)]
    events = spark.createDataFrame([(i, u, kind, START + datetime.timedelta(seconds=s), v) for i, (u, kind, s, v) in enumerate(rows)], "event_id long, user_id long, event_type string, ts timestamp, value double")
    folder, schema = state.replayed(events, slice_rows=20)
    assert max(r["count"] for r in spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()) <= 30
    state.to_parts(state.tracked(state.opened(spark, folder, schema), 90, ("end",), buckets=buckets), f"{tmp_path}/parts", f"{tmp_path}/checkpoint").awaitTermination()
    got = {r.user_id: (r.event_id, r.event_type, r.events, r.stale) for r in state.newest_runs(spark.read.parquet(f"{tmp_path}/parts")).collect()}
    want = {}
    for u in {r[0] for r in rows}:
        s, i, kind = max((s, i, kind) for i, (x, kind, s, _) in enumerate(rows) if x == u)
        want[u] = (i, kind, sum(x == u for x, *_ in rows), kind != "end" and s + 90 < 699)
    assert got == want
