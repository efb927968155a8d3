"""Event streams that restart between slices against their batch forms."""

import tempfile

from pyspark.sql import functions as F

from affinora.streaming import idle, monitor

SCHEMA = "ts timestamp, k string"


def frames(spark, *slices):
    return [spark.createDataFrame([(t, k) for t, k in part], "ts string, k string").select(F.col("ts").cast("timestamp").alias("ts"), "k").coalesce(1) for part in slices]


def at(h, m=0, day=1):
    return f"2024-01-{day:02d} {h:02d}:{m:02d}:00"


def test_idle_stream_raises_silent_keys_after_restarts(spark):
    monitor.with_state_store(spark)
    parts = frames(
        spark, [(at(0, 5), "a"), (at(0, 10), "b")], [(at(1, 30), "a"), (at(1, 40), "other")],
        [(at(4), "b"), (at(0, 50), "a")],  # the second row is late: its window is decided
        [(at(9), "other")])
    watched = spark.createDataFrame([("a",), ("b",), ("never",), ("a",)], "k string")
    args = (3600, ["k"], at(0), at(7), watched)
    build = lambda s: idle.idle_stream(s, *args[:1], args[1], args[2], args[3], args[4], "10 minutes")
    out, _ = monitor.replay(parts, build, tempfile.mkdtemp())
    got = {(r.k, r.window_start.hour) for r in out.collect()}
    assert out.count() == len(got)
    assert got == {("a", h) for h in (2, 3, 4, 5, 6)} | {("b", h) for h in (1, 2, 3, 5, 6)} | {("never", h) for h in range(7)}
    everything = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    batch = monitor.idle_windows(everything, *args[:1], args[1], args[2], args[3], watched)
    assert got == {(r.k, r.window_start.hour) for r in batch.collect()}


def test_window_counts_drop_and_count_late_rows(spark):
    parts = frames(spark, [(at(0, 1), "a"), (at(0, 2), "a")], [(at(2), "a")], [(at(0, 3), "a"), (at(0, 4), "a"), (at(1, 59), "a")], [(at(5), "a")])
    out, late = monitor.replay(parts, lambda s: monitor.events_per_window(s, "1 hour", ["k"], "30 minutes"), tempfile.mkdtemp())
    assert late >= 1
    assert {(r.window_start.hour, r.events) for r in out.collect()} == {(0, 2), (1, 1), (2, 1)}


def test_replayed_slice_adds_nothing(spark):
    rows = [("u1", 7, at(0, 1)), ("u1", 7, at(0, 2)), ("u2@x", 7, at(0, 3)), (None, 7, at(0, 4))]
    frame = spark.createDataFrame(rows, "user_id string, item int, ts string").select(
        "user_id", "item", F.col("ts").cast("timestamp").alias("ts"), F.lit("Gallery").alias("page_section"), F.lit("US").alias("country"), F.lit("productView").alias("event_type"))
    out, _ = monitor.replay([frame, frame, frame.limit(1)], monitor.stream_interactions, tempfile.mkdtemp())
    assert sorted((r.user_id, r.item_id, r.event_type, r.ts.minute) for r in out.collect()) == [("u1", "7", "click", 1), ("u1", "7", "click", 2)]
