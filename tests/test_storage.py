"""Bucketed joins, pair filters, drifting payloads and snapshot layouts."""

import os
import tempfile
import uuid

from pyspark.sql import functions as F

from affinora.operators import cooccurrence
from affinora.sources import payloads, snapshots, tables


def test_bucketed_baskets_join_without_exchange(spark):
    rows = spark.range(4000).select(F.lit("x").alias("s"), (F.col("id") % 300).alias("b"), (F.col("id") * 7 % 50).alias("i"))
    name = f"t_{uuid.uuid4().hex}"
    tables.write_bucketed(rows, name, ["s", "b"], 4)
    bucketed = cooccurrence.distinct_baskets(spark.table(name), "s", "b", "i")
    pairs = bucketed.alias("l").join(bucketed.alias("r").hint("merge"), ["segment", "basket"]).filter("l.item < r.item")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Bucketed: true" in plan
    plain = cooccurrence.distinct_baskets(rows, "s", "b", "i")
    assert bucketed.exceptAll(plain).isEmpty() and plain.exceptAll(bucketed).isEmpty()
    spark.sql(f"drop table {name}")


def test_pair_filter_keeps_all_frequent_pairs_and_spares_rare_ones(spark):
    rows = spark.range(60_000).select(F.lit("x").alias("s"), (F.col("id") % 4000).alias("b"), F.pmod(F.xxhash64("id"), F.lit(3000)).alias("i"))
    baskets = cooccurrence.distinct_baskets(rows, "s", "b", "i")
    want = cooccurrence.pair_counts(baskets, 3)
    for bits in (4, 20):  # nearly full buckets, nearly empty ones
        got = cooccurrence.pair_counts(baskets, 3, sketch_bits=bits)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    right = baskets.select("segment", "basket", F.col("item").alias("other"))
    pairs = baskets.join(right, ["segment", "basket"]).filter("item < other").select("segment", "item", "other")
    assert cooccurrence.likely_frequent(pairs, 3, 20).count() < pairs.count() / 10


def test_payloads_keep_unknown_keys_and_reject_broken_rows(spark):
    bodies = ['{"a": 1, "b": "x"}', '{"a": "text", "new": [1, 2]}', "{broken", None, "3", "[]", '{"a": null}']
    rows, rejected = payloads.opened(spark.createDataFrame(list(enumerate(bodies)), "id int, body string"), "body")
    assert [r.id for r in rejected.collect()] == [2]
    found = payloads.fields(rows, {"a": ("$.a", "int"), "second": ("$.new[1]", "int")})
    assert {r.id: (r.a, r.second) for r in found.collect()} == {0: (1, None), 1: (None, 2), 3: (None, None), 4: (None, None), 5: (None, None), 6: (None, None)}
    assert {(r.key, r.n, r.known) for r in payloads.key_profile(rows, ["a", "b"]).groupBy("key", "known").agg(F.sum("n").alias("n")).collect()} == {
        ("a", 3, True), ("b", 1, True), ("new", 1, False)}


def test_half_written_snapshots_are_not_read(spark):
    root = tempfile.mkdtemp()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for stamp in ("20240101000000", "20240102000000"):
        snapshots.write_snapshot(df, root, "g", "d", stamp, 1)
        snapshots.write_regional_snapshot(df, root, "d", "eu", stamp, 1)
    os.remove(f"{root}/g/d/20240102000000/_SUCCESS")
    os.remove(f"{root}/d/region=eu/snapshot=20240102000000/_SUCCESS")
    newest = snapshots.read_latest(spark, root, "g", "d", "k int, v string")
    assert {(r.k, r.snapshot) for r in newest.collect()} == {(1, "20240101000000"), (2, "20240101000000")}
    regional = snapshots.read_regional(spark, root, "d", "k int, v string", ["eu", "us"], "20240101000000", "20250101000000")
    assert {(r.k, r.region, r.snapshot) for r in regional.collect()} == {(1, "eu", "20240101000000"), (2, "eu", "20240101000000")}
    assert "PartitionFilters: [" in regional._jdf.queryExecution().executedPlan().toString()
    shared = snapshots.read_range(spark, root, {"x": "g", "y": "g"}, "d", "k int, v string", "2024", "2025")
    assert sorted((r.k, r.region) for r in shared.collect()) == [(1, "x"), (1, "y"), (2, "x"), (2, "y")]
    assert snapshots.read_eras(spark, root, {"eu": "nothing"}, "d", "k int, v string", "2024", "2025", "2023").count() == 2
