"""Traps, checks, merges, colours, vectors, sources and streams on small frames."""

import datetime as dt
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinora.functions import color, stats, text, vector, vocab
from affinora.operators import merge, quality
from affinora.plans import embeddings, item_master, similarity
from affinora.sources import snapshots, tables
from affinora.streaming import monitor


def one(df):
    return df.collect()[0][0]


def test_percent_rounds_half_up_in_integers(spark):
    df = spark.createDataFrame([(57, 200)], "a int, b int")
    assert one(df.select(stats.percent_hundredths(F.col("a"), F.col("b")))) == 29
    idx = spark.createDataFrame([(1, 3), (3, 2), (5, 0)], "s bigint, r bigint")
    assert [r[0] for r in idx.select(stats.over_index_hundredths(F.col("s"), F.col("r"))).collect()] == [-6667, 5000, None]


def test_quartile_label_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0.25,), (0.26,), (0.75,), (0.9,)], "p double")
    assert [r[0] for r in df.select(stats.quartile_label(F.col("p"))).collect()] == [None, "4_least", "3_low", "2_medium", "1_high"]


def test_constraint_order_inside_the_payload(spark):
    color_row = '{"productId":"P","productVersion":1,"type":"t","context":[{"key":"Merchant","value":"acme"},{"key":"Country","value":"C"}],"attributeConstraint":[{"attributeKey":"Substrate Color","values":[{"stringLiteral":"%s"}]}]}'
    block_all = color_row.split('"attributeConstraint"')[0] + '"attributeConstraint":null}'
    body = "[" + ",".join([color_row % "red", block_all, color_row % "blue"]) + "]"
    got = item_master.parse_constraints(spark.createDataFrame([(body,)], "body string"), "Acme")
    assert {r.color for r in got.collect()} == {"red", "all"}


def test_gender_precedence(spark):
    df = spark.createDataFrame([("YOUTH", "Tee (MEN"), (None, "Tee WOMENS"), (None, "Tee MEN")], "g string, n string")
    default = [r[0] for r in df.select(embeddings.gender_from_name(F.col("g"), F.col("n"))).collect()]
    strict = [r[0] for r in df.select(embeddings.gender_from_name(F.col("g"), F.col("n"), True)).collect()]
    assert default == ["YOUTH", "WOMEN", "MEN"] and strict == ["MEN", "WOMEN", "MEN"]


def test_change_detection_sees_null_transitions(spark):
    cols = "id int, version int, price double, a string"
    current = spark.createDataFrame([(1, 1, 10.0, None), (2, 1, 10.0, "x"), (3, 1, None, None), (4, 1, 10.0, "x")], cols)
    incoming = spark.createDataFrame([(1, 1, 10.4, None), (2, 1, 10.0, None), (3, 1, None, None), (4, 1, 10.5, "x"), (5, 1, 1.0, "n")], cols)
    got = {r.id: r.change for r in merge.changed_rows(incoming, current, ["id"], "version", "price", ["a"]).collect()}
    assert got == {2: "attribute", 4: "price", 5: "new"}


def test_merge_is_idempotent_and_sync_reproduces_new(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = merge.merge_upsert(old, new, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, merge.merge_upsert(once, new, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    synced = merge.apply_changes(old, merge.sync_changes(old, new, ["k"]), ["k"])
    assert sorted(map(tuple, synced.collect())) == [(2, "B"), (3, "c")]


def test_checks_pass_and_fail(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    with pytest.raises(quality.QualityError):
        quality.require_empty(quality.duplicates(df, ["k"]), "duplicate keys")
    quality.require_empty(quality.duplicates(df, ["k", "v"]), "duplicate rows")
    assert quality.outside_domain(df, "v", ["a"]).isEmpty()
    assert not quality.outside_domain(df, "v", ["a"], nulls_allowed=False).isEmpty()
    assert quality.domain_difference(df.filter("v is not null"), "v", ["a"]).isEmpty()


def test_lab_and_cmc_literature_values(spark):
    df = spark.createDataFrame([("#FF0000",), ("#FFFFFF",)], "h string")
    red, white = [r[0] for r in df.select(color.hex_to_lab(F.col("h"))).collect()]
    assert np.allclose([red.l, red.a, red.b], [53.24, 80.09, 67.20], atol=0.02)
    assert np.allclose([white.l, white.a, white.b], [100, 0, 0], atol=0.02)
    same = df.select(color.color_similarity(color.hex_to_lab(F.col("h")), color.hex_to_lab(F.col("h"))))
    assert all(abs(r[0] - 1) < 1e-12 for r in same.collect())
    names = df.select(color.nearest_basic_color(color.hex_to_lab(F.col("h"))), color.nearest_css_color(F.col("h"))).collect()
    assert [tuple(r) for r in names] == [("red", "red"), ("white", "white")]


def test_option_hash_ignores_map_order(spark):
    df = spark.createDataFrame([('{"a":"1","b":"2"}',), ('{"b":"2","a":"1"}',)], "j string")
    assert df.select(text.options_hash(F.from_json("j", "map<string,string>")).alias("h")).distinct().count() == 1


def test_vocabulary_verdicts(spark):
    rows = [("DIGITAL", "DIGITAL PRINTING", 1), ("EMBROIDERY", "EMBROIDERY", 1), ("DIGITAL", "EMBROIDERY", 0), ("laser", "DIGITAL", None)]
    df = spark.createDataFrame(rows, "a string, b string, want int")
    tech = vocab.VOCABULARIES["decoration_technology"]
    assert all(r.want == r.got for r in df.withColumn("got", tech.agrees(F.col("a"), F.col("b"))).collect())
    loc = vocab.VOCABULARIES["decoration_location"]
    rows = [("FRONT CHEST", "LEFT CHEST", 1), ("FRONT CHEST", "FRONT", 0), ("embroidery", "BACK", 1), ("BACK", "FRONT", 0)]
    df = spark.createDataFrame(rows, "a string, b string, want int")
    assert all(r.want == r.got for r in df.withColumn("got", loc.agrees(F.col("a"), F.col("b"))).collect())
    shirts = spark.createDataFrame([("SHIRT", "T-SHIRTS", 0), ("T-SHIRTS", "SHIRT", 1), ("CAP", "TRUCKER CAPS", 1)], "a string, b string, want int")
    assert all(r.want == r.got for r in shirts.withColumn("got", vocab.VOCABULARIES["type"].agrees(F.col("a"), F.col("b"))).collect())


def test_similar_pairs_equal_brute_force_over_small_tiles(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 8))
    rows = []
    for i in range(120):
        v = base[i % 12] + rng.normal(scale=0.4, size=8)
        rows.append((f"c{i}", "M" if i % 5 else "N", f"p{i // 3}", "G0" if i % 3 else "G1", [float(x) for x in v], i % 4 != 0))
    df = spark.createDataFrame(rows, "config_id string, market string, product_key string, product_group string, embedding array<double>, ok boolean")
    groups = {"G0": ["G0", "G1"], "G1": ["G1"]}
    want = set()
    for a in rows:
        for b in rows:
            if a[1] == b[1] and a[2] != b[2] and b[3] in groups[a[3]] and b[5]:
                x, y = np.array(a[4]), np.array(b[4])
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) > 0.65:
                    want.add((a[0], b[0]))
    for tile in (7, 1000):
        got = similarity.similar_pairs(df, groups, 0.65, targets=F.col("ok"), tile=tile)
        pairs = [(r.source, r.target) for r in got.collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_text_embedding_is_unit_or_zero(spark):
    df = spark.createDataFrame([("red cotton shirt shirt",), ("",), (None,)], "t string")
    rows = [r[0] for r in df.select(vector.text_embedding(F.col("t"), 12)).collect()]
    assert abs(np.linalg.norm(rows[0]) - 1) < 1e-12 and not any(rows[1]) and not any(rows[2])


def test_compact_time(spark):
    df = spark.createDataFrame([(1700000000,), (1700000000123,)], "e bigint")
    assert [r[0] for r in df.select(text.compact_time(F.col("e"))).collect()] == ["20231114221320"] * 2


def test_tables_and_snapshots(spark):
    root = tempfile.mkdtemp(prefix="affinora-test-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.write(df, "kept_a", "overwrite")
    tables.write(df.withColumn("k", F.col("k") + 2), "kept_a")
    assert spark.table("kept_a").count() == 4
    wide = df.withColumn("v", F.lit("z")).withColumn("extra", F.lit(1))
    tables.write(merge.merge_upsert(spark.table("kept_a"), wide, ["k"]), "kept_b", "overwrite")
    assert {(r.k, r.v, r.extra) for r in spark.table("kept_b").collect()} == {(1, "z", 1), (2, "z", 1), (3, "a", None), (4, "b", None)}
    tables.add_columns(spark, "kept_a", wide)
    assert spark.table("kept_a").columns == ["k", "v", "extra"]
    assert tables.read_or_empty(spark, "kept_none", df.schema).count() == 0
    assert not tables.create_if_absent(df, "kept_a") and tables.create_if_absent(df, "kept_c")
    for stamp in ("20240101000000", "20240201000000", "20240301000000"):
        snapshots.write_snapshot(df.withColumn("stamp", F.lit(stamp)), root, "grp", "items", stamp, parts=3)
    assert snapshots.snapshot_stamps(spark, root, "grp", "items") == ["20240301000000", "20240201000000", "20240101000000"]
    latest = snapshots.read_latest(spark, root, "grp", "items", "k int, v string, stamp string", cutoff="20240301000000")
    assert {r.stamp for r in latest.collect()} == {"20240201000000"} and latest.count() == 2
    ranged = snapshots.read_range(spark, root, {"eu": "grp"}, "items", "k int, v string, stamp string", "20240115000000", "20240401000000")
    assert ranged.count() == 4 and {r.region for r in ranged.collect()} == {"eu"}


def test_stream_equals_batch_and_late_repeats_drop(spark):
    root = tempfile.mkdtemp(prefix="affinora-stream-")
    schema = "user_id string, item int, ts timestamp, page_section string, country string, event_type string"
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(str(i % 3), i % 5, t0 + dt.timedelta(minutes=i), "Gallery", "C1", "productView") for i in range(60)]
    batch = spark.createDataFrame(rows + rows[:10], schema)
    src = os.path.join(root, "in")
    batch.coalesce(1).write.parquet(src)
    stream = monitor.stream_interactions(monitor.read_event_stream(spark, src, batch.schema))
    monitor.write_available(stream, os.path.join(root, "out"), os.path.join(root, "ckpt")).awaitTermination()
    got = spark.read.parquet(os.path.join(root, "out"))
    want = monitor.stream_interactions(batch)
    assert got.count() == want.count() == 60 and got.exceptAll(want).isEmpty()

    counts = monitor.events_per_window(monitor.read_event_stream(spark, src, batch.schema), "300 seconds", ["country"], "0 seconds")
    monitor.write_available(counts, os.path.join(root, "w"), os.path.join(root, "wckpt")).awaitTermination()
    closed = spark.read.parquet(os.path.join(root, "w"))
    assert closed.join(monitor.events_per_window(batch, "300 seconds", ["country"]), closed.columns, "left_anti").isEmpty()


def test_idle_windows_fill_gaps(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0 + dt.timedelta(hours=h)) for h in (1, 2, 5)]
    watched = spark.createDataFrame([("a",), ("b",)], "k string")
    got = monitor.idle_windows(spark.createDataFrame(rows, "k string, ts timestamp"), 3600, ["k"], "2024-01-01 00:00:00", "2024-01-01 07:00:00", watched)
    assert sorted((r.k, r.window_start.hour) for r in got.collect()) == [("a", h) for h in (0, 3, 4, 6)] + [("b", h) for h in range(7)]
