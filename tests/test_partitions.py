"""Partition-wise maintenance, checks on a write, and exact quantiles against plain definitions."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinora.operators import merge, quality, quantiles
from affinora.sources import partitioned


def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def folder(spark):
    path = tempfile.mkdtemp() + "/t"
    rows = [(k, f"p{k % 4}" if k % 4 else None, float(k)) for k in range(40)]
    df = spark.createDataFrame(rows, "id int, part string, v double")
    partitioned.create(df, path, ["part"])
    return path, df


def test_upsert_leaves_other_partitions(spark, folder):
    path, df = folder
    before = files(path)
    source = spark.createDataFrame([(1, "p1", -1.0), (101, "p1", 5.0), (4, None, -4.0), (7, "new", 7.0)], "id int, part string, v double")
    partitioned.upsert(path, source, ["id", "part"], ["part"])
    after = files(path)
    assert {k: v for k, v in before.items() if "part=p2" in k or "part=p3" in k} == {k: v for k, v in after.items() if "part=p2" in k or "part=p3" in k}
    want = [(k, p, v) for k, p, v in rows_of(df) if (k, p) != (1, "p1")]  # a null key matches none, as in MERGE
    want += rows_of(source)
    assert rows_of(spark.read.parquet(path).select("id", "part", "v")) == sorted(want, key=repr)
    with pytest.raises(ValueError):
        partitioned.upsert(path, source, ["id"], ["part"])
    with pytest.raises(Exception, match="share one merge key"):
        partitioned.upsert(path, source.unionByName(source), ["id", "part"], ["part"])


def test_delete_and_retain_drop_emptied_partitions(spark, folder):
    path, df = folder
    source = df.filter("part = 'p1' and id < 20 or part is null")
    emptied = partitioned.delete_not_matched_by_source(path, source, ["id", "part"], ["part"], F.expr("part in ('p1', 'p2')"))
    want = merge.delete_not_matched_by_source(df, source, ["id", "part"], F.expr("part in ('p1', 'p2')"))
    assert emptied == 1 and not any("part=p2" in f for f in files(path))
    assert rows_of(spark.read.parquet(path).select("id", "part", "v")) == rows_of(want)
    before = files(path)
    assert partitioned.retain(spark, path, ["part"], F.expr("v >= 10 or part = 'p3'")) == 0
    assert {k: v for k, v in before.items() if "part=p3" in k} == {k: v for k, v in files(path).items() if "part=p3" in k}
    assert rows_of(spark.read.parquet(path).select("id", "part", "v")) == rows_of(want.filter("v >= 10 or part = 'p3'"))


def test_checks_of_a_write(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, -1.0), (3, "", None), (4, "z", 2.0)], "id int, k string, v double")
    path = tempfile.mkdtemp() + "/t"
    found = quality.write_observed(df, path, quality.observed_checks(["k", "id"], {"k": ["a", "b"]}, ["v"]), previous_rows=4)
    assert {(r.check, r.column_name): (r.n, r.failed) for r in found.collect()} == {
        ("rows", ""): (4, False), ("null", "k"): (2, True), ("null", "id"): (0, False), ("domain", "k"): (2, True), ("negative", "v"): (1, True)}
    assert spark.read.parquet(path).count() == 4


@pytest.mark.parametrize("kind", ["spread", "equal", "heavy"])
def test_quantiles_against_numpy(spark, kind):
    rng = np.random.default_rng(2)
    value = {"spread": rng.normal(0, 1000, 600).round(3), "equal": np.full(600, 2.5), "heavy": np.where(rng.random(600) < 0.7, 3.0, rng.random(600))}[kind]
    group = rng.choice(["a", "b", "c"], 600, p=[0.8, 0.19, 0.01]).tolist() + [None, None, "none", "one"]
    rows = list(zip(group, [*value.tolist(), 1.0, 2.0, None, 7.0]))
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    shares = {"low": 0.2, "mid": 0.5, "top": 1.0, "first": 0.0}
    got = {r.g: tuple(r[n] for n in shares) for r in quantiles.exact_quantiles(df, ["g"], "v", shares).collect()}
    want = {r.g: tuple(r.q) for r in df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, shares.values()))).alias("q")).filter("q is not null").collect()}
    assert got == want
    plan = quantiles.exact_quantiles(df, ["g"], "v", shares)._jdf.queryExecution().toString()
    assert "percentile" not in plan
    all_groups = quantiles.with_quantiles(df.select("g").distinct(), df, ["g"], "v", {"mid": 0.5})
    assert {r.g: r.mid for r in all_groups.collect()} == {g: (got[g][1] if g in got else None) for g in {r[0] for r in rows}}
