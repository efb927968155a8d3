"""What queries leave on the executors' disks while they run."""

import os
import re
from urllib.parse import urlparse

import pytest

import __spark_entry__ as entry_module
from affinora import session
from affinora.plans import bundles


def _lists(spark):
    ranked = spark.createDataFrame(
        [("A", 1, 10, 1), ("A", 1, 11, 2), ("A", 1, 12, 3), ("B", 1, 10, 1), ("B", 1, 13, 2), ("A", 1, 10, 1), (None, 1, 10, 1)],
        "locale string, source long, target long, rank int")
    base = spark.createDataFrame([("x", 10), ("x", 11), ("x", 11), ("y", 12), ("z", 13), ("z", 10), (None, 10), ("x", None)], "country string, item long")
    return ranked, base


def test_country_lists_of_unshared_countries_keep_their_locale(spark):
    ranked, base = _lists(spark)
    countries = spark.createDataFrame([("A", "x"), ("A", "y"), ("A", "y"), ("B", "z"), (None, "x"), ("B", None)], "locale string, country string")
    rows = bundles.region_lists(ranked, countries, base)
    want = {("x", 1, 10, 1), ("x", 1, 11, 2), ("y", 1, 12, 3), ("z", 1, 10, 1), ("z", 1, 13, 2)}
    assert sorted(rows.select("country", "source", "target", "rank").collect()) == sorted(want)
    brought = bundles.with_target_countries(ranked, countries, base)
    assert sorted(bundles.region_lists(brought, countries, base).select("country", "source", "target", "rank").collect()) == sorted(want)
    assert {tuple(r) for r in bundles.country_list_text(rows, 2).collect()} == {("x", 1, "10,11"), ("z", 1, "10,13")}
    assert sorted(tuple(r) for r in bundles.country_list_rows(rows, 2).collect()) == [("x", 1, 10, 1), ("x", 1, 11, 2), ("z", 1, 10, 1), ("z", 1, 13, 2)]


def test_lists_of_a_country_in_two_locales_meet(spark):
    ranked, base = _lists(spark)
    countries = spark.createDataFrame([("A", "x"), ("B", "x"), ("B", "z")], "locale string, country string")
    rows = bundles.region_lists(ranked, countries, base)
    assert {tuple(r) for r in bundles.country_list_text(rows, 2).collect()} == {("x", 1, "10,11"), ("z", 1, "10,13")}


def test_more_countries_than_bits_of_a_word(spark):
    ranked, _ = _lists(spark)
    names = [f"c{k:03}" for k in range(150)]
    countries = spark.createDataFrame([("A", c) for c in names], "locale string, country string")
    base = spark.createDataFrame([(c, 10) for c in names[::3]] + [(names[64], 11), (names[127], 12)], "country string, item long")
    got = {(r.country, r.target) for r in bundles.region_lists(ranked, countries, base).collect()}
    assert got == {(c, 10) for c in names[::3]} | {(names[64], 11), (names[127], 12)}


@pytest.mark.parametrize("name", ["fbt_country_rows", "fbt_country_text"])
def test_rows_fanned_out_to_countries_are_not_shuffled(spark, small, name):
    """Five countries' copies of every list row went through three shuffles; now the lists of a locale go through one."""
    plan = entry_module.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(country#\d+, (source|target)", plan)


def test_shuffle_files_go_with_the_query(spark, small):
    entry_module.queries()["active_items"](spark, small)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def test_packed_rows_are_compressed_and_read_by_column(spark):
    df = spark.range(50000).selectExpr("id", "concat('article ', id % 7) as text", "cast(null as double) as x", "array(id % 3) as l")
    packed = session.cut_packed(df)
    assert packed.dtypes == df.dtypes and packed.exceptAll(df).isEmpty() and packed.count() == 50000
    path = urlparse(session._packed[-1][1]).path
    assert sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path)) < 50000 * 12
    assert "ReadSchema: struct<id:bigint>" in packed.select("id")._jdf.queryExecution().executedPlan().toString()


def test_items_dataset_joins_packed_stages(spark, small):
    """Row checkpoints of the base items and proxies, and the shuffles of the dates, lay beside the shuffles of the last step."""
    plan = entry_module.queries()["items_dataset"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan and "part.parquet" not in plan
