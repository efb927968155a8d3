"""Rules that the oracle alone would not catch, on hand-made frames."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinora import session
from affinora.operators import merge, ranking
from affinora.plans import bundles, datasets, proxies, similarity

T = dt.datetime(2000, 1, 10)
MAPPING = "product_key string, country string, item int, valid_from timestamp, valid_to timestamp"
BASE = "item int, country string, region string, category string, subcategory string, product_group string"


def test_first_view_of_a_search_counts_per_region(spark):
    schema = "event_id long, user_id string, anonymous_id string, ts timestamp, visit string, country string, region string, kind string, item_id string, page_section string, page_search string, page_url string, referrer string, route string, list_section_id string, offer_type string, products string"
    rows = [(n, "u", "a", T + dt.timedelta(minutes=m), "v", c, r, "view", "5", "Configure - Recommendation", "q1", "/s", "/h", "x", None, None, "[]")
            for n, m, c, r in ((1, 1, "US", "us"), (2, 5, "DE", "eu"), (3, 9, "DE", "eu"))]
    ids = spark.createDataFrame([("user_id", "u", "s")], "type string, value string, canonical_id string")
    out = datasets.engagement(spark.createDataFrame(rows, schema), ids, None, "2000-01-01", "2000-02-01")
    assert sorted((r.locale, r.event_type) for r in out.collect()) == [("DE", "addToCart"), ("US", "addToCart")]


def _mapping(spark):
    return spark.createDataFrame([("P", "GB", 1, dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 11)), ("P", "GB", 2, dt.datetime(2000, 1, 11), dt.datetime(2001, 1, 1))], MAPPING)


def _base(spark):
    return spark.createDataFrame([(1, "GB", "uk", "c", "s", "g"), (2, "GB", "uk", "c", "s", "g")], BASE)


def test_bulk_reads_uk_as_gb_and_local_time(spark):
    lines = spark.createDataFrame([("P", "UK", 1, 10.0, dt.datetime(2000, 1, 11, 1), "+02:00"), ("P", "GB", 2, 30.0, dt.datetime(2000, 1, 11, 3), "+02:00")],
                                  "product_key string, country string, order_number int, quantity double, created_at timestamp, zone string")
    out = proxies.bulk_proxy(lines, _mapping(spark), _base(spark), "1999-01-01", [], "zone")
    assert {(r["item"], r["median_quantity"]) for r in out.collect()} == {(1, 10.0), (2, 30.0)}


def test_repeated_order_lines_do_not_weight_a_review(spark):
    reviews = spark.createDataFrame([(1, 7, 1, "P", "UK", 4, T, 1), (2, 8, 1, "P", "GB", 1, T, 1)],
                                    "review_id int, order_number int, line_no int, product_key string, country string, rating int, created_at timestamp, published_flag int")
    lines = spark.createDataFrame([(7, 1, T), (7, 1, T), (7, 1, T), (8, 1, T)], "order_number int, line_no int, created_at timestamp")
    row = proxies.ratings_proxy(reviews, lines, _mapping(spark), _base(spark), []).collect()
    assert [(r["rating_count"], r["rating_avg"]) for r in row] == [(2, 2.5)]


def test_rules_map_keys_valid_at_the_day(spark):
    lines = spark.createDataFrame([("P", "UK", 1)], "product_key string, country string, order_number int")
    assert [r["item"] for r in bundles.map_items(lines, _mapping(spark), "2000-01-10").collect()] == [1]
    assert [r["item"] for r in bundles.map_items(lines, _mapping(spark), "2000-01-11").collect()] == [2]


def test_upsert_refuses_or_orders_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c"), (2, "d")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        merge.merge_upsert(target, source, ["k"]).collect()
    assert {tuple(r) for r in merge.merge_upsert(target, source, ["k"], order=[F.desc("v")]).collect()} == {(1, "c"), (2, "d")}


def test_full_refresh_and_column_names(spark):
    rows = spark.createDataFrame([(1, 1, 2.0)], "k int, ver int, price double")
    assert merge.changed_rows(rows, rows, ["k"], "ver", "price", []).isEmpty()
    assert merge.changed_rows(rows, rows, ["k"], "ver", "price", [], full_refresh=True).first()["change"] == "refresh"
    assert merge.lower_case_columns(rows.toDF("K", "Ver", "PRICE")).columns == ["k", "ver", "price"]
    with pytest.raises(ValueError):
        merge.lower_case_columns(rows.toDF("K", "k", "p"))


def test_percent_rank_equals_the_window(spark):
    rng = np.random.default_rng(0)
    rows = [(int(k), None if rng.random() < 0.1 else float(v)) for k, v in zip(rng.integers(0, 3, 600), np.round(rng.standard_normal(600) * 10, 1))] + [(9, 1.0)]
    df = spark.createDataFrame(rows, "k int, v double")
    plain = spark.sql("select k, v, case when v is not null then percent_rank() over (partition by k, v is null order by v) end as p from {df}", df=df)
    key = lambda r: (r[0], r[1] is None, r[1] or 0)
    a, b = sorted(map(tuple, ranking.percent_rank_of_known(df, ["k"], "v", "p").collect()), key=key), sorted(map(tuple, plain.collect()), key=key)
    assert [x[:2] for x in a] == [x[:2] for x in b] and all(x[2] == pytest.approx(y[2]) for x, y in zip(a, b))


def test_sources_filter_before_pairing(spark):
    rows = [(f"c{k}", "M", f"P{k}", "G", [1.0, k / 10]) for k in range(6)]
    df = spark.createDataFrame(rows, "config_id string, market string, product_key string, product_group string, embedding array<double>")
    whole = similarity.similar_pairs(df, {"G": ["G"]}, 0.5)
    mine = similarity.similar_pairs(df, {"G": ["G"]}, 0.5, sources=F.col("config_id") == "c3", targets=F.col("config_id") != "c4")
    rows = lambda df: sorted((r.source, r.target, round(r.similarity, 9)) for r in df.collect())
    assert rows(mine) == rows(whole.filter("source = 'c3' and target <> 'c4'")) != []


def test_checkpoint_folder_must_be_named_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), spark.conf

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError):
            session.ensure_checkpoint_dir(Session())
