"""Co-occurrence: tiles, skew, measures and list cascade against brute force."""

from collections import Counter, defaultdict
from itertools import combinations

from pyspark.sql import functions as F

from affinora.operators import cooccurrence, ranking
from affinora.plans import bundles


def brute_pairs(rows, min_count):
    baskets = defaultdict(set)
    for seg, basket, item in rows:
        baskets[(seg, basket)].add(item)
    counts = Counter()
    for (seg, _), items in baskets.items():
        for a, b in combinations(sorted(items), 2):
            counts[(seg, a, b)] += 1
    return {k: n for k, n in counts.items() if n >= min_count}


def skewed_rows():
    rows = []
    for basket in range(40):
        size = 60 if basket < 3 else 4  # three baskets hold over half of all rows
        rows += [("A" if basket % 2 else "B", basket, (basket * 7 + i * 3) % 90) for i in range(size)]
    return rows + rows[:25]  # repeated rows must not count twice


def test_pair_counts_with_tiles_equal_brute_force(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "segment string, basket int, item int")
    want = brute_pairs(rows, 2)
    for tile in (8, 1000):
        baskets = cooccurrence.distinct_baskets(df, "segment", "basket", "item")
        got = {(r.segment, r.item, r.other): r.pair_count for r in cooccurrence.pair_counts(baskets, 2, tile).collect()}
        assert got == want


def test_rule_measures(spark):
    df = spark.createDataFrame(skewed_rows(), "segment string, basket int, item int")
    rules = cooccurrence.association_rules(df, "segment", "basket", "item", min_targets=1).cache()
    assert rules.filter("confidence <= 0 or confidence > 1 or conviction <= 0").isEmpty()
    total = cooccurrence.item_totals(cooccurrence.distinct_baskets(df, "segment", "basket", "item"))
    for r in total.groupBy("segment").agg(F.sum("support").alias("s")).collect():
        assert abs(r.s - 1) < 1e-9


def test_no_pair_join_is_cartesian_or_python(spark):
    df = spark.createDataFrame(skewed_rows(), "segment string, basket int, item int")
    plan = cooccurrence.association_rules(df, "segment", "basket", "item")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "NestedLoop" not in plan


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = ranking.top_k(df, ["k"], ["id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def lists(spark, rows):
    return spark.createDataFrame(rows, "locale string, source int, target int, rank int")


def test_exclusion_keeps_pairs_without_category_and_closes_gaps(spark):
    ranked = lists(spark, [("A", 1, 2, 1), ("A", 1, 3, 2), ("A", 1, 4, 3), ("B", 1, 2, 1)])
    items = spark.createDataFrame([("A", 1, "x"), ("A", 2, "x"), ("A", 3, None), ("A", 4, "y")], "locale string, item int, site_category string")
    got = {(r.locale, r.target, r["rank"]) for r in bundles.exclude_same_category(ranked, items).collect()}
    assert got == {("A", 3, 1), ("A", 4, 2), ("B", 2, 1)}


def test_min_list_length(spark):
    ranked = lists(spark, [("A", 1, i, i) for i in range(1, 6)] + [("A", 2, 9, 1)])
    assert {r.source for r in bundles.min_list_length(ranked, 5).collect()} == {1}


def test_donor_prefers_primary_and_never_touches_covered_sources(spark):
    cols = "locale string, source int, target int, rank int, target_count int, source_baskets int, pair_count int, confidence double, support double, conviction double, origin string"
    row = lambda s, t, n, o: ("A", s, t, 1, n, 9, 9, 0.5, 0.1, 1.0, o)
    primary = spark.createDataFrame([row(1, 10, 5, "purchase")], cols)
    filled = spark.createDataFrame([row(1, 10, 5, "purchase"), row(2, 20, 50, "view")], cols)
    universe = spark.createDataFrame([("A", 1, "g"), ("A", 2, "g"), ("A", 3, "g"), ("A", 4, None)], "locale string, item int, product_group string")
    got = {(r.source, r.target, r.origin) for r in bundles.donor_fill(primary, filled, universe).collect()}
    assert got == {(1, 10, "purchase"), (2, 20, "view"), (3, 10, "donor")}


def test_distributed_row_number_equals_window(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 101).alias("v"), "id")
    got = ranking.distributed_row_number(df, ["k"], [F.floor(F.col("v") / 10)], ["v", "id"], "rn", "n")
    tiles = got.withColumn("tile", ranking.ntile_of(F.col("rn"), F.col("n"), 20))
    from pyspark.sql import Window

    w = Window.partitionBy("k").orderBy("v", "id")
    check = tiles.withColumn("want_rn", F.row_number().over(w)).withColumn("want_tile", F.ntile(20).over(w))
    assert check.filter("rn <> want_rn or tile <> want_tile").isEmpty()
