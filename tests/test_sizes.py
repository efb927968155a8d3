"""What a plan may broadcast or leave to one task, whatever the tables' size."""

import re

import pytest

import __spark_entry__ as entry_module
from affinora.fixtures import Fixtures
from affinora.operators import cooccurrence


def planned_broadcasts(df):
    """Texts of the sub-plans that the planner, before anything ran, sends through the driver."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    found = []
    for i, line in enumerate(lines):
        at = line.find("BroadcastExchange")
        if at < 0:
            continue
        below = []
        for other in lines[i + 1 :]:
            if re.search(r"[A-Za-z(]", other) and re.search(r"[A-Za-z(]", other).start() <= at:
                break
            below.append(other)
        found.append("\n".join(below))
    return found


@pytest.mark.parametrize("name", [
    "active_items", "all_items", "available_items", "check_group_drift", "check_missing_flags", "check_newly_missing", "base_items",
    "config_identity", "flag_constrained_configs", "industry_over_index_view", "industry_top_items", "item_config_lists", "merchandise_dates",
])
def test_only_fixed_tables_are_broadcast_by_plan(spark, small, name):
    for below in planned_broadcasts(entry_module.queries()[name](spark, small)):
        tables = set(re.findall(r"/(\w+)\.parquet", below))
        assert tables and tables <= {"nation", "region"}, below


def test_part_rows_are_dealt_to_all_tasks(spark, small):
    """One small file is one scan task; the rows that views make of it must not stay in that task."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks > 1
    fx = Fixtures(spark, small)
    for view in ("product", "sku_attribute", "live_mapping", "logo_payload", "raw_config"):
        assert fx.view(view).rdd.getNumPartitions() == tasks, view


def test_pairs_are_ranked_where_they_lie(spark, small):
    """The pairs come out of the joins dealt by source: neither ranking shuffles them again."""
    plan = entry_module.queries()["rank_substitutes"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(source#\d+,", plan)
    assert not re.search(r"hashpartitioning\(source#\d+, target_product_key#", plan)


def test_pairs_bring_the_totals_of_their_articles(spark):
    """Directed rules are far more than baskets' rows: they meet no join, and pairs read rows that are written once."""
    rows = [("A" if b % 2 else "B", b, (b * 7 + i * 3) % 90) for b in range(40) for i in range(60 if b < 3 else 4)]
    df = spark.createDataFrame(rows, "segment string, basket int, item int")
    for tile in (8, 512):
        rules = cooccurrence.association_rules(df, "segment", "basket", "item", 1, 1, tile)
        plan = rules._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Join[^\n]*\[segment#\d+, (source|target)#", plan)
        assert "Scan ExistingRDD" in plan and "LocalTableScan" not in plan
        total = {(r.segment, r.item): r for r in cooccurrence.item_totals(cooccurrence.distinct_members(df, "segment", "basket", "item")).collect()}
        for r in rules.collect():
            assert (r.source_baskets, r.support) == (total[r.segment, r.source].item_baskets, total[r.segment, r.target].support)


def test_borrowed_lists_are_shuffled_once(spark, small):
    """The lists that articles without one borrow are most of the rows: they know their targets' categories, so only the source's join and the ranking move them."""
    plan = entry_module.queries()["fbt_final_lists"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Join[^\n]*\[locale#\d+, target#", plan[: plan.index("Union")])


def test_order_uptake_reads_orders_once(spark, small):
    plan = entry_module.queries()["industry_over_index_order"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "Scan ExistingRDD" in plan


@pytest.mark.parametrize("name", [
    "check_count_drift", "check_null_ratio", "engaged_overlap", "engaged_subcategories", "fbt_rules_item", "industry_list_gates", "industry_lists", "industry_over_index_cart",
])
def test_larger_tables_are_not_broadcast_by_plan(spark, small, name):
    for below in planned_broadcasts(entry_module.queries()[name](spark, small)):
        tables = set(re.findall(r"/(\w+)\.parquet", below))
        assert tables and tables <= {"nation", "region"}, below


def test_features_join_proxies_that_are_written(spark, small):
    """Proxies inside the plan of the wide table would be planned anew after each of its stages: the driver holds one at a time."""
    plan = entry_module.queries()["all_features"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "pct_rank" not in plan and plan.count("Scan ExistingRDD") >= 5


def test_rated_orders_are_joined_once(spark, small):
    """Products, groups and prior weights read the same reviews: no plan after them holds the order lines."""
    from affinora.plans import proxies

    cut = []
    real = proxies.cut_lineage
    proxies.cut_lineage = lambda df: cut.append(df._jdf.queryExecution().executedPlan().toString()) or real(df)
    try:
        entry_module.queries()["proxy_ratings"](spark, small)
    finally:
        proxies.cut_lineage = real
    assert len(cut) == 2 and "lineitem.parquet" in cut[0] and "lineitem.parquet" not in cut[1]


@pytest.mark.parametrize("name", ["check_count_drift", "check_null_ratio", "flag_constrained_configs", "fbt_bundle_arrays"])
def test_exploded_rows_are_not_broadcast_while_running(spark, small, name):
    """What adaptive execution broadcasts was measured after the explode: its stage lies between a broadcast and an explode."""
    df = entry_module.queries()[name](spark, small)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("== Final Plan ==") : plan.index("== Initial Plan ==")].split("\n")
    depth = [re.search(r"[A-Za-z(*]", line).start() if re.search(r"[A-Za-z(*]", line) else -1 for line in final]
    for i, line in enumerate(final):
        if "BroadcastExchange" not in line:
            continue
        below = []
        for other, at in zip(final[i + 1 :], depth[i + 1 :]):
            if at <= depth[i]:
                break
            below.append((at, other))
        if set(re.findall(r"/(\w+)\.parquet", "\n".join(other for _, other in below))) <= {"nation", "region"}:
            continue
        stage = None
        for at, other in below:
            stage = None if stage is not None and at <= stage else stage
            if stage is None and "ShuffleQueryStage" in other:
                stage = at
            assert stage is not None or "Generate explode" not in other, other
