"""The catalogue answers like its oracle at the smallest scale (a spread of families; the full run is oracle_check.py)."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry_module
from affinora import catalog

NAMES = [
    "fbt_rules", "fbt_fallback", "fbt_donor", "fbt_country_rows", "industry_over_index_view", "industry_top_items", "key_mapping",
    "base_items", "proxy_bulk", "users_dataset", "interactions_dataset", "item_to_item", "clean_configs", "text_embedding",
    "similar_pairs", "ranking_quality", "side_by_side", "merge_upsert", "check_exact_domain", "idle_windows",
]


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, small, con, name):
    ok, why, _ = compare(entry_module.queries()[name](spark, small), con, entry_module.oracle_sql()[name])
    assert ok, why


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).columns
