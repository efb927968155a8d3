"""Query catalogue: every operator as a query over the given tables, with its SQL oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from affinora import fixtures

FAMILIES = ["bundles", "item_master", "datasets", "similarity", "industry", "quality", "storage"]


def _modules():
    return [importlib.import_module(f"affinora.catalog.{name}") for name in FAMILIES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for module in _modules():
        for name, fn in module.QUERIES.items():
            if name in out:
                raise ValueError(f"query {name} registered twice")
            out[name] = lambda spark, sf_dir, fn=fn: fn(fixtures.Fixtures(spark, sf_dir))
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in _modules():
        for name, sql in module.ORACLE.items():
            out[name] = fixtures.duck_sql(sql)
    return out
