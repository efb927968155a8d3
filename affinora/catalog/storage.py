"""Queries: tables by catalog name, bucketed baskets, drifting payloads, snapshots of two layouts, rules of denser baskets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from affinora.catalog.bundles import ORACLE as BUNDLES
from affinora.catalog.bundles import rules_sql
from affinora.catalog.common import ITEM_MIN_COUNT, SINCE_BUNDLES, tidy
from affinora.functions import text
from affinora.operators import merge
from affinora.plans import bundles as B
from affinora.session import cut_lineage, ensure_checkpoint_dir
from affinora.sources import payloads, snapshots, tables

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name, fn, sql):
    QUERIES[name] = fn
    ORACLE[name] = sql


def _table(spark, build):
    """The result of `build(name)`, staged; the table of that name is dropped."""
    name = f"affinora_{uuid.uuid4().hex}"
    try:
        return cut_lineage(build(name))
    finally:
        spark.sql(f"drop table if exists {name}")


# --- tables by name ---------------------------------------------------------------------------------

def _lifecycle(fx):
    """Created once, appended to, given a column, merged into and overwritten with another schema; then read by name."""
    customers = fx.customer.select("c_custkey", "c_mktsegment", "c_acctbal")

    def build(name):
        before = tables.read_or_empty(fx.spark, name, customers.schema)
        tables.create_if_absent(before.unionByName(customers.filter("c_custkey % 3 = 0")), name)
        tables.create_if_absent(customers.filter("c_custkey % 3 = 2"), name)  # exists: nothing happens
        tables.write(customers.filter("c_custkey % 3 = 1"), name)
        newer = customers.filter("c_custkey % 3 = 2").withColumn("Loaded_At", text.compact_time(F.lit("1704164645")))
        tables.add_columns(fx.spark, name, newer)
        tables.write(newer, name)
        now = fx.spark.table(name)
        changed = merge.changed_rows(customers.withColumn("v", F.lit(1)), now.withColumn("v", F.lit(1)), ["c_custkey"], "v", "c_acctbal", [], full_refresh=True)
        merged = merge.merge_upsert(now, changed.filter("c_custkey % 6 = 0").select("c_custkey", F.lit("MERGED").alias("c_mktsegment"), "c_acctbal"), ["c_custkey"], ["c_mktsegment"])
        tables.write(cut_lineage(merge.lower_case_columns(merged.withColumnRenamed("c_mktsegment", "Segment"))), name, "overwrite")
        return fx.spark.table(name)

    return _table(fx.spark, build)


_add("table_lifecycle", lambda fx: tidy(_lifecycle(fx)),
     """select c_custkey, case when c_custkey % 6 = 0 then 'MERGED' else c_mktsegment end as segment, round(c_acctbal, 6) as c_acctbal,
 case when c_custkey % 3 = 2 then '20240102030405' end as loaded_at from customer""")


# --- rules: bucketed baskets, and customers as baskets at two common ones -----------------------------

def _bucketed(fx):
    def build(name):
        tables.write_bucketed(fx.basket_line.select("locale", "basket", "item", "created_at"), name, ["locale", "basket"], 8)
        return B.co_purchase_rules(fx.spark.table(name), SINCE_BUNDLES, min_count=ITEM_MIN_COUNT)

    return _table(fx.spark, build)


_add("fbt_rules_bucketed", lambda fx: tidy(_bucketed(fx)), BUNDLES["fbt_rules"])

_CUSTOMER_LINES = "select 'ALL' as locale, o.o_custkey as basket, l.l_partkey as item, cast(o.o_orderdate as timestamp) as created_at from orders o join lineitem l on l.l_orderkey = o.o_orderkey"
_add("rules_of_customers", lambda fx: tidy(B.co_purchase_rules(fx.sql(_CUSTOMER_LINES), SINCE_BUNDLES, min_count=2, min_targets=1, sketch_bits=22)),
     "select locale, source, target, source_baskets, pair_count, round(avg_basket_size, 6) as avg_basket_size, round(confidence, 6) as confidence, round(support, 6) as support, "
     f"round(conviction, 6) as conviction, target_count from ({rules_sql(f'(select * from ({_CUSTOMER_LINES}) c where created_at >= timestamp {chr(39)}{SINCE_BUNDLES}{chr(39)})', 'locale', 'basket', 'item', min_count=2, min_targets=1)}) r")


# --- payloads whose keys drift ------------------------------------------------------------------------

_DRIFT = """select c_custkey as id, case when c_custkey % 11 = 0 then concat('{"name":"', c_name, '", broken')
 when c_custkey % 5 = 0 then concat('{"name":"', c_name, '","balance":"n/a","extra":{"tier":', cast(c_custkey % 3 as string), '}}')
 when c_custkey % 7 = 0 then null
 else concat('{"name":"', c_name, '","balance":', cast(c_custkey % 1000 as string), ',"segment":"', c_mktsegment, '"}') end as body from customer"""


def _payloads(fx):
    rows, rejected = payloads.opened(fx.sql(_DRIFT), "body")
    found = payloads.fields(rows, {"name": ("$.name", "string"), "balance": ("$.balance", "int"), "tier": ("$.extra.tier", "int")})
    found = found.select("id", "name", "balance", "tier", F.lit(False).alias("rejected"))
    none = [F.lit(None).cast(t).alias(n) for n, t in (("name", "string"), ("balance", "int"), ("tier", "int"))]
    return found.unionByName(rejected.select("id", *none, F.lit(True).alias("rejected")))


_add("payload_fields", lambda fx: tidy(_payloads(fx)),
     """select c_custkey as id, case when c_custkey % 11 <> 0 and (c_custkey % 5 = 0 or c_custkey % 7 <> 0) then c_name end as name,
 case when c_custkey % 11 <> 0 and c_custkey % 5 <> 0 and c_custkey % 7 <> 0 then c_custkey % 1000 end::bigint as balance,
 case when c_custkey % 11 <> 0 and c_custkey % 5 = 0 then c_custkey % 3 end::bigint as tier, c_custkey % 11 = 0 as rejected from customer""")
_add("payload_keys", lambda fx: tidy(payloads.key_profile(payloads.opened(fx.sql(_DRIFT), "body")[0], ["name", "balance", "segment"])),
     """with kinds as (select case when c_custkey % 5 = 0 then 'drift' when c_custkey % 7 <> 0 then 'plain' end as k from customer where c_custkey % 11 <> 0)
 select key, kind, count(*) as n, key <> 'extra' as known from kinds join (values ('drift', 'name', 'STRING'), ('drift', 'balance', 'STRING'), ('drift', 'extra', 'OBJECT'),
  ('plain', 'name', 'STRING'), ('plain', 'balance', 'BIGINT'), ('plain', 'segment', 'STRING')) t(k, key, kind) using (k) group by 1, 2""")


# --- snapshots across a change of layout --------------------------------------------------------------

_SCHEMA = "c_custkey bigint, c_mktsegment string"


def _eras(fx):
    root = f"{ensure_checkpoint_dir(fx.spark)}/eras-{uuid.uuid4().hex}"
    rows = fx.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    side = lambda k: rows.filter(f"c_nationkey % 2 = {k}").drop("c_nationkey")
    for k, group in enumerate(("even", "odd")):
        for stamp in ("20231201000000", "20240101000000"):
            snapshots.write_snapshot(side(k), root, group, "customers", stamp, 2)
    for k, region in enumerate(("eu", "us")):
        for stamp in ("20240201000000", "20240301000000", "20240401000000"):
            snapshots.write_regional_snapshot(side(k), root, "customers", region, stamp, 2)
    return snapshots.read_eras(fx.spark, root, {"eu": "even", "us": "odd"}, "customers", _SCHEMA, "20240101000000", "20240315000000", "20240201000000")


_add("snapshot_eras", lambda fx: tidy(_eras(fx)),
     """select c_custkey, c_mktsegment, case when c_nationkey % 2 = 0 then 'eu' else 'us' end as region, s as snapshot
 from customer, unnest(['20240101000000', '20240201000000', '20240301000000']) t(s)""")
