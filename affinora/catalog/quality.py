"""Queries: data-quality checks and table maintenance."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from affinora.catalog.common import tidy
from affinora.operators import merge, quality
from affinora.session import ensure_checkpoint_dir
from affinora.sources import partitioned, snapshots

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name, fn, sql):
    QUERIES[name] = fn
    ORACLE[name] = sql


_SCHEMA = "c_custkey bigint, c_nationkey bigint, c_mktsegment string, c_acctbal double"


def _exported(fx):
    """Two snapshots of the customers per region group: an older one with other balances, and the newest."""
    root = f"{ensure_checkpoint_dir(fx.spark)}/snapshots-{uuid.uuid4().hex}"
    rows = fx.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    for group, side in (("even", rows.filter("c_nationkey % 2 = 0")), ("odd", rows.filter("c_nationkey % 2 = 1"))):
        snapshots.write_snapshot(side.withColumn("c_acctbal", F.lit(0.0)), root, group, "customers", "20240101000000", 4)
        snapshots.write_snapshot(side, root, group, "customers", "20240201000000", 4)
    return root


_add("snapshot_latest", lambda fx: tidy(snapshots.read_latest(fx.spark, _exported(fx), "even", "customers", _SCHEMA, 2, "20240301000000")),
     """select c_custkey, c_nationkey, c_mktsegment, case when s = '20240201000000' then round(c_acctbal, 6) else 0.0 end as c_acctbal, s as snapshot
 from customer, unnest(['20240101000000', '20240201000000']) t(s) where c_nationkey % 2 = 0""")
_add("snapshot_range", lambda fx: tidy(snapshots.read_range(fx.spark, _exported(fx), {"eu": "even", "us": "odd"}, "customers", _SCHEMA, "20240115000000", "20240401000000")),
     """select c_custkey, c_nationkey, c_mktsegment, round(c_acctbal, 6) as c_acctbal, case when c_nationkey % 2 = 0 then 'eu' else 'us' end as region, '20240201000000' as snapshot from customer""")


_CUR = "select item, country, product_version, unit_price, category, subcategory from base_item where item % 10 <> 3"
_NEW = """select item, country, case when item % 11 = 0 then product_version + 1 else product_version end as product_version,
 case when item % 7 = 0 then unit_price * 1.1 else unit_price end as unit_price,
 case when item % 17 = 0 then null else category end as category, subcategory from base_item where item % 10 <> 5"""


def _current(fx):
    return fx.base_item.filter("item % 10 <> 3").select("item", "country", "product_version", "unit_price", "category", "subcategory")


def _incoming(fx):
    return fx.base_item.filter("item % 10 <> 5").select(
        "item", "country", F.when(F.expr("item % 11 = 0"), F.col("product_version") + 1).otherwise(F.col("product_version")).alias("product_version"),
        F.when(F.expr("item % 7 = 0"), F.col("unit_price") * 1.1).otherwise(F.col("unit_price")).alias("unit_price"),
        F.when(F.expr("item % 17 <> 0"), F.col("category")).alias("category"), "subcategory")


_KEYS = ["item", "country"]
_COLS = "item, country, product_version, round(unit_price, 6) as unit_price, category, subcategory"

_add("merge_upsert", lambda fx: tidy(merge.merge_upsert(_current(fx), _incoming(fx), _KEYS)),
     f"""select {_COLS} from ({_NEW}) n union all select {_COLS} from ({_CUR}) c
 where not exists (select 1 from ({_NEW}) n where n.item = c.item and n.country = c.country)""")
_add("merge_update_columns", lambda fx: tidy(merge.merge_upsert(_current(fx), _incoming(fx), _KEYS, ["unit_price"])),
     f"""select coalesce(c.item, n.item) as item, coalesce(c.country, n.country) as country,
 case when c.item is null then n.product_version else c.product_version end as product_version,
 round(case when n.item is null then c.unit_price else n.unit_price end, 6) as unit_price,
 case when c.item is null then n.category else c.category end as category,
 case when c.item is null then n.subcategory else c.subcategory end as subcategory
 from ({_CUR}) c full join ({_NEW}) n on n.item = c.item and n.country = c.country""")
_add("merge_delete_unmatched", lambda fx: tidy(merge.delete_not_matched_by_source(
        _current(fx), _incoming(fx), _KEYS, F.col("category") == "ECONOMY")),
     f"""select {_COLS} from ({_CUR}) c where category <> 'ECONOMY' or exists (
 select 1 from ({_NEW}) n where n.item = c.item and n.country = c.country)""")
_add("merge_changed_rows", lambda fx: tidy(merge.changed_rows(
        _incoming(fx), _current(fx), _KEYS, "product_version", "unit_price", ["category", "subcategory"])),
     f"""select * from (select n.item, n.country, n.product_version, round(n.unit_price, 6) as unit_price, n.category, n.subcategory,
 case when c.item is null then 'new' when n.product_version is distinct from c.product_version then 'version'
      when abs((n.unit_price - c.unit_price) / c.unit_price) >= 0.05 or (c.unit_price is null and n.unit_price is not null) then 'price'
      when n.category is distinct from c.category or n.subcategory is distinct from c.subcategory then 'attribute' end as change
 from ({_NEW}) n left join ({_CUR}) c on n.item = c.item and n.country = c.country) x where change is not null""")
_add("merge_sync_changes", lambda fx: tidy(merge.sync_changes(_current(fx), _incoming(fx).select("item", "country", "subcategory"), _KEYS)),
     f"""select item, country, subcategory, 'put' as op from ({_NEW}) n union all
 select item, country, null as subcategory, 'delete' as op from ({_CUR}) c
 where not exists (select 1 from ({_NEW}) n where n.item = c.item and n.country = c.country)""")
_add("merge_retention", lambda fx: tidy(merge.retain_since(
        fx.orders.groupBy(F.col("o_orderdate").cast("date").alias("created_on")).agg(F.count(F.lit(1)).alias("n")), "created_on", "2001-08-02")),
     """select strftime(cast(o_orderdate as date), '%Y-%m-%d') as created_on, count(*) as n from orders
 where cast(o_orderdate as date) >= date '2000-07-02' group by 1""")


# --- the same on a partitioned folder: only touched partitions are read and rewritten ----------------

def _folder(fx, rows, by):
    path = f"{ensure_checkpoint_dir(fx.spark)}/partitions-{uuid.uuid4().hex}"
    partitioned.create(rows, path, by)
    return path


def _read(fx, path, columns):
    return fx.spark.read.parquet(path).select(*columns)


_SIDE = "country in ('US', 'GB', 'C3', 'C4', 'C5')"


def _partition_upsert(fx):
    current = _current(fx)
    path = _folder(fx, current, ["country"])
    partitioned.upsert(path, _incoming(fx).filter(_SIDE), _KEYS, ["country"])
    return _read(fx, path, current.columns)


def _partition_delete(fx):
    current = _current(fx)
    path = _folder(fx, current, ["country"])
    # Countries of the scope that the source lacks altogether are emptied.
    partitioned.delete_not_matched_by_source(path, _incoming(fx).filter("country <> 'US'"), _KEYS, ["country"], F.expr(_SIDE))
    return _read(fx, path, current.columns)


def _partition_retention(fx):
    daily = fx.orders.groupBy(F.col("o_orderdate").cast("date").alias("created_on")).agg(F.count(F.lit(1)).alias("n"))
    path = _folder(fx, daily.withColumn("month", F.date_format("created_on", "yyyy-MM")), ["month"])
    partitioned.retain(fx.spark, path, ["month"], F.col("created_on") >= F.add_months(F.lit("2001-08-02").cast("date"), -13))
    return _read(fx, path, ["created_on", "n"])


_add("merge_upsert_partitions", lambda fx: tidy(_partition_upsert(fx)),
     f"""select {_COLS} from ({_NEW}) n where {_SIDE} union all select {_COLS} from ({_CUR}) c
 where not exists (select 1 from ({_NEW}) n where n.item = c.item and n.country = c.country and {_SIDE})""")
_add("merge_delete_partitions", lambda fx: tidy(_partition_delete(fx)),
     f"""select {_COLS} from ({_CUR}) c where not ({_SIDE}) or exists (
 select 1 from ({_NEW}) n where n.item = c.item and n.country = c.country and n.country <> 'US')""")
_add("merge_retention_partitions", lambda fx: tidy(_partition_retention(fx)), ORACLE["merge_retention"])


def _observed(fx):
    checks = quality.observed_checks(["unit_price", "site_category", "category"], {"category": ["ECONOMY", "PROMO", "SMALL"]}, ["unit_price", "moq"])
    return quality.write_observed(fx.base_item, f"{ensure_checkpoint_dir(fx.spark)}/observed-{uuid.uuid4().hex}", checks, fx.part.count())


_add("checks_while_written", lambda fx: tidy(_observed(fx)),
     """with counted as (select count(*) as n, count(*) filter (where unit_price is null) as a, count(*) filter (where site_category is null or length(site_category) < 1) as b,
  count(*) filter (where category is null or length(category) < 1) as c, count(*) filter (where category not in ('ECONOMY', 'PROMO', 'SMALL')) as d,
  count(*) filter (where unit_price < 0) as e, count(*) filter (where moq < 0) as f from base_item)
 select 'rows' as "check", '' as column_name, n, abs(n - p) / p > 0.05 as failed from counted, (select count(*) as p from part)
 union all select 'null', 'unit_price', a, a > 0 from counted union all select 'null', 'site_category', b, b > 0 from counted
 union all select 'null', 'category', c, c > 0 from counted union all select 'domain', 'category', d, d > 0 from counted
 union all select 'negative', 'unit_price', e, e > 0 from counted union all select 'negative', 'moq', f, f > 0 from counted""")

_add("check_duplicates", lambda fx: tidy(quality.duplicates(fx.lineitem, ["l_orderkey", "l_linenumber"])),
     "select l_orderkey, l_linenumber::bigint as l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
_add("check_nulls", lambda fx: tidy(quality.null_columns(fx.product, ["item", "category", "unit_price", "site_category"])),
     "select 'unit_price' as column_name, count(*) as n from product where unit_price is null")
_add("check_all_null", lambda fx: tidy(quality.all_null_columns(
        fx.product.select("item", F.when(F.expr("item < 0"), F.col("category")).alias("empty_category"), "unit_price"), ["item", "empty_category", "unit_price"])),
     "select 'empty_category' as column_name where (select count(*) from product where item < 0) = 0")
_add("check_domain", lambda fx: tidy(quality.outside_domain(fx.product, "category", ["ECONOMY", "PROMO", "SMALL"])),
     "select category, count(*) as n from product where category not in ('ECONOMY', 'PROMO', 'SMALL') group by 1")
_add("check_exact_domain", lambda fx: tidy(quality.domain_difference(fx.product, "category", ["ECONOMY", "PROMO", "SMALL", "MISSING"])),
     """select category as value, 'unexpected' as problem from product where category not in ('ECONOMY', 'PROMO', 'SMALL', 'MISSING') group by 1
 union all select v as value, 'absent' as problem from (values ('ECONOMY'), ('PROMO'), ('SMALL'), ('MISSING')) t(v) where v not in (select category from product)""")
_add("check_negative", lambda fx: tidy(quality.negatives(fx.customer, "c_acctbal")),
     "select c_custkey, c_name, c_nationkey::bigint as c_nationkey, round(c_acctbal, 6) as c_acctbal, c_mktsegment from customer where c_acctbal < 0")
_add("check_count_drift", lambda fx: tidy(quality.count_drift(fx.base_item.filter("item % 10 <> 3"), fx.base_item)),
     """select * from (select c as current_rows, p as previous_rows, round(abs(c - p) / p, 6) as change
 from (select cast(sum(case when item % 10 <> 3 then 1 else 0 end) as bigint) as c, count(*) as p from base_item) x) y where change > 0.05""")


def _by_country(df):
    return df.groupBy("country").agg(F.count(F.lit(1)).alias("n"))


_add("check_group_drift", lambda fx: tidy(quality.group_drift(
        _by_country(fx.base_item.filter("item % 10 <> 3 or country in ('C1', 'C2')")), _by_country(fx.base_item), "country", "n", 0.09)),
     """select * from (select country, a as new_value, b as old_value, round((a - b) / b, 6) as change from (
 select country, cast(sum(case when item % 10 <> 3 or country in ('C1', 'C2') then 1 else 0 end) as bigint) as a, count(*) as b from base_item group by 1) x) y where abs(change) > 0.09""")
_add("check_null_ratio", lambda fx: tidy(quality.null_ratio_above(fx.base_item, "unit_price")),
     """select * from (select count(*) as rows, count(*) - count(unit_price) as nulls, round((count(*) - count(unit_price)) / count(*), 2) as null_ratio
 from base_item) x where null_ratio > 0.05""")
_add("check_cardinality", lambda fx: tidy(quality.cardinality(fx.base_item, {"country": 25, "region": 8, "category": 6})),
     """select 'region' as column_name, count(distinct region) as found, cast(8 as bigint) as expected from base_item having count(distinct region) <> 8""")


_FEATURES = ["unit_price", "site_category", "moq"]


def _flags(fx, shift):
    rows = fx.base_item.select(
        "region", "item", F.when(F.expr(f"item % 7 <> {shift}"), F.col("unit_price")).alias("unit_price"),
        F.when(F.expr(f"item % 5 = {shift}"), F.lit("")).otherwise(F.col("site_category")).alias("site_category"), "moq").distinct()
    return quality.missing_flags(rows, ["region", "item"], _FEATURES)


def _flag_sql(shift):
    return f"""select distinct region, item, case when unit_price is null or item % 7 = {shift} then 1 else 0 end::bigint as unit_price_missing,
 case when item % 5 = {shift} then 1 else 0 end::bigint as site_category_missing, 0::bigint as moq_missing from base_item"""


_add("check_missing_flags", lambda fx: tidy(_flags(fx, 1)), _flag_sql(1))
_add("check_newly_missing", lambda fx: tidy(quality.newly_missing(_flags(fx, 1), _flags(fx, 2), ["region", "item"], _FEATURES)),
     f"""select n.region, n.item, 'unit_price' as feature, 1::bigint as is_missing from ({_flag_sql(2)}) n join ({_flag_sql(1)}) o on o.region = n.region and o.item = n.item
 where o.unit_price_missing = 0 and n.unit_price_missing = 1
 union all select n.region, n.item, 'site_category', 1 from ({_flag_sql(2)}) n join ({_flag_sql(1)}) o on o.region = n.region and o.item = n.item
 where o.site_category_missing = 0 and n.site_category_missing = 1""")
_add("check_null_profile", lambda fx: tidy(quality.null_profile(
        fx.raw_config, "product_group", ["gender", "panels", "material", "pockets"])),
     """select product_group, count(*) as rows, count(*) - count(gender) as gender_missing, count(*) - count(panels) as panels_missing,
 count(*) - count(material) as material_missing, count(*) - count(pockets) as pockets_missing from raw_config group by 1""")
_add("check_rows_with_missing", lambda fx: tidy(quality.rows_with_missing(fx.raw_config, ["gender", "material"])
        .select("product_key", "market", "gender", "material")),
     "select product_key, market, gender, material from raw_config where gender is null or material is null")
