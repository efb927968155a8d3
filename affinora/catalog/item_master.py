"""Queries: item master and marketing proxies."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinora.catalog.common import SINCE_BULK, stage, tidy
from affinora.operators import ranking
from affinora.plans import item_master as M
from affinora.plans import proxies as P
from affinora.session import cut_lineage

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
AS_OF = "2001-08-02"
CODES = ["AU", "NZ", "SG", "CA", "DE", "AT", "CH", "ES", "PT", "IT", "SE", "DK", "NO", "FI", "FR", "NL", "BE", "IN", "GB", "UK", "IE", "US"]
EXCLUDED = ["PROMO"]


def _add(name, fn, sql):
    QUERIES[name] = fn
    if sql:
        ORACLE[name] = sql


def _customers_by_code(fx):
    code = F.get(F.array(*[F.lit(c) for c in CODES]), (F.col("c_nationkey") % 22))
    counts = fx.customer.groupBy(code.alias("country")).agg(F.count(F.lit(1)).alias("customers"))
    return M.region_mapping(counts)


_CODES_SQL = ", ".join(f"({i}, '{c}')" for i, c in enumerate(CODES))
_add("region_mapping", lambda fx: tidy(_customers_by_code(fx)),
     f"""with codes as (select * from (values {_CODES_SQL}) t(k, country))
select country, count(*) as customers,
 case when country in ('AU','NZ','SG') then 'anzs' when country in ('DE','AT','CH') then 'dach' when country in ('ES','PT','IT','SE','DK','NO','FI') then 'eu'
      when country in ('FR','NL','BE') then 'frcen' when country in ('GB','UK','IE') then 'uk' else lower(country) end as region,
 case when country in ('AU','NZ','SG') then 'AU' when country in ('DE','AT','CH') then 'DE' when country in ('ES','PT','IT','SE','DK','NO','FI') then 'IT'
      when country in ('FR','NL','BE') then 'FR' when country in ('GB','UK','IE') then 'GB' else country end as primary_country
from customer join codes on k = c_nationkey % 22 group by 1""")


def _mapping(fx):
    return M.resolve_key_mapping(fx.live_mapping, fx.key_history)


def _active(fx):
    staged = fx.__dict__.get("stages", {}).get("active")
    return staged if staged is not None else M.active_items(fx.status_event, fx.live_mapping)


_RESOLVED = """resolved as (select country, product_key, item, priority from (
  select *, row_number() over (partition by country, product_key order by priority, item) as n from (
   select country, product_key, item, 1 as priority from live_mapping union all
   select country, product_key, item, 2 from (select *, row_number() over (partition by country, product_key order by valid_from desc, created_on desc, item) as k from key_history) h where k = 1) u) v where n = 1)"""
_ACTIVE = """latest_state as (select * from (select *, row_number() over (partition by product_key, product_version order by event_date desc, seq_no desc) as n from status_event) s where n = 1),
active as (select l.item, l.country, v.product_key, v.product_version from (
   select product_key, product_version, row_number() over (partition by product_key order by event_date desc, product_version desc) as n
   from latest_state where status = 'ACTIVE' and is_current) v join live_mapping l on l.product_key = v.product_key where v.n = 1)"""

_add("key_mapping", lambda fx: tidy(_mapping(fx)), f"with {_RESOLVED} select country, product_key, item, priority::bigint as priority from resolved")
_add("active_items", lambda fx: tidy(_active(fx)), f"with {_ACTIVE} select product_key, product_version::bigint as product_version, item, country from active")
_add("all_items", lambda fx: tidy(M.all_items(_mapping(fx), _active(fx), fx.product)),
     f"""with {_RESOLVED}, {_ACTIVE} select r.country, r.product_key, r.item, r.priority::bigint as priority, a.product_version::bigint as product_version,
 p.category, p.subcategory, p.product_group, a.product_version is not null as is_active
 from resolved r left join active a on a.country = r.country and a.product_key = r.product_key and a.item = r.item
 left join product p on p.product_key = r.product_key""")

_AVAILABLE = """available as (select distinct country, product_key from (select country, unnest(from_json(product_keys, '["VARCHAR"]')) as product_key from availability_payload) a)"""
_add("available_items", lambda fx: tidy(M.available_items(fx.availability_payload)),
     f"with {_AVAILABLE} select country, product_key, true as is_available from available")

# The payload is built by rule from the product, so the expected rows follow from the rule directly.
_CONSTRAINTS = """constraints as (
 select product_key, product_version, country, constraint_type, color from (
  select product_key, product_version, concat('C', cast(item % 25 as string)) as country, 'block' as constraint_type, case when item % 3 = 0 then 'all' else color_hex end as color from product
  union all select product_key, product_version, concat('C', cast(item % 25 as string)), 'warn', '#00FF00' from product where item % 10 <> 0 and item % 3 <> 0
  union all select product_key, product_version, concat('C', cast((item + item % 2) % 25 as string)), 'late', 'all' from product where item % 5 = 0) c)"""
_add("parse_constraints", lambda fx: tidy(M.parse_constraints(fx.constraint_payload, "ACME")),
     f"with {_CONSTRAINTS} select distinct product_key, product_version::bigint as product_version, country, constraint_type, color from constraints")
_add("constrained_items", lambda fx: tidy(M.fully_constrained(M.parse_constraints(fx.constraint_payload, "ACME"))),
     f"with {_CONSTRAINTS} select distinct country, product_key, product_version::bigint as product_version, true as is_constrained from constraints where color = 'all'")
_add("accessory_flags", lambda fx: tidy(M.accessory_flags(fx.accessory_payload)),
     "select product_key, is_accessory::bigint as is_accessory from product")
_LOGO = """logo as (select distinct country, item from (select upper(country) as country, unnest(from_json(items, '["BIGINT"]')) as item from logo_payload) l)"""
_add("logomaker_flags", lambda fx: tidy(M.logomaker_flags(fx.logo_payload)), f"with {_LOGO} select country, item, 1::bigint as is_logomaker_enabled from logo")


def _dates(fx):
    return M.merchandise_dates(fx.product_mapping, fx.launch_flag, AS_OF)


_DATES = f"""dates0 as (select m.item, m.country, min(l.launch_date) as min_launch_date, min(cast(m.valid_from as date)) as min_valid_from
 from product_mapping m left join launch_flag l on l.product_key = m.product_key and l.country = m.country group by 1, 2),
dates as (select *, case when coalesce(min_launch_date, date '1900-01-01') < min_valid_from then min_valid_from else min_launch_date end as merchandise_date,
 case when coalesce(min_launch_date, date '1900-01-01') < min_valid_from then 'mapping_valid_from' else 'product_launch' end as merchandise_date_source from dates0)"""
_DATE_COLS = f"""strftime(min_launch_date, '%Y-%m-%d') as min_launch_date, strftime(min_valid_from, '%Y-%m-%d') as min_valid_from,
 strftime(merchandise_date, '%Y-%m-%d') as merchandise_date, merchandise_date_source, date_diff('day', merchandise_date, date '{AS_OF}') as days_since_merchandisable,
 cast(epoch(merchandise_date) as bigint) as creation_timestamp"""
_add("merchandise_dates", lambda fx: tidy(_dates(fx)), f"with {_DATES} select item, country, {_DATE_COLS} from dates")


def _prices(fx):
    return M.moq_prices(fx.offer_payload, _active(fx), fx.country_region)


_PRICES = """prices as (select p.product_key, r.region, c.country,
  case when p.item % 13 = 0 then null when p.item % 6 = 0 then 1 else p.moq end as moq,
  case when p.item % 13 = 0 then null else concat('CUR', r.country) end as currency,
  case when p.item % 13 = 0 then null else cast(round(p.unit_price * 100) as bigint) * p.moq / 100.0 end as total_moq_price,
  case when p.item % 13 = 0 then null else cast(round(p.unit_price * 100) as bigint) / 100.0 end as unit_moq_price
 from product p join (select distinct product_key, country from active) a on a.product_key = p.product_key
 join country_region r on r.country = a.country and r.country = r.primary_country
 join country_region c on c.region = r.region)"""
_add("moq_prices", lambda fx: tidy(_prices(fx)),
     f"""with {_ACTIVE}, {_PRICES} select product_key, region, country, moq::bigint as moq, currency, round(total_moq_price::double, 6) as total_moq_price,
 round(unit_moq_price::double, 6) as unit_moq_price from prices""")


def _copy(fx):
    return M.pick_locale(fx.description_payload)


_add("pick_locale", lambda fx: tidy(_copy(fx)),
     """select product_key, product_version::bigint as product_version, item,
 case when item % 3 = 0 then concat('US ', product_name) when item % 4 <> 0 then concat('H ', product_name) end as headline,
 case when item % 3 = 0 then 'D us' when item % 4 <> 0 then 'D gb' end as description,
 case when item % 3 = 0 then 'L2' when item % 4 <> 0 then 'L1' end as highlights from product""")
_add("missing_descriptions", lambda fx: tidy(M.missing_descriptions(
        _active(fx), _copy(fx).filter("headline is not null"), ["product_key", "product_version"])),
     f"""with {_ACTIVE} select distinct product_key, product_version::bigint as product_version from active a where not exists (
 select 1 from product p where p.product_key = a.product_key and p.product_version = a.product_version and (p.item % 3 = 0 or p.item % 4 <> 0))""")


_add("missing_page_copy", lambda fx: tidy(M.missing_descriptions(
        _active(fx), fx.page_copy.filter("page_title is not null and page_description is not null"), ["item", "country"])),
     f"""with {_ACTIVE} select distinct item, country from active a where not exists (
 select 1 from page_copy p where p.item = a.item and p.country = a.country and p.page_title is not null and p.page_description is not null)""")


def _categories(fx):
    return M.site_categories(fx.hierarchy_payload).withColumn("item", F.col("item").cast("bigint"))


_CATS = """nodes as (select country, unnest(from_json(body, '[{"id":"VARCHAR","parentId":"VARCHAR","type":"VARCHAR"}]')) as n from hierarchy_payload),
parents as (select country, n.id as id, max(n.parentId) as parent from nodes where n.type = 'category' group by 1, 2),
categories as (select distinct a.country, cast(a.n.id as bigint) as item, a.n.parentId as site_category, b.parent as parent_site_category
 from nodes a left join parents b on b.country = a.country and b.id = a.n.parentId where a.n.type = 'product')"""
_add("site_categories", lambda fx: tidy(_categories(fx)), f"with {_CATS} select country, item, site_category, parent_site_category from categories")


def _base(fx):
    return M.base_items(
        _active(fx), M.fully_constrained(M.parse_constraints(fx.constraint_payload, "ACME")),
        M.available_items(fx.availability_payload), _categories(fx), M.accessory_flags(fx.accessory_payload),
        M.logomaker_flags(fx.logo_payload), fx.product, fx.country_region, _prices(fx), _dates(fx), EXCLUDED)


_add("base_items", lambda fx: tidy(_base(fx)),
     f"""with {_ACTIVE}, {_AVAILABLE}, {_CONSTRAINTS}, {_LOGO}, {_CATS}, {_PRICES}, {_DATES}
select a.product_key, a.country, a.item, a.product_version::bigint as product_version, c.site_category, c.parent_site_category, p.is_accessory::bigint as is_accessory,
 case when l.item is null then 0 else 1 end::bigint as is_logomaker_enabled, p.category, p.subcategory, p.product_group, r.region, r.primary_country,
 pr.moq::bigint as moq, pr.currency, round(pr.total_moq_price::double, 6) as total_moq_price, round(pr.unit_moq_price::double, 6) as unit_moq_price, {_DATE_COLS}
from active a join categories c on c.item = a.item and c.country = a.country
join product p on p.product_key = a.product_key and p.category <> 'PROMO'
join country_region r on r.country = a.country
left join logo l on l.item = a.item and l.country = a.country
left join prices pr on pr.product_key = a.product_key and pr.country = a.country
left join dates d on d.item = a.item and d.country = a.country
where (a.country, a.product_key) in (select country, product_key from available)
  and not exists (select 1 from constraints k where k.color = 'all' and k.product_key = a.product_key and k.product_version = a.product_version and k.country = a.country)""")


# --- proxies --------------------------------------------------------------------------------

def _priced_items(fx):
    return fx.base_item.withColumn("currency", F.concat(F.lit("CUR"), "country"))


def _high_value(fx):
    return P.high_value_proxy(_priced_items(fx), P.rates_of(fx.fx_rate, AS_OF), EXCLUDED)


_LABEL = "case when pct_rank <= 0.25 then '4_least' when pct_rank <= 0.5 then '3_low' when pct_rank <= 0.75 then '2_medium' when pct_rank is not null then '1_high' end"
HIGH_VALUE = """hv_avg as (select region, category, subcategory, product_group, item, min(moq) as default_moq, round(avg(usd), 6) as avg_price from (
   select distinct b.region, b.category, b.subcategory, b.product_group, b.item, b.product_key, b.moq, b.unit_price * f.rate_to_usd as usd
   from base_item b left join fx_rate f on f.country = b.country and f.to_currency = 'USD' and f.rate_date = date '2001-08-01' where b.category <> 'PROMO') u group by 1, 2, 3, 4, 5),
hv1 as (select *, median(avg_price) over (partition by region, product_group) as group_median, median(avg_price) over (partition by region, subcategory) as subcategory_median,
   avg(avg_price) over (partition by region, category) as category_avg from hv_avg),
hv2 as (select *, coalesce(avg_price, group_median, subcategory_median) as price from hv1),
hv as (select *, """ + _LABEL + """ as label from (select *, case when price is not null then percent_rank() over (partition by region, category, price is null order by price) end as pct_rank from hv2) h)"""
_add("proxy_high_value", lambda fx: tidy(_high_value(fx).drop("category_items")),
     f"""with {HIGH_VALUE} select region, category, subcategory, product_group, item, default_moq::bigint as default_moq, round(avg_price, 6) as avg_price, round(group_median, 6) as group_median,
 round(subcategory_median, 6) as subcategory_median, round(category_avg, 6) as category_avg, round(price, 6) as price, case when avg_price is null then 1 else 0 end::bigint as price_imputed,
 round(price / category_avg, 6) as category_ratio, round(pct_rank, 6) as pct_rank, label from hv""")


def _zoned(lines):
    return lines.withColumn("zone", F.format_string("+%02d:00", "utc_offset"))


def _bulk(fx):
    return P.bulk_proxy(_zoned(fx.order_line), fx.product_mapping, fx.base_item, SINCE_BULK, EXCLUDED, "zone")


def shrink_sql(prefix, n, value, prior, groups, score):
    on = " and ".join(f"p.{g} = {{t}}.{g}" for g in groups)
    g = ", ".join(groups)
    return f"""{prefix}_w as (select {g}, quantile_cont({n}, 0.2) as system_weight from {prefix}_product group by {g}),
{prefix}_s as (select p.*, w.system_weight, s.* exclude ({g}), (w.system_weight * s.{prior} + p.{n} * p.{value}) / (w.system_weight + p.{n}) as shrunk
  from {prefix}_product p join {prefix}_w w on {on.format(t='w')} join {prefix}_system s on {on.format(t='s')}),
{prefix}_c as (select *, {score} as score from {prefix}_s),
{prefix} as (select *, {_LABEL} as label from (select *, case when score is not null then percent_rank() over (partition by region, score is null order by score) end as pct_rank from {prefix}_c) x)"""


BULK = """bulk_sold as (select b.region, b.category, b.subcategory, b.product_group, m.item, o.order_number, o.quantity
  from order_line o join product_mapping m on m.product_key = o.product_key and m.country = o.country
   and o.created_at - to_hours(o.utc_offset) >= m.valid_from and o.created_at - to_hours(o.utc_offset) < m.valid_to
  join base_item b on b.item = m.item and b.country = m.country where o.created_at >= timestamp '""" + SINCE_BULK + """'),
bulk_product as (select region, category, subcategory, product_group, item, count(distinct order_number) as order_count, median(quantity) as median_quantity
  from bulk_sold where category <> 'PROMO' group by 1, 2, 3, 4, 5),
bulk_system as (select region, category, subcategory, product_group, count(distinct order_number) as system_order_count, median(quantity) as system_median from bulk_sold group by 1, 2, 3, 4),
""" + shrink_sql("bulk", "order_count", "median_quantity", "system_median", ["region", "category", "subcategory", "product_group"],
                 "case when order_count < 50 then round(shrunk) else median_quantity end")
_add("proxy_bulk", lambda fx: tidy(_bulk(fx)),
     f"""with {BULK} select region, category, subcategory, product_group, item, order_count, round(median_quantity, 6) as median_quantity, round(system_weight, 6) as system_weight,
 system_order_count, round(system_median, 6) as system_median, round(score, 6) as score, label from bulk""")


def _ratings(fx):
    return P.ratings_proxy(fx.review, _zoned(fx.order_line), fx.product_mapping, fx.base_item, EXCLUDED, "zone")


RATINGS = """rating_rows as (select b.region, b.category, b.subcategory, b.product_group, m.item, r.review_id, r.rating
  from review r left join (select order_number, line_no, min(created_at - to_hours(utc_offset)) as created_at from order_line group by 1, 2) o on o.order_number = r.order_number and o.line_no = r.line_no
  join product_mapping m on m.product_key = r.product_key and m.country = r.country and coalesce(o.created_at, r.created_at) >= m.valid_from and coalesce(o.created_at, r.created_at) < m.valid_to
  join base_item b on b.item = m.item and b.country = m.country where r.published_flag = 1 and b.category <> 'PROMO'),
ratings_product as (select region, category, subcategory, product_group, item, count(distinct review_id) as rating_count, avg(rating) as rating_avg from rating_rows group by 1, 2, 3, 4, 5),
ratings_system as (select region, category, subcategory, count(distinct review_id) as system_rating_count, avg(rating) as system_rating_avg from rating_rows group by 1, 2, 3),
""" + shrink_sql("ratings", "rating_count", "rating_avg", "system_rating_avg", ["region", "category", "subcategory"], "round(cast(shrunk as decimal(18, 9)), 3)::double")
_add("proxy_ratings", lambda fx: tidy(_ratings(fx)),
     f"""with {RATINGS} select region, category, subcategory, product_group, item, rating_count, round(rating_avg, 6) as rating_avg, round(system_weight, 6) as system_weight,
 system_rating_count, round(system_rating_avg, 6) as system_rating_avg, round(score, 6) as score, label from ratings""")


def _durations(fx):
    return P.design_durations(fx.design_session, fx.site_session, fx.product_mapping, "2022-07-31")


def _complexity(fx):
    return P.design_complexity_proxy(_durations(fx), fx.base_item, EXCLUDED)


DURATIONS = """visit_start as (select visit_id, min(session_start) as session_start from (
   select unnest(from_json(visit_ids, '["VARCHAR"]')) as visit_id, session_start from site_session) v group by 1),
completed as (select d.unique_session_id, min(v.session_start) as session_start from design_session d join visit_start v on v.visit_id = d.visit_id where d.label = 'Continue Button' group by 1),
shared as (select work_id, count(distinct session_id) > 1 as is_shared from design_session where work_id is not null group by 1),
timed as (select m.item, d.country, coalesce(s.is_shared, false) as is_shared, d.session_id, d.work_id, d.duration_ms from design_session d
   join completed c on c.unique_session_id = d.unique_session_id left join shared s on s.work_id = d.work_id
   join product_mapping m on m.product_key = d.product_key and m.country = d.country and c.session_start >= m.valid_from and c.session_start < m.valid_to
   where d.label = 'Studio review page view'),
durations as (
   select country, item, false as is_shared, session_id as design_id, (cast(sum(duration_ms) as bigint) * 20 + 60000) // 120000 / 10 as minutes from timed where not is_shared group by 1, 2, 4
   union all select country, item, true, work_id, (cast(sum(duration_ms) as bigint) * 20 + 60000) // 120000 / 10 from timed where is_shared group by 1, 2, 4)"""
COMPLEXITY = DURATIONS + """,
cx_rows as (select b.region, b.category, b.subcategory, b.product_group, d.item, d.design_id, d.minutes from durations d join base_item b on b.item = d.item and b.country = d.country where b.category <> 'PROMO'),
complexity_product as (select region, category, subcategory, product_group, item, count(design_id) as design_count, median(minutes) as median_minutes from cx_rows group by 1, 2, 3, 4, 5),
complexity_system as (select region, category, subcategory, count(design_id) as system_design_count, median(minutes) as system_median_minutes from cx_rows group by 1, 2, 3),
""" + shrink_sql("complexity", "design_count", "median_minutes", "system_median_minutes", ["region", "category", "subcategory"], "round(shrunk, 9)")
_add("design_durations", lambda fx: tidy(_durations(fx)), f"with {DURATIONS} select country, item, is_shared, design_id, minutes from durations")
_add("proxy_design_complexity", lambda fx: tidy(_complexity(fx)),
     f"""with {COMPLEXITY} select region, category, subcategory, product_group, item, design_count, round(median_minutes, 6) as median_minutes, round(system_weight, 6) as system_weight,
 system_design_count, round(system_median_minutes, 6) as system_median_minutes, round(score, 6) as score, label from complexity""")


def _features(fx):
    """Active versions and base items stand in many branches: built once."""
    fx._frames["base_item"] = stage(fx, "base_item", lambda f: f.base_item, True)
    stage(fx, "active", _active)
    price = _prices(fx).select("product_key", "country", "currency", "moq", "total_moq_price", "unit_moq_price")
    item_price = ranking.latest(price, ["product_key", "country"], ["moq", "total_moq_price", "unit_moq_price", "currency"])
    # one plan of all proxies and joins, planned anew after every stage, would fill the driver
    regional = [cut_lineage(p) for p in (
        _high_value(fx).select("region", "item", F.col("label").alias("high_value")),
        _bulk(fx).select("region", "item", F.col("label").alias("bulk"), "median_quantity"),
        _ratings(fx).select("region", "item", F.col("score").alias("rating"), F.col("label").alias("rating_label")),
        _complexity(fx).select("region", "item", F.col("score").alias("studio_minutes"), F.col("label").alias("complexity")),
    )]
    return M.all_features(
        M.all_items(_mapping(fx), _active(fx), fx.product), fx.country_region,
        by_item=[_categories(fx), _dates(fx), M.logomaker_flags(fx.logo_payload), fx.page_copy],
        by_product=[M.accessory_flags(fx.accessory_payload)],
        by_version=[_copy(fx).drop("item")],
        by_product_country=[item_price, M.available_items(fx.availability_payload)],
        by_version_country=[M.fully_constrained(M.parse_constraints(fx.constraint_payload, "ACME"))],
        regional=regional,
        defaults={"is_logomaker_enabled": 0, "is_constrained": False, "is_available": False})


_add("all_features", lambda fx: tidy(_features(fx)),
     f"""with {_RESOLVED}, {_ACTIVE}, {_AVAILABLE}, {_CONSTRAINTS}, {_LOGO}, {_CATS}, {_PRICES}, {_DATES}, {HIGH_VALUE}, {BULK}, {RATINGS}, {COMPLEXITY}
select r.country, r.product_key, r.item, r.priority::bigint as priority, a.product_version::bigint as product_version, p.category, p.subcategory, p.product_group,
 a.product_version is not null as is_active, p.is_accessory::bigint as is_accessory,
 case when p2.item is null then null when p2.item % 3 = 0 then concat('US ', p2.product_name) when p2.item % 4 <> 0 then concat('H ', p2.product_name) end as headline,
 case when p2.item is null then null when p2.item % 3 = 0 then 'D us' when p2.item % 4 <> 0 then 'D gb' end as description,
 case when p2.item is null then null when p2.item % 3 = 0 then 'L2' when p2.item % 4 <> 0 then 'L1' end as highlights,
 pc.page_title, pc.page_description, c.site_category, c.parent_site_category, pr.currency, pr.moq::bigint as moq, round(pr.total_moq_price::double, 6) as total_moq_price, round(pr.unit_moq_price::double, 6) as unit_moq_price,
 {_DATE_COLS}, case when l.item is null then 0 else 1 end::bigint as is_logomaker_enabled, k.product_key is not null as is_constrained, av.product_key is not null as is_available,
 hv.label as high_value, bulk.label as bulk, round(bulk.median_quantity, 6) as median_quantity, round(ratings.score, 6) as rating, ratings.label as rating_label,
 round(complexity.score, 6) as studio_minutes, complexity.label as complexity
from resolved r left join active a on a.country = r.country and a.product_key = r.product_key and a.item = r.item
left join product p on p.product_key = r.product_key
left join product p2 on p2.product_key = r.product_key and p2.product_version = a.product_version
left join categories c on c.item = r.item and c.country = r.country
left join page_copy pc on pc.item = r.item and pc.country = r.country
left join prices pr on pr.product_key = r.product_key and pr.country = r.country
left join dates d on d.item = r.item and d.country = r.country
left join logo l on l.item = r.item and l.country = r.country
left join (select distinct product_key, product_version, country from constraints where color = 'all') k on k.product_key = r.product_key and k.product_version = a.product_version and k.country = r.country
left join available av on av.product_key = r.product_key and av.country = r.country
join country_region g on g.country = r.country
left join hv on hv.item = r.item and hv.region = g.region left join bulk on bulk.item = r.item and bulk.region = g.region
left join ratings on ratings.item = r.item and ratings.region = g.region left join complexity on complexity.item = r.item and complexity.region = g.region""")
