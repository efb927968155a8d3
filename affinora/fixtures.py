"""Logical entities (products, order lines, events, payloads) derived from the given tables.

Each view is one SQL text that Spark and DuckDB both run. The only dialect difference is a
bounded integer series, written ``{series:a:b}``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinora.session import broadcast_by_measured_size, free_shuffles_early

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Sources of fixed size (25 nations, five regions, their rates): always the broadcast side of a join.
FIXED_SIZE = {"region", "nation", "country_region", "fx_rate"}

EVENTS_AS_OF = "2024-01-31"
ORDERS_AS_OF = "2001-08-02"
LOCALE_ALL = "ALL"

VIEWS: dict[str, str] = {}

VIEWS["country_region"] = """
select n.n_nationkey as nation_key, cast(n.n_nationkey % 9 as int) as utc_offset, concat('C', cast(n.n_nationkey as string)) as country, lower(r.r_name) as region,
       concat('C', cast(min(n.n_nationkey) over (partition by r.r_regionkey) as string)) as primary_country
from nation n join region r on n.n_regionkey = r.r_regionkey
"""

VIEWS["product"] = """
select p_partkey as item, concat('PRD-', cast(p_partkey as string)) as product_key,
       cast(1 + p_partkey % 3 as int) as product_version, p_name as product_name,
       p_type as category, concat(p_type, '/', cast(p_size % 5 as string)) as subcategory, p_brand as product_group,
       split_part(p_name, ' ', 2) as site_category, split_part(p_name, ' ', 1) as parent_site_category,
       case when p_size % 10 = 0 then 1 else 0 end as is_accessory,
       case when p_partkey % 2 = 0 then 1 else 0 end as is_logomaker_enabled,
       case when p_partkey % 13 = 0 then null else p_retailprice end as unit_price, 1 + p_size % 7 as moq,
       concat('#', lpad(hex((p_partkey * 2654435 + 1) % 16777216), 6, '0')) as color_hex
from part
"""

VIEWS["product_mapping"] = """
select m.item, m.product_key, c.country, c.region, cast(m.version_no as int) as version_no,
       case when m.version_no = 1 then timestamp '1995-01-01 00:00:00' else timestamp '1998-07-01 00:00:00' end as valid_from,
       case when m.version_no = 1 then timestamp '1998-07-01 00:00:00' else timestamp '9999-01-01 00:00:00' end as valid_to
from (select item, product_key, nation_no, {series:1:2} as version_no
      from (select item, product_key, {series:0:24} as nation_no from product) n) m
join country_region c on c.nation_key = m.nation_no
where (m.item + m.version_no) % 3 <> 0
"""

VIEWS["base_item"] = """
select m.country, m.region, m.item, m.product_key, p.product_version, p.category, p.subcategory, p.product_group,
       p.site_category, p.parent_site_category, p.is_accessory, p.is_logomaker_enabled, p.unit_price, p.moq
from product_mapping m join product p on m.item = p.item
where m.version_no = 2
"""

VIEWS["order_line"] = """
select distinct c.region, c.country, c.utc_offset, o.o_orderkey as order_number, l.l_linenumber as line_no, p.item, p.product_key,
       p.product_group, l.l_quantity as quantity, l.l_extendedprice as total, o.o_orderdate as created_at,
       o.o_custkey as customer_id
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
join customer cu on o.o_custkey = cu.c_custkey
join country_region c on c.country = concat('C', cast(cu.c_nationkey as string))
join product p on p.item = l.l_partkey
"""

# The rows of order_line that decide who bought what, repeated as they stand: for results that are distinct themselves.
VIEWS["order_line_rows"] = """
select c.region, o.o_custkey as customer_id, p.product_key
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
join customer cu on o.o_custkey = cu.c_custkey
join country_region c on c.country = concat('C', cast(cu.c_nationkey as string))
join product p on p.item = l.l_partkey
"""

VIEWS["basket_line"] = """
select distinct upper(c.region) as locale, o.o_orderkey as basket, l.l_partkey as item, o.o_orderdate as created_at
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
join customer cu on o.o_custkey = cu.c_custkey
join country_region c on c.country = concat('C', cast(cu.c_nationkey as string))
"""

VIEWS["catalog_item"] = """
select upper(r.region) as locale, p.item, p.product_key, p.category, p.subcategory, p.product_group, p.site_category,
       p.is_accessory, p.is_logomaker_enabled
from (select item, product_key, category, subcategory, product_group, site_category, is_accessory, is_logomaker_enabled,
             {series:0:4} as region_no from product) p
join (select r_regionkey, lower(r_name) as region from region) r on r.r_regionkey = p.region_no
where (p.item + length(r.region)) % 7 <> 0
"""

VIEWS["item_event"] = """
select e.event_id, case when e.event_id % 5 = 0 then null else cast(e.user_id as string) end as user_id,
       concat('a', cast(e.user_id as string)) as anonymous_id,
       case e.event_type when 'view' then 'productView' when 'click' then 'click' when 'purchase' then 'purchase'
                         when 'signup' then 'addToCart' else 'addToFavorites' end as event_type,
       cast(regexp_extract(e.props, '([0-9]+)', 1) as int) as item, e.ts, e.value,
       concat(cast(e.user_id as string), '-', cast(cast(date_trunc('week', e.ts) as date) as string)) as visit,
       case e.event_id % 4 when 0 then 'Product Page' when 1 then 'Gallery' when 2 then 'Studio'
                           else 'Configure - Recommendation' end as page_section,
       c.country, c.region, cu.c_mktsegment as industry, cu.c_custkey as customer_id,
       cast(1 + cu.c_custkey % 10 as int) as confidence_rank
from events e join customer cu on e.user_id = cu.c_custkey
join country_region c on c.country = concat('C', cast(cu.c_nationkey as string))
"""

VIEWS["user_identifier"] = """
select distinct 'anonymous_id' as type, concat('a', cast(user_id as string)) as value, concat('s', cast(user_id as string)) as canonical_id
from events where user_id % 4 <> 0
union all
select distinct 'user_id' as type, cast(user_id as string) as value, concat('s', cast(user_id as string)) as canonical_id
from events where user_id % 4 <> 0
"""

VIEWS["customer_profile"] = """
select c_custkey as customer_id, cast(c_custkey as string) as user_id, c.country, c.region,
       case c_custkey % 9 when 0 then null when 1 then 'opted out' else 'opted in' end as opt_status,
       case when c_custkey % 17 = 0 then 1 else 0 end as is_employee,
       case when c_custkey % 19 = 0 then 1 else 0 end as is_anonymous_user,
       case when c_custkey % 23 = 0 then 0 else 1 end as functional_consent,
       case when c_custkey % 3 = 0 then null else cast(c_custkey % 2 as int) end as is_digital_purchaser,
       date '2000-01-01' + cast(c_custkey % 500 as int) as registration_date,
       case when c_custkey % 5 = 0 then null else date '2000-01-01' + cast(c_custkey % 300 as int) end as last_page_view_date,
       c_mktsegment as industry, cast(1 + c_custkey % 10 as int) as confidence_rank,
       case c_custkey % 4 when 0 then 'New' when 1 then 'Active' when 2 then null else 'Lapsed' end as lifecycle_segment,
       case c_custkey % 3 when 0 then 'Business' when 1 then 'Consumer' else null end as master_segment
from customer cu join country_region c on c.country = concat('C', cast(cu.c_nationkey as string))
"""

VIEWS["review"] = """
select distinct order_number * 10 + line_no as review_id, order_number, line_no, item, product_key, country, region, created_at,
       cast(1 + (order_number * 7 + item) % 5 as int) as rating, case when item % 11 = 0 then 0 else 1 end as published_flag
from order_line where order_number % 3 = 0
"""

VIEWS["design_session"] = """
select i.event_id, concat('u', i.visit, '-', cast(i.event_id % 2 as string)) as unique_session_id, concat('s', i.visit) as session_id,
       concat('v', i.visit) as visit_id,
       case when i.event_id % 6 = 0 then null else concat('w', i.anonymous_id, '-', cast(i.event_id % 4 as string)) end as work_id,
       concat('PRD-', cast(i.item as string)) as product_key, i.country, i.region, i.ts,
       case when i.event_id % 3 = 0 then 'Continue Button' else 'Studio review page view' end as label,
       cast(round(i.value * 1000) as bigint) as duration_ms
from item_event i
"""

# One row per site session with the JSON list of the visits it covers.
VIEWS["site_session"] = """
select event_id as site_session_id, ts as session_start,
       concat('["v', visit, '","v', cast(item as string), '-', visit, '"]') as visit_ids
from item_event where event_id % 2 = 0
"""

VIEWS["fx_rate"] = """
select country, concat('CUR', country) as currency, 'USD' as to_currency, date '2001-08-01' - cast(day_no as int) as rate_date,
       cast(50 + cast(substring(country, 2, 2) as int) + day_no as double) / 100 as rate_to_usd
from (select country, {series:0:3} as day_no from country_region) d
union all
select country, concat('CUR', country), 'EUR', date '2001-08-01', 0.25 from country_region
"""

# The second source of copy: page title and description per item and country, with gaps.
VIEWS["page_copy"] = """
select m.item, m.country, case when m.item % 9 <> 0 then concat(p.product_name, ' | ', m.country) end as page_title,
       case when (m.item + length(m.country)) % 4 <> 0 then concat('About ', p.product_name) end as page_description
from live_mapping m join product p on p.item = m.item
"""

VIEWS["config"] = """
select concat('cfg', cast(vec_id as string)) as config_id, concat('M', cast(vec_id % 4 as string)) as market,
       concat('PRD-', cast(cast(floor(vec_id / 5) as int) as string)) as product_key, concat('G', cast(label as string)) as product_group,
       cast(1 + vec_id % 3 as int) as product_version,
       cast(1 + vec_id % 6 as int) as moq, case when vec_id % 17 = 0 then 1 else 0 end as is_constrained,
       case when vec_id % 23 = 0 then 1 else 0 end as is_inactive,
       concat('#', lpad(hex((vec_id * 2654435 + 1) % 16777216), 6, '0')) as color_hex,
       concat('{"Substrate Color":"', '#', lpad(hex((vec_id * 2654435 + 1) % 16777216), 6, '0'), '","Gender":"',
              case vec_id % 3 when 0 then 'Men' when 1 then 'Women' else 'Unisex' end, '"}') as options_json,
       case vec_id % 5 when 0 then 'MEN' when 1 then 'WOMEN' when 2 then 'MEN OR WOMEN' when 3 then null else 'YOUTH' end as gender,
       case vec_id % 7 when 0 then 'JACKET' when 1 then 'SOFTSHELL' when 2 then 'SWEATER' when 3 then 'T-SHIRT'
                       when 4 then 'SHIRT' when 5 then 'CAP' else 'mystery' end as type,
       case vec_id % 6 when 0 then 'EMBROIDERY' when 1 then 'SCREEN PRINTING' when 2 then 'SINGLE COLOR'
                       when 3 then 'FULL COLOR' when 4 then null else 'DIGITAL' end as decoration_technology,
       case vec_id % 8 when 0 then 'LEFT CHEST' when 1 then 'FULL FRONT' when 2 then 'BACK' when 3 then 'CENTERED ON POCKET'
                       when 4 then 'RIGHT CHEST' when 5 then 'FRONT AND BACK' when 6 then null else 'roof' end as decoration_location,
       case vec_id % 4 when 0 then 'LONG SLEEVE' when 1 then 'HALF SLEEVE' when 2 then '3/4 SLEEVE' else null end as sleeve_style,
       case vec_id % 3 when 0 then 'ADJUSTABLE' when 1 then 'FITTED' else 'ONE SIZE' end as fit_type,
       embedding
from embeddings
"""

# --- versioned status and key mapping -------------------------------------------------------

VIEWS["status_event"] = """
select item, product_key, cast(version_no as int) as product_version, cast(seq_no as int) as seq_no,
       case when (item + version_no * 3 + seq_no) % 5 = 0 then 'INACTIVE' else 'ACTIVE' end as status,
       (item + version_no) % 4 <> 0 as is_current,
       date '2000-01-01' + cast((item * 7 + version_no * 113 + seq_no * 29) % 365 as int) as event_date
from (select item, product_key, version_no, {series:1:2} as seq_no
      from (select item, product_key, {series:1:3} as version_no from product) a) b
"""

VIEWS["live_mapping"] = """
select n.item, n.product_key, c.country
from (select item, product_key, {series:0:24} as nation_no from product where item % 7 <> 0) n
join country_region c on c.nation_key = n.nation_no
where (n.item + n.nation_no) % 2 = 0
"""

VIEWS["key_history"] = """
select item, product_key, country, cast(version_no as int) as version_no, valid_from,
       date '2000-01-01' + cast((item + version_no) % 30 as int) as created_on
from product_mapping
"""

# --- JSON payloads --------------------------------------------------------------------------

VIEWS["availability_payload"] = """
select c.country, concat('["', p.product_key, '","PRD-', cast(p.item + 1 as string), '"]') as product_keys
from (select item, product_key, {series:0:24} as nation_no from product where item % 2 = 0) p
join country_region c on c.nation_key = p.nation_no
where (p.item + p.nation_no) % 5 <> 0
"""

VIEWS["logo_payload"] = """
select lower(c.country) as country, concat('[', cast(p.item as string), ',', cast(p.item + 2 as string), ']') as items
from (select item, {series:0:24} as nation_no from product where item % 4 = 0) p
join country_region c on c.nation_key = p.nation_no
where (p.item + p.nation_no) % 3 <> 0
"""

VIEWS["accessory_payload"] = """
select product_key, case when is_accessory = 1 then concat('[{"parent":"', product_key, '"}]') else '[]' end as body
from product
"""

VIEWS["constraint_payload"] = """
select item, product_key, concat('[',
  '{"productId":"', product_key, '","productVersion":', cast(product_version as string), ',"type":"block","context":[{"key":"Merchant","value":"acme"},{"key":"Country","value":"C', cast(item % 25 as string), '"}],"attributeConstraint":',
  case when item % 3 = 0 then 'null' else concat('[{"attributeKey":"Size","values":[{"stringLiteral":"XL"}]},{"attributeKey":"Substrate Color","values":[{"stringLiteral":"', color_hex, '"}]}]') end, '},',
  '{"productId":"', product_key, '","productVersion":', cast(product_version as string), ',"type":"warn","context":[{"key":"Country","value":"C', cast(item % 25 as string), '"},{"key":"Merchant","value":"', case when item % 10 = 0 then 'other' else 'Acme' end, '"}],"attributeConstraint":[{"attributeKey":"Substrate Color","values":[{"stringLiteral":"#00FF00"}]}]},',
  '{"productId":"', product_key, '","productVersion":', cast(product_version as string), ',"type":"late","context":[{"key":"Merchant","value":"ACME"},{"key":"Country","value":"C', cast((item + item % 2) % 25 as string), '"}],"attributeConstraint":',
  case when item % 5 = 0 then 'null' else '[]' end, '}]') as body
from product
"""

VIEWS["hierarchy_payload"] = """
select c.country, concat('[{"id":"', p.site_category, '","parentId":"', upper(substring(p.site_category, 1, 2)), '-', c.region, '","type":"category"},{"id":"', cast(p.item as string),
       '","parentId":"', case when p.item % 9 = 0 then 'orphan' else p.site_category end, '","type":"product"}]') as body
from (select item, site_category, {series:0:24} as nation_no from product) p
join country_region c on c.nation_key = p.nation_no
"""

VIEWS["offer_payload"] = """
select product_key, country, seq_no,
       concat('{"selectedAttributes":{"Size":"S"},"quantitiesSummary":', case when item % 6 = 0 then 'null' else concat('{"moq":', cast(moq as string), '}') end, '}') as offer,
       case when item % 13 = 0 then '{"error":"none"}'
            else concat('{"fractionDigits":2,"currency":"CUR', country, '","prices":[{"itemTotals":{"total":{"listUntaxed":', cast(cast(round(unit_price * 100) as bigint) * moq as string),
                 '},"unit":{"listUntaxed":', cast(cast(round(unit_price * 100) as bigint) as string), '}}}]}') end as price
from (select p.item, p.product_key, p.moq, p.unit_price, c.country, cast(p.seq_no as int) as seq_no
      from (select item, product_key, moq, unit_price, nation_no, {series:1:2} as seq_no
            from (select item, product_key, moq, unit_price, {series:0:24} as nation_no from product) a) p
      join country_region c on c.nation_key = p.nation_no
      where c.country = c.primary_country and (p.seq_no = 1 or p.item % 4 = 0)) x
"""

VIEWS["description_payload"] = """
select product_key, product_version, item,
       concat('{"data":{"locales":{', case when item % 4 = 0 then '' else concat('"en-gb":{"headline":"H ', product_name, '","description":"D gb","highlights":"L1"},') end,
              case when item % 3 = 0 then concat('"en-us":{"headline":"US ', product_name, '","description":"D us","highlights":"L2"},') else '' end,
              '"de-de":{"headline":"no","description":"no","highlights":"no"}}}}') as body
from product
"""

VIEWS["launch_flag"] = """
select product_key, concat('C', cast(nation_no as string)) as country,
       date '1994-06-01' + cast((item * 31 + nation_no * 17) % 2500 as int) as launch_date
from (select item, product_key, {series:0:24} as nation_no from product where item % 5 <> 0) p
where (item + nation_no) % 2 = 0
"""

# --- configurable goods ---------------------------------------------------------------------

VIEWS["sku_attribute"] = """
select item as sku, product_version as sku_version, product_key,
       case attr_no when 0 then 'FIT' when 1 then 'FIT_FEATURES' when 2 then 'POCKETS' when 3 then 'POCKET'
                    when 4 then 'DECORATION_LOCATION' when 5 then 'DECO_AREA_NAME' when 6 then 'SLEEVES' when 7 then 'PANELS'
                    when 8 then 'MSW_DECORATION_TECHNOLOGY' when 9 then 'DECO_1_PROCESS_TYPE' when 10 then 'FEATURES' when 11 then 'SPECIAL_FEATURES'
                    when 12 then 'QUALITY_ATTRIBUTES' when 13 then 'WAIST_TYPE' when 14 then 'BACK_POCKET_S' when 15 then 'CUFF_TYPE' when 16 then 'CLOSURE'
                    when 17 then 'FIT_TYPE' when 18 then 'GENDER' else 'MATERIAL' end as property_name,
       case attr_no when 0 then 'slim' when 1 then 'regular,comfort' when 2 then 'two(2)' when 3 then 'one'
                    when 4 then 'LEFT CHEST' when 5 then 'BACK' when 6 then 'LONG SLEEVE' when 8 then 'EMBROIDERY' when 9 then 'PRINT'
                    when 10 then case when item % 2 = 0 then 'None' else 'hood' end when 11 then 'reflective' else cast(1 + item % 4 as string) end as property_value
from (select item, product_version, product_key, {series:0:19} as attr_no from product) p
where (item + attr_no) % 3 <> 0
"""

VIEWS["price_enumeration"] = """
select item as sku, product_key, product_version, cast(rev as int) as rev,
       concat('{"userSelections":{"Substrate Color":"', case when item % 12 = 0 then 'red' else color_hex end, '","Size":"', case rev when 2 then 'L' else 'M' end, '"', case when item % 4 = 0 then ',"Gender":"Men"' else '' end,
              case when item % 5 = 0 then ',"Deco Area":"Sleeve"' else '' end, case when item % 7 = 0 then ',"Deco Tech":"LASER"' else '' end, case when item % 3 = 0 then ',"Backside":"printed"' else '' end, '},"quantities":[', cast(moq as string), ',', cast(moq + 5 as string),
              '],"updatedAt":"2001-01-0', cast(rev as string), 'T00:00:00","listPrices":[',
              '{"market":"C', cast(item % 25 as string), '","currency":"CURC', cast(item % 25 as string), '","merchantId":"acme","prices":{"', cast(1 + item % 9 as string), '":{"unitListPrice":{"untaxed":', cast(round(coalesce(unit_price, 10.0), 0) + rev as string), '}},"', cast(10 + item % 9 as string), '":{"unitListPrice":{"untaxed":1.5}}}},',
              '{"market":"C', cast((item + 1) % 25 as string), '","currency":"CURC', cast((item + 1) % 25 as string), '","merchantId":"other","prices":{"1":{"unitListPrice":{"untaxed":9.0}}}}]}') as body
from (select item, product_key, product_version, moq, color_hex, unit_price, {series:1:3} as rev from product) p
"""

VIEWS["raw_config"] = """
select product_key, product_version, item, concat('M', cast(market_no as string)) as market, product_name, product_group,
       concat(product_name, case item % 6 when 0 then ' MEN' when 1 then ' WOMENS' when 2 then ' UNISEX' when 3 then ' (MEN' else ' KIDS' end) as full_name,
       case item % 8 when 0 then null when 1 then 'MALE' when 2 then 'Kids' when 3 then null when 4 then 'WOMENS' else 'UNISEX' end as gender,
       case item % 5 when 0 then 'BASEBALL CAPS' when 1 then 'JACKET,FLEECE' when 2 then 'POLO SHIRT' when 3 then 'TRUCKER CAPS' else 'none' end as type,
       case item % 4 when 0 then null when 1 then 'NOT APPLICABLE' else cast(1 + item % 7 as string) end as panels,
       case item % 3 when 0 then null else cast(item % 3 as string) end as back_pockets,
       case item % 4 when 0 then 'FULLCOLORTRANSFER' when 1 then 'Direct-to-Garment' when 2 then 'EMBROIDERYFLAT' else 'SCREEN PRINTING' end as decoration_technology,
       case item % 3 when 0 then 'LC' when 1 then 'FRONT,CENTERED' else null end as decoration_location,
       case item % 4 when 0 then 'blank' else 'printed' end as backside,
       case item % 6 when 0 then 'C' when 1 then 'premium' else 'NONE' end as quality,
       case item % 5 when 0 then 'Polo Collar' when 1 then 'V-Neck' when 2 then 'crew neck ' else null end as collar_type,
       case item % 4 when 0 then 'two(2),side' when 1 then 'None' else null end as pockets,
       case item % 3 when 0 then 'LONG SLEEVE' when 1 then 'none' else null end as sleeve_style,
       case item % 2 when 0 then 'cotton' else null end as material,
       color_hex, concat(color_hex, '/#0000FF') as exact_color, coalesce(unit_price, 900.0) as unit_price, moq,
       concat('{"Substrate Color":"', lower(color_hex), '","Size":"M","Gender":"Men"}') as selections_json
from (select product_key, product_version, item, product_name, product_group, color_hex, unit_price, moq, {series:0:1} as market_no from product) p
"""


def expand(sql: str, dialect: str) -> str:
    form = "explode(sequence({0}, {1}))" if dialect == "spark" else "unnest(range({0}, {1} + 1))"
    return re.sub(r"\{series:(\d+):(\d+)\}", lambda m: form.format(m.group(1), m.group(2)), sql)


def dependencies(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [name for name in VIEWS if name in words]


def ordered_views(sql: str) -> list[str]:
    """Views the text needs, inner ones first."""
    seen: list[str] = []

    def visit(text: str, path: tuple[str, ...]) -> None:
        for name in dependencies(text):
            if name in path or name in seen:
                continue
            visit(VIEWS[name], path + (name,))
            seen.append(name)

    visit(sql, ())
    return seen


def duck_sql(sql: str) -> str:
    """Self-contained DuckDB statement: the fixture views it needs as CTEs, then the query."""
    ctes = [f"{name} as ({expand(VIEWS[name], 'duckdb').strip()})" for name in ordered_views(sql)]
    body = sql.strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body


class Fixtures:
    """Fixture views of one data folder as Spark DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        broadcast_by_measured_size(spark)
        free_shuffles_early(spark)
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name == "stages":
            raise AttributeError(name)
        return self.view(name)

    def view(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in TABLES:
                frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
                if name == "part":
                    frame = self._dealt(frame, "p_partkey")
            else:
                frame = self.sql(expand(VIEWS[name], "spark"))
            if name in FIXED_SIZE:
                frame = F.broadcast(frame)
            self._frames[name] = frame
        return self._frames[name]

    def _dealt(self, frame: DataFrame, key: str) -> DataFrame:
        """Rows of a table that packs millions into few MB, and so into few scan tasks, dealt to all tasks: views make up to 25 rows of each."""
        return frame.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), key)

    def sql(self, text: str) -> DataFrame:
        """Run a statement whose sources may be tables and views of this folder; no view is registered in the session."""
        text = text.replace("{", "{{").replace("}", "}}")
        used: dict[str, DataFrame] = {}
        for name in TABLES + list(VIEWS):
            # a column may share a table's name: only real sources count
            text, n = re.subn(rf"\b(from|join)(\s+){name}\b", rf"\1\2{{{name}}}", text)
            if n:
                used[name] = self.view(name)
        return self.spark.sql(text, **used)
