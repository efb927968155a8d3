"""Queries: industry popularity family."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinora.catalog.common import stage, tidy
from affinora.operators import merge
from affinora.plans import industry as I

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
SINCE = "2023-11-01"
KINDS = {"view": ("productView", "Product Page"), "cart": ("addToCart", None)}


def _base(fx, kind):
    event, section = KINDS[kind]
    return I.confident_events(fx.item_event, SINCE, event, section)


def _keys(fx):
    return fx.base_item.select(F.upper("region").alias("locale"), "item", "product_key").distinct()


def _orders(fx):
    lines = fx.order_line_rows.select(F.upper("region").alias("locale"), "customer_id", "product_key")
    users = fx.customer_profile.filter("confidence_rank <= 8").select("customer_id", "user_id", "industry")
    return I.order_events(lines.join(users, "customer_id"), fx.product.select("product_key", "item"))


def _index(fx, kind):
    if kind == "order":
        base = stage(fx, "orders", _orders)
        return I.over_index(I.uptake_region_industry_product(base), I.uptake_region_product(base))
    base = _base(fx, kind)
    return I.over_index(I.uptake_region_industry_product(base), I.uptake_region_product(base), _keys(fx))


def _items(fx):
    names = fx.catalog_item.select("locale", "item", "category", "product_group")
    label = F.when(F.col("item") % 20 == 0, F.col("item").cast("string")).when(
        F.col("item") % 20 == 1, F.concat(F.lit("PRD-"), "item")).otherwise(F.concat(F.lit("article"), "item"))
    return names.withColumn("item_name", label)


def _top(fx):
    base = fx.base_item.select(F.upper("region").alias("locale"), "item")
    return I.top_industry_items(_index(fx, "view"), _index(fx, "cart"), _index(fx, "order"), _items(fx), base, "ECONOMY")


def _lists(fx):
    countries = fx.country_region.select(F.upper("region").alias("locale"), "country")
    return I.industry_lists(_top(fx), countries)


def _show(df):
    cols = [F.col(c) / 100 if c == "percent_hundredths" else F.col(c) for c in df.columns]
    return tidy(df.select(*[c.alias(n.replace("_hundredths", "")) for c, n in zip(cols, df.columns)]))


def _show_index(df):
    return tidy(df.select("locale", "industry", "item", "region_users", "region_item_users", "industry_users",
                          "industry_item_users", (F.col("industry_percent") / 100).alias("industry_percent"),
                          (F.col("region_percent") / 100).alias("region_percent"),
                          (F.col("index_hundredths") / 100).alias("over_index")))


def base_sql(kind):
    if kind == "order":
        return """(select upper(o.region) as locale, cp.industry, cp.user_id, p.item from order_line o
 join customer_profile cp on cp.customer_id = o.customer_id and cp.confidence_rank <= 8
 join product p on p.product_key = o.product_key)"""
    event, section = KINDS[kind]
    extra = f" and page_section = '{section}'" if section else ""
    return f"""(select upper(region) as locale, industry, user_id, item from item_event
 where event_type = '{event}' and user_id is not null and ts >= timestamp '{SINCE}' and confidence_rank <= 8{extra})"""


def uptake_sql(kind, keys):
    k = ", ".join(keys)
    on = " and ".join(f"p.{c} = w.{c}" for c in keys)
    pk = ", ".join(f"p.{c}" for c in keys)
    return f"""select {pk}, p.item, p.item_users, w.segment_users, (200 * p.item_users + w.segment_users) // (2 * w.segment_users) as pct
 from (select {k}, item, count(distinct user_id) as item_users from {base_sql(kind)} b group by {k}, item) p
 join (select {k}, count(distinct user_id) as segment_users from {base_sql(kind)} b group by {k}) w on {on}"""


def index_sql(kind):
    keyed = "" if kind == "order" else """
 join (select distinct upper(region) as locale, item, product_key from base_item) k1 on k1.locale = s.locale and k1.item = s.item"""
    return f"""select s.locale, s.industry, s.item, r.segment_users as region_users, r.item_users as region_item_users,
 s.segment_users as industry_users, s.item_users as industry_item_users, s.pct as ipct, r.pct as rpct,
 case when s.pct >= r.pct then (20000 * (s.pct - r.pct) + r.pct) // (2 * r.pct) else -((20000 * (r.pct - s.pct) + r.pct) // (2 * r.pct)) end as idx
 from ({uptake_sql(kind, ['locale', 'industry'])}) s join ({uptake_sql(kind, ['locale'])}) r on r.locale = s.locale and r.item = s.item{keyed}
 where r.pct <> 0"""


def _add(name, fn, sql):
    QUERIES[name] = fn
    if sql:
        ORACLE[name] = sql


for _kind in ("view", "cart", "order"):
    def _b(fx, kind=_kind):
        return stage(fx, "orders", _orders) if kind == "order" else _base(fx, kind)
    _add(f"industry_uptake_region_{_kind}", lambda fx, b=_b: _show(I.uptake_region_product(b(fx))),
         f"select locale, item, item_users, segment_users, pct / 100 as percent from ({uptake_sql(_kind, ['locale'])}) u")
    _add(f"industry_uptake_segment_{_kind}", lambda fx, b=_b: _show(I.uptake_region_industry_product(b(fx))),
         f"select locale, industry, item, item_users, segment_users, pct / 100 as percent from ({uptake_sql(_kind, ['locale', 'industry'])}) u")
    _add(f"industry_over_index_{_kind}", lambda fx, kind=_kind: _show_index(_index(fx, kind)),
         f"""select locale, industry, item, region_users, region_item_users, industry_users, industry_item_users,
 ipct / 100 as industry_percent, rpct / 100 as region_percent, idx / 100 as over_index from ({index_sql(_kind)}) i""")

_TOP = f"""with scored as (
 select o.locale, o.industry, o.item, o.industry_item_users as order_users, (2.0 * o.idx + 1.5 * c.idx + 1.0 * v.idx) / 100 as final_index
 from ({index_sql('order')}) o join ({index_sql('cart')}) c on c.locale = o.locale and c.industry = o.industry and c.item = o.item
 join ({index_sql('view')}) v on v.locale = o.locale and v.industry = o.industry and v.item = o.item),
named as (select s.*, ci.category, ci.product_group,
   case when ci.item % 20 = 0 then cast(ci.item as string) when ci.item % 20 = 1 then concat('PRD-', cast(ci.item as string)) else concat('article', cast(ci.item as string)) end as item_name
 from scored s join catalog_item ci on ci.locale = s.locale and ci.item = s.item where s.final_index >= 0),
one_each as (select *, case when category = 'ECONOMY'
    then row_number() over (partition by locale, industry, category order by final_index desc, order_users desc, item)
    else row_number() over (partition by locale, industry, product_group, category = 'ECONOMY' order by final_index desc, order_users desc, item) end as n
 from named where item_name not like 'PRD-%' and try_cast(item_name as double) is null),
ranked as (select *, row_number() over (partition by locale, industry order by final_index desc, order_users desc, item) as rank from one_each where n = 1),
top_items as (select locale, industry, item, rank, order_users, final_index from ranked
 where rank <= 20 and (locale, item) in (select upper(region), item from base_item)),
industry_list as (select t.industry, c.country, string_agg(cast(t.item as string), ',' order by t.rank) as items
 from top_items t join country_region c on upper(c.region) = t.locale group by 1, 2)
"""
_add("industry_top_items", lambda fx: tidy(_top(fx).select("locale", "industry", "item", "rank", "order_users", "final_index")),
     _TOP + "select locale, industry, item, rank, order_users, round(final_index, 6) as final_index from top_items")
_add("industry_lists", lambda fx: tidy(_lists(fx)), _TOP + "select industry, country, items from industry_list")
_add("industry_list_gates", lambda fx: tidy(I.list_gates(_lists(fx), 6, 25)),
     _TOP + """select * from (select 'industries' as gate, count(distinct industry) as value, cast(6 as bigint) as expected from industry_list
 union all select 'countries', count(distinct country), 25 from industry_list
 union all select 'short_lists', count(*), 0 from industry_list where len(string_split(items, ',')) < 5) g where value <> expected""")


def _sync(fx):
    new = I.confident_users(fx.customer_profile)
    old = I.confident_users(fx.customer_profile.withColumn("confidence_rank", F.col("confidence_rank") % 9 + 1))
    return merge.sync_changes(old, new, ["user_id"])


_add("industry_user_sync", lambda fx: tidy(_sync(fx)),
     """select user_id, industry, 'put' as op from customer_profile where confidence_rank <= 8
 union all select user_id, null as industry, 'delete' as op from customer_profile where confidence_rank % 9 + 1 <= 8 and not confidence_rank <= 8""")
