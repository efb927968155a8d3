"""Queries: frequently-bought-together family."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinora.catalog.common import ITEM_MIN_COUNT, SINCE_BUNDLES, stage, tidy
from affinora.fixtures import ORDERS_AS_OF
from affinora.plans import bundles as B

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

EVENTS_SINCE = "2023-10-31"


def _items(fx):
    return fx.catalog_item


def _accessories(fx):
    return _items(fx).filter("is_accessory = 1")


def _universe(fx):
    return _items(fx).filter("is_accessory = 0").select("locale", "item", "product_group")


def _views(fx):
    return fx.item_event.withColumn("locale", F.upper("region"))


def _rules(fx):
    staged = fx.__dict__.get("stages", {}).get("rules")
    return staged if staged is not None else B.co_purchase_rules(fx.basket_line, SINCE_BUNDLES, min_count=ITEM_MIN_COUNT)


def _view_rules(fx):
    return B.co_view_rules(_views(fx), EVENTS_SINCE)


def _step1(fx):
    """The targets' categories and the accessories join on one key: one shuffle."""
    ranked = B.rank_rules(B.with_target_category(_rules(fx), _items(fx)), _accessories(fx))
    return B.min_list_length(B.exclude_same_category(ranked, _items(fx)))


def _step2(fx):
    return B.fallback_fill(stage(fx, "step1", _step1, True), _view_rules(fx), _universe(fx), _accessories(fx))


def _step3(fx):
    return B.donor_fill(stage(fx, "step1", _step1, True), stage(fx, "step2", _step2, True), _universe(fx))


def _filled(fx):
    """The lists with what the later steps read of them; the rules' measures stay behind."""
    lists = stage(fx, "step2", _step2, True).select(*B.KEYS, "target", "rank", "target_count", "origin")
    return B.with_target_category(lists, _items(fx))


def _final(fx, filled=None):
    """Lists get the category of their targets before many articles borrow them."""
    rows = B.donor_fill(stage(fx, "step1", _step1, True), _filled(fx) if filled is None else filled, _universe(fx))
    return B.min_list_length(B.exclude_same_category(rows, _items(fx)))


def _country_lists(fx):
    """The countries of the targets come along with their categories."""
    filled = B.with_target_countries(_filled(fx), _countries(fx), _base(fx))
    return B.region_lists(_final(fx, filled), _countries(fx), _base(fx))


def _countries(fx):
    return fx.country_region.select(F.upper("region").alias("locale"), "country")


def _base(fx):
    return fx.base_item


def _served(fx):
    """Model output as comma lists: the step-1 lists, with every third source on the locale's default list."""
    rows = stage(fx, "step1", _step1, True)
    texts = rows.groupBy("locale", "source").agg(B.lists.ordered_text("rank", "target", ", ").alias("own"))
    return texts.select(
        "locale", F.col("source").cast("string").alias("source"),
        F.when(F.col("source") % 3 == 0, F.lit("1, 2, 3")).otherwise(F.col("own")).alias("items"),
    )


def _allowed(fx):
    return _items(fx).filter("item % 10 <> 0").select("locale", "item")


def _subset(fx):
    """The rules serve the lists and their replacements: mined once."""
    stage(fx, "rules", _rules, True)
    return B.subset_and_backfill(stage(fx, "flagged", lambda f: B.default_list_flag(_served(f))), _allowed(fx), _rules(fx), _accessories(fx))


# --- oracle snippets ------------------------------------------------------------------------

def rules_sql(rows: str, segment: str, basket: str, item: str, min_targets: int = 5, min_count: int = 2) -> str:
    return f"""
select * from (
  select cp.locale, cp.source, cp.target, ts.n as source_baskets, cp.n as pair_count, cp.avg_size as avg_basket_size,
         cp.n / ts.n as confidence, tt.supp as support,
         (1 - tt.supp) / (1 - cp.n / ts.n + 1e-10) as conviction,
         count(*) over (partition by cp.locale, cp.source) as target_count
  from (select a.locale, a.item as source, b.item as target, count(distinct a.basket) as n, avg(a.size) as avg_size
        from (select locale, basket, item, count(*) over (partition by locale, basket) as size
              from (select distinct {segment} as locale, {basket} as basket, {item} as item from {rows}) d) a
        join (select distinct {segment} as locale, {basket} as basket, {item} as item from {rows}) b
          on a.locale = b.locale and a.basket = b.basket and a.item <> b.item
        group by 1, 2, 3 having count(distinct a.basket) >= {min_count}) cp
  join (select locale, item, n, n / sum(n) over (partition by locale) as supp
        from (select {segment} as locale, {item} as item, count(distinct {basket}) as n from {rows} group by 1, 2) t) ts
    on ts.locale = cp.locale and ts.item = cp.source
  join (select locale, item, n, n / sum(n) over (partition by locale) as supp
        from (select {segment} as locale, {item} as item, count(distinct {basket}) as n from {rows} group by 1, 2) t) tt
    on tt.locale = cp.locale and tt.item = cp.target) r
where target_count >= {min_targets}"""


_RECENT = f"created_at >= timestamp '{SINCE_BUNDLES}'"
_RULES = rules_sql(f"(select * from basket_line where {_RECENT})", "locale", "basket", "item", min_count=ITEM_MIN_COUNT)
_VIEW_ROWS = "(select upper(region) as locale, visit, item from item_event where page_section = 'Product Page' and ts >= timestamp '2023-10-31')"
_VIEW = f"""
select locale, source, target, source_baskets, pair_count, cast(0 as double) as avg_basket_size, confidence, support, conviction, target_count, view_rank
from (select *, row_number() over (partition by locale, source order by conviction desc, confidence desc, support desc, target) as view_rank
      from ({rules_sql(_VIEW_ROWS, 'locale', 'visit', 'item')}) v) w
where view_rank <= 50"""

_RANKED = """
select * from (
  select r.*, row_number() over (partition by r.locale, source order by conviction desc, confidence desc, support desc, avg_basket_size, target) as rank
  from rules r where not exists (select 1 from catalog_item a where a.is_accessory = 1 and a.locale = r.locale and a.item = r.target)) x
where rank <= 40"""

_EXCLUDE = """
select {cols}, row_number() over (partition by r.locale, source order by rank, target) as rank
from {rows} r
left join catalog_item a on a.locale = r.locale and a.item = r.source
left join catalog_item b on b.locale = r.locale and b.item = r.target
where a.site_category is null or b.site_category is null or a.site_category <> b.site_category"""

_RULE_COLS = "r.locale, source, target, source_baskets, pair_count, confidence, support, conviction, target_count"

CASCADE = f"""
with rules as ({_RULES}),
ranked as ({_RANKED}),
diverse as ({_EXCLUDE.format(cols=_RULE_COLS, rows='ranked')}),
step1 as (select * exclude (longest) from (select *, max(rank) over (partition by locale, source) as longest from diverse) d where longest >= 5),
views as ({_VIEW}),
universe as (select locale, item, product_group from catalog_item where is_accessory = 0),
fill as (select * from (
    select v.locale, v.source, v.target, v.source_baskets, v.pair_count, v.confidence, v.support, v.conviction, v.target_count,
           row_number() over (partition by v.locale, v.source order by conviction desc, confidence desc, support desc, v.target) as rank
    from views v
    where (v.locale, v.source) in (select locale, item from universe)
      and (v.locale, v.source) not in (select locale, source from step1)
      and not exists (select 1 from catalog_item a where a.is_accessory = 1 and a.locale = v.locale and a.item = v.target)) f
  where rank <= 40),
step2 as (select *, 'purchase' as origin from step1 union all select *, 'view' as origin from (
    select locale, source, target, source_baskets, pair_count, confidence, support, conviction, target_count, rank from fill) g),
missing as (select u.* from universe u where (u.locale, u.item) not in (select locale, source from step2)),
donor1 as (select locale, product_group, source from (
    select s.locale, u.product_group, s.source, row_number() over (partition by s.locale, u.product_group order by s.c desc, s.source) as n
    from (select locale, source, max(target_count) as c from step1 group by 1, 2) s join universe u on u.locale = s.locale and u.item = s.source) d where n = 1),
donor2 as (select locale, product_group, source from (
    select s.locale, u.product_group, s.source, row_number() over (partition by s.locale, u.product_group order by s.c desc, s.source) as n
    from (select locale, source, max(target_count) as c from step2 group by 1, 2) s join universe u on u.locale = s.locale and u.item = s.source) d where n = 1),
step3 as (
  select locale, source, target, source_baskets, pair_count, confidence, support, conviction, target_count, rank, origin from step2
  union all
  select m.locale, m.item as source, s.target, s.source_baskets, s.pair_count, s.confidence, s.support, s.conviction, s.target_count, s.rank, 'donor' as origin
  from missing m
  left join donor1 d1 on d1.locale = m.locale and d1.product_group = m.product_group
  left join donor2 d2 on d2.locale = m.locale and d2.product_group = m.product_group
  join step2 s on s.locale = m.locale and s.source = coalesce(d1.source, d2.source)),
diverse3 as ({_EXCLUDE.format(cols='r.locale, source, target', rows='step3')}),
final as (select * exclude (longest) from (select *, max(rank) over (partition by locale, source) as longest from diverse3) d where longest >= 5),
listed as (select distinct c.country, f.source, f.target, f.rank from final f
  join country_region c on upper(c.region) = f.locale
  where (c.country, f.target) in (select country, item from base_item))
"""

_MEASURES = """locale, source, target, source_baskets, pair_count, round(confidence, 6) as confidence, round(support, 6) as support,
 round(conviction, 6) as conviction, target_count"""


def _add(name, fn, sql):
    QUERIES[name] = fn
    ORACLE[name] = sql


_add("fbt_rules", lambda fx: tidy(_rules(fx)),
     f"select {_MEASURES}, round(avg_basket_size, 6) as avg_basket_size from ({_RULES}) r")
def _mapped_lines(fx):
    """Recent order lines with the article that their product key meant in their country at as_of."""
    lines = fx.order_line.drop("item").withColumn("locale", F.lit("ALL"))
    return B.map_items(lines, fx.product_mapping, ORDERS_AS_OF)


_VALID = f"valid_from <= timestamp '{ORDERS_AS_OF}' and valid_to > timestamp '{ORDERS_AS_OF}'"
_add("fbt_rules_item", lambda fx: tidy(B.co_purchase_rules(_mapped_lines(fx), SINCE_BUNDLES, basket="order_number", min_count=ITEM_MIN_COUNT)),
     f"select {_MEASURES}, round(avg_basket_size, 6) as avg_basket_size from ("
     + rules_sql(f"(select 'ALL' as locale, o.order_number, m.item from order_line o join product_mapping m on m.product_key = o.product_key and m.country = o.country where o.{_RECENT} and {_VALID})",
                 "locale", "order_number", "item", min_count=ITEM_MIN_COUNT) + ") r")
_add("fbt_rules_group", lambda fx: tidy(B.co_purchase_rules(
        fx.order_line.withColumn("locale", F.upper("region")), SINCE_BUNDLES, basket="order_number", item="product_group")),
     f"select {_MEASURES}, round(avg_basket_size, 6) as avg_basket_size from ("
     + rules_sql(f"(select upper(region) as locale, order_number, product_group from order_line where {_RECENT})", "locale", "order_number", "product_group") + ") r")
_add("fbt_co_view_rules", lambda fx: tidy(_view_rules(fx)),
     f"select {_MEASURES}, avg_basket_size, view_rank from ({_VIEW}) r")
_add("fbt_ranked", lambda fx: tidy(B.rank_rules(_rules(fx), _accessories(fx)).select("locale", "source", "target", "rank")),
     f"with rules as ({_RULES}) select locale, source, target, rank from ({_RANKED}) r")
_add("fbt_flagship", lambda fx: tidy(B.min_list_length(B.rank_rules(_rules(fx), _accessories(fx)))),
     f"""with rules as ({_RULES}) select {_MEASURES}, round(avg_basket_size, 6) as avg_basket_size, rank
 from (select *, max(rank) over (partition by locale, source) as longest from ({_RANKED}) k) r where longest >= 5""")
_add("fbt_exclude_same_category", lambda fx: tidy(_step1(fx).select("locale", "source", "target", "rank", "conviction")),
     CASCADE + "select locale, source, target, rank, round(conviction, 6) as conviction from step1")
_add("fbt_fallback", lambda fx: tidy(_step2(fx)),
     CASCADE + f"select {_MEASURES}, rank, origin from step2")
_add("fbt_donor", lambda fx: tidy(_step3(fx)),
     CASCADE + f"select {_MEASURES}, rank, origin from step3")
_add("fbt_final_lists", lambda fx: tidy(_final(fx).select("locale", "source", "target", "rank")),
     CASCADE + "select locale, source, target, rank from final")
_add("fbt_country_text", lambda fx: tidy(B.country_list_text(_country_lists(fx))),
     CASCADE + """select country, source, string_agg(cast(target as string), ',' order by rank, target) as items
from listed group by 1, 2 having count(target) >= 5""")
_add("fbt_country_rows", lambda fx: tidy(B.country_list_rows(_country_lists(fx))),
     CASCADE + """select country, source, target, row_number() over (partition by country, source order by rank, target) as rank
from (select *, count(*) over (partition by country, source) as n from listed) l where n >= 5""")
_add("fbt_coverage", lambda fx: tidy(B.coverage(_final(fx))),
     CASCADE + "select locale, count(distinct source) as sources from final group by 1")
_add("fbt_uncovered", lambda fx: tidy(B.uncovered_count(_universe(fx), _step3(fx), ["Brand#1", "Brand#2"])),
     CASCADE + """select locale, count(distinct item) as uncovered from universe u
where (locale, item) not in (select locale, source from step3) and product_group not in ('Brand#1', 'Brand#2') group by 1""")
_add("fbt_head_guard", lambda fx: tidy(B.head_guard(_step3(fx), "ASIA")),
     CASCADE + """select source, min(pair_count) as min_pair_count, max(source_baskets) as source_baskets from step3
where locale = 'ASIA' and rank between 1 and 10 and source in (
  select source from step3 where locale = 'ASIA' group by 1 order by max(source_baskets) desc, source limit 25) group by 1""")

_SERVED = CASCADE + """,
served as (select locale, cast(source as string) as source,
                  case when source % 3 = 0 then '1, 2, 3' else string_agg(cast(target as string), ', ' order by rank) end as items
           from step1 group by locale, source, source % 3),
modal as (select locale, items as modal from (
    select locale, items, row_number() over (partition by locale order by count(*) desc, items) as n from served group by 1, 2) m where n = 1),
flagged0 as (select s.locale, s.source, case when contains(s.items, m.modal) then 1 else 0 end as is_default, string_split(s.items, ',') as parts
           from served s join modal m on m.locale = s.locale),
flagged as (select locale, source, is_default, trim(parts[i]) as target, i as rank
           from (select *, unnest(range(1, len(parts) + 1)) as i from flagged0) f),
allowed as (select locale, cast(item as string) as item from catalog_item where item % 10 <> 0),
subset0 as (select f.locale, f.source, f.target, row_number() over (partition by f.locale, f.source order by f.rank, f.target) as rank
           from flagged f where is_default = 0 and (f.locale, f.target) in (select locale, item from allowed)),
subset as (select *, case when max(rank) over (partition by locale, source) < 3 then 1 else 0 end as is_default from subset0 where rank <= 20),
manual0 as (select r.*, count(*) over (partition by r.locale, r.source) as n from rules r
           where (r.locale, cast(r.target as string)) in (select locale, item from allowed)),
manual1 as (select locale, source, target, row_number() over (partition by r.locale, source
                  order by conviction desc, confidence desc, support desc, avg_basket_size, cast(target as string)) as rank
           from manual0 r where n >= 3
             and not exists (select 1 from catalog_item a where a.is_accessory = 1 and a.locale = r.locale and a.item = r.target)),
manual as (select locale, cast(source as string) as source, cast(target as string) as target, rank, 0 as is_default
           from (select *, max(rank) over (partition by locale, source) as longest from manual1 where rank <= 20) m where longest >= 3),
both_lists as (select locale, source, target, rank, is_default from flagged where is_default = 1
           union all select locale, source, target, rank, is_default from subset),
swapped as (select distinct locale, source from manual where (locale, source) in (select locale, source from both_lists where is_default = 1)),
result as (select * from both_lists where (locale, source) not in (select locale, source from swapped)
           union all select * from manual where (locale, source) in (select locale, source from swapped))
"""
_add("fbt_default_flag", lambda fx: tidy(B.default_list_flag(_served(fx))),
     _SERVED + "select locale, source, target, rank, is_default from flagged")
_add("fbt_subset_backfill", lambda fx: tidy(_subset(fx)),
     _SERVED + "select distinct locale, source, target, rank, is_default from result")


def _bundles(fx):
    valid = B.valid_at(fx.product_mapping, ORDERS_AS_OF).select(F.upper("region").alias("locale"), F.col("item").cast("string").alias("item"), "product_key")
    rows = B.bundle_arrays(_subset(fx), valid.distinct())
    return rows.select("locale", "source_key", F.array_join("bundle", ",").alias("bundle"))


_add("fbt_bundle_arrays", lambda fx: tidy(_bundles(fx)),
     _SERVED + f", valid_key as (select distinct upper(region) as locale, item, product_key from product_mapping where {_VALID})" + """
select r.locale, a.product_key as source_key, string_agg(b.product_key, ',' order by r.rank, b.product_key) as bundle
from (select distinct * from result) r
join valid_key a on a.locale = r.locale and cast(a.item as string) = r.source
join valid_key b on b.locale = r.locale and cast(b.item as string) = r.target
where r.is_default = 0 group by 1, 2""")
