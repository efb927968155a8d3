"""Queries: training datasets, reporting, models and event windows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from affinora.catalog import item_master as IM
from affinora.catalog.common import stage, tidy
from affinora.plans import datasets as D
from affinora.plans import models as R
from affinora.plans import reporting as Q
from affinora.session import cut_packed, ensure_checkpoint_dir
from affinora.streaming import idle
from affinora.streaming import monitor as S

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
SINCE, UNTIL = "2022-10-31", "2024-01-31"
USERS_AS_OF = "2001-08-02"


def _add(name, fn, sql=None):
    QUERIES[name] = fn
    if sql:
        ORACLE[name] = sql


# --- datasets -------------------------------------------------------------------------------

def _items_dataset(fx):
    fx._frames["base_item"] = stage(fx, "base_item", lambda f: f.base_item, True)
    base = fx.base_item.join(cut_packed(IM._dates(fx)), ["item", "country"], "left")
    proxies = [cut_packed(p(fx)) for p in (IM._high_value, IM._bulk, IM._ratings, IM._complexity)]
    return D.items_dataset(base, *proxies)


_add("items_dataset", lambda fx: tidy(_items_dataset(fx)),
     f"""with {IM._DATES}, {IM.HIGH_VALUE}, {IM.BULK}, {IM.RATINGS}, {IM.COMPLEXITY},
dd as (select item, country, {IM._DATE_COLS} from dates),
items as (select b.region, b.category, b.subcategory, b.product_group, b.item, b.product_key, b.is_accessory, max(b.parent_site_category) as parent_site_category,
 max(b.site_category) as site_category, max(b.is_logomaker_enabled) as is_logomaker_enabled, max(dd.days_since_merchandisable) as days_since_merchandisable, min(dd.creation_timestamp) as timestamp
 from base_item b left join dd on dd.item = b.item and dd.country = b.country group by 1, 2, 3, 4, 5, 6, 7)
select i.region, i.category, i.subcategory, i.product_group, i.item, parent_site_category, site_category, is_accessory::bigint as is_accessory, is_logomaker_enabled::bigint as is_logomaker_enabled,
 coalesce(c.label, '5_unknown') as design_complexity, round(coalesce(c.median_minutes, cs.system_median_minutes), 6) as median_studio_duration,
 coalesce(b.label, '5_unknown') as bulk, round(coalesce(b.score, bs.system_median), 6) as median_order_quantity,
 coalesce(r.label, '5_unknown') as rating, round(coalesce(r.score, rs.system_rating_avg), 6) as calc_product_rating,
 coalesce(h.label, '5_unknown') as high_value, h.default_moq::bigint as default_moq, round(coalesce(h.price, hs.subcategory_median), 6) as min_unit_price, days_since_merchandisable, timestamp
from items i left join complexity c on c.region = i.region and c.item = i.item left join bulk b on b.region = i.region and b.item = i.item
left join ratings r on r.region = i.region and r.item = i.item left join hv h on h.region = i.region and h.item = i.item
left join (select distinct region, category, subcategory, system_median_minutes from complexity) cs on cs.region = i.region and cs.category = i.category and cs.subcategory = i.subcategory
left join (select distinct region, category, subcategory, product_group, system_median from bulk) bs on bs.region = i.region and bs.category = i.category and bs.subcategory = i.subcategory and bs.product_group = i.product_group
left join (select distinct region, category, subcategory, system_rating_avg from ratings) rs on rs.region = i.region and rs.category = i.category and rs.subcategory = i.subcategory
left join (select distinct region, category, subcategory, subcategory_median from hv) hs on hs.region = i.region and hs.category = i.category and hs.subcategory = i.subcategory""")


def _users(fx):
    return D.users_dataset(fx.order_line, fx.customer_profile, fx.country_region, USERS_AS_OF)


USERS = """recent as (select * from order_line where cast(created_at as date) > date '2000-05-02'),
main as (select customer_id, country from (select customer_id, country, row_number() over (partition by customer_id order by count(distinct order_number) desc, country) as n from recent group by 1, 2) m where n = 1),
spend as (select customer_id, count(distinct order_number) as orders, sum(cast(total as decimal(20,2))) as bookings, max(cast(created_at as date)) as last_order from recent group by 1),
chosen as (select g.region, c.*, coalesce(s.orders, 0) as orders, coalesce(s.bookings, 0) as bookings from customer_profile c
  left join main m on m.customer_id = c.customer_id left join spend s on s.customer_id = c.customer_id
  join country_region g on g.country = coalesce(m.country, c.country)
  where c.is_employee = 0 and upper(c.opt_status) = 'OPTED IN' and c.user_id is not null
   and greatest(coalesce(c.registration_date, date '1900-01-01'), coalesce(s.last_order, date '1900-01-01'), coalesce(c.last_page_view_date, date '1900-01-01')) > date '2000-05-02'),
tiled as (select * exclude (region_1), ntile(20) over (partition by region order by bookings desc, md5(user_id), user_id) as v from (select *, 1 as region_1 from chosen) z),
users as (select region, user_id, orders as total_order_count, case when v = 1 then 1 when v = 2 then 2 when v in (3, 4) then 3 when v = 5 then 4 when v in (6, 7, 8) then 5 when v in (9, 10, 11) then 6 else 7 end::bigint as booking_budget_category,
 coalesce(opt_status, 'Unknown') as current_opt_status, coalesce(cast(is_digital_purchaser as string), '0') as is_digital_purchaser, coalesce(lifecycle_segment, 'Unknown') as lifecycle_segment,
 coalesce(master_segment, 'Unknown') as master_segment, coalesce(industry, 'Unknown') as industry from tiled)"""
USERS = USERS.replace("select g.region, c.*,", "select g.region, c.customer_id, c.user_id, c.opt_status, c.is_digital_purchaser, c.lifecycle_segment, c.master_segment, c.industry,").replace(
    "select * exclude (region_1), ntile(20)", "select *, ntile(20)").replace(" from (select *, 1 as region_1 from chosen) z)", " from chosen)")
_add("users_dataset", lambda fx: tidy(_users(fx)), f"with {USERS} select * from users")

RAW = """raw_event as (select event_id, user_id, anonymous_id, ts, visit, country, region, value,
 case event_type when 'productView' then 'view' when 'addToCart' then 'cart' when 'addToFavorites' then 'wish' when 'purchase' then 'order' else case when event_id % 3 = 0 then 'search_click' else 'click' end end as kind,
 case when event_id % 37 = 0 then concat('PRD-', cast(item as string)) else cast(item as string) end as item_id,
 case when event_type in ('addToFavorites') then case event_id % 3 when 0 then 'Product Page' when 1 then 'My Account' else 'Gallery' end
      when event_type = 'click' then case event_id % 6 when 0 then 'Search Results Page' when 1 then 'Cart' when 2 then 'Home Page' when 3 then 'Search Results Page' when 4 then 'My Account' else 'Design Services' end
      else page_section end as page_section,
 case when event_id % 7 = 0 then null else concat('q', cast(cast(floor(event_id / 20) as bigint) as string)) end as page_search,
 case when event_id % 11 = 0 then '/studio?recommendationsId=1' else '/studio' end as page_url,
 case when event_id % 13 = 0 then '/xs/a' when event_id % 17 = 0 then '/search?q' when event_id % 29 = 0 then null else '/home' end as referrer,
 case when event_id % 3 = 2 then 'other' else 'recommendations' end as route,
 case when event_id % 2 = 0 then 'Matching-list' end as list_section_id, case when event_id % 5 = 1 then 'MATCHING' else 'sale' end as offer_type,
 concat('[{"product_id":"', cast(item as string), '"},{"product_id":"PRD-1"},{"product_id":"', cast(item + 1 as string), '"}]') as products
from item_event)"""


def _raw(fx):
    return fx.sql("with " + RAW + " select * from raw_event")


def _consent(fx):
    return fx.customer_profile.select("user_id", "functional_consent")


def _engaged(fx, kinds=None, exclude_search=True):
    return D.engagement(_raw(fx), fx.user_identifier, _consent(fx), SINCE, UNTIL, kinds, exclude_search)


def _shared(fx):
    return stage(fx, "interactions", _interactions)


def _interactions(fx):
    return D.interactions_dataset(_engaged(fx), fx.customer_profile, {"7": "70"})


def engaged_sql(search=True, name="engaged"):
    not_search = "and referrer not like '%/search%'" if search else ""
    p = name
    return f"""{p}_id as (select e.* exclude (user_id), coalesce(e.user_id, u2.value) as user_id, e.user_id as own_id from raw_event e
  left join user_identifier u1 on e.user_id is null and u1.type = 'anonymous_id' and u1.value = e.anonymous_id
  left join user_identifier u2 on u2.type = 'user_id' and u2.canonical_id = u1.canonical_id
  left join customer_profile c on c.user_id = e.user_id
  where coalesce(e.user_id, u2.value) is not null and coalesce(e.user_id, u2.value) not like '%@%' and coalesce(c.functional_consent, 1) = 1),
{p}_v as (select *, rank() over (partition by region, page_search order by ts) as r, row_number() over (partition by visit, item_id, page_section order by ts, event_id, user_id) as rn from {p}_id
  where kind = 'view' and item_id not like '%PRD-%' and (page_section in ('Configure - Recommendation', 'Gallery') or (page_section = 'Studio' and page_url not like '%recommendationsId=%')
    or (page_section = 'Product Page' and referrer not like '%/xs/%')) {not_search}),
{p} as (
  select distinct 'view' as kind, user_id, item_id, cast(floor(epoch(ts)) as bigint) as timestamp, page_section, country as locale,
    case when page_section = 'Configure - Recommendation' then 'addToCart' when page_section in ('Gallery', 'Studio') then 'click' else 'productView' end as event_type
  from {p}_v where (page_section <> 'Configure - Recommendation' or r = 1) and not (page_section in ('Gallery', 'Studio') and rn > 1)
  union all select distinct 'cart', user_id, item_id, cast(floor(epoch(ts)) as bigint), page_section, country, 'addToCart' from {p}_id where kind = 'cart' and route = 'recommendations' and item_id not like '%PRD-%'
  union all select distinct 'wish', user_id, item_id, cast(floor(epoch(ts)) as bigint), page_section, country, 'addToFavorites' from {p}_id where kind = 'wish' and page_section in ('Search Results Page', 'Product Page', 'My Account') and item_id not like '%PRD-%'
  union all select distinct 'click', user_id, item_id, cast(floor(epoch(ts)) as bigint), page_section, country, 'click' from {p}_id where kind = 'click' and route = 'recommendations' and item_id not like '%PRD-%'
    and (page_section in ('Design Services', 'Configure - Recommendation', 'My Account') or (page_section in ('Cart', 'Home Page') and coalesce(lower(list_section_id), lower(offer_type)) like '%matching%'))
  union all select 'order', user_id, p.product_id, cast(floor(epoch(ts)) as bigint), page_section, country, 'purchase'
    from (select *, unnest(from_json(products, '[{{"product_id":"VARCHAR"}}]')) as p from {p}_id where kind = 'order' and own_id is not null) o where p.product_id not like 'PRD-%'
  union all select distinct 'search_click', user_id, item_id, cast(floor(epoch(ts)) as bigint), page_section, country, 'click' from {p}_id where kind = 'search_click' and page_section = 'Search Results Page' and item_id not like '%PRD-%')"""


INTER = f"""{RAW}, {engaged_sql()},
interactions as (select e.user_id, case when e.item_id = '7' then '70' else e.item_id end as item_id, e.timestamp, e.page_section, e.locale, e.event_type
 from engaged e join customer_profile c on c.user_id = e.user_id and c.is_employee = 0 and c.is_anonymous_user = 0)"""
_add("resolve_identity", lambda fx: tidy(D.resolve_identity(fx.item_event, fx.user_identifier).select("event_id", "user_id", "item", "page_section")),
     """select e.event_id, coalesce(e.user_id, u2.value) as user_id, e.item::bigint as item, e.page_section from item_event e
 left join user_identifier u1 on e.user_id is null and u1.type = 'anonymous_id' and u1.value = e.anonymous_id
 left join user_identifier u2 on u2.type = 'user_id' and u2.canonical_id = u1.canonical_id
 where coalesce(e.user_id, u2.value) is not null and coalesce(e.user_id, u2.value) not like '%@%'""")
_add("interactions_dataset", lambda fx: tidy(_interactions(fx)), f"with {INTER} select * from interactions")

_SEG = ["Business", "Consumer", "Unknown"]
_add("qa_users", lambda fx: tidy(D.qa_report(stage(fx, "users", _users), ["user_id", "lifecycle_segment"], ["user_id"],
        {"master_segment": ["Business", "Unknown"], "industry": ["AUTOMOBILE", "BUILDING", "HOUSEHOLD"]}, {"booking_budget_category": list(range(1, 9))})),
     f"""with {USERS} select 'domain' as "check", 'master_segment' as column_name, master_segment as value, count(*) as n from users where master_segment not in ('Business', 'Unknown') group by 3
 union all select 'domain', 'industry', industry, count(*) from users where industry not in ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD') group by 3
 union all select 'exact_domain', 'booking_budget_category', cast(b as string), null from unnest(range(1, 9)) t(b) where b not in (select booking_budget_category from users)""")
_add("qa_interactions", lambda fx: tidy(D.qa_report(_shared(fx), ["item_id", "user_id", "timestamp", "event_type"], None,
        {"page_section": ["Product Page", "Studio", "Gallery", "Cart"]}, {"event_type": ["productView", "purchase", "click", "addToCart", "addToFavorites", "share"]})),
     f"""with {INTER} select 'domain' as "check", 'page_section' as column_name, page_section as value, count(*) as n from interactions where page_section not in ('Product Page', 'Studio', 'Gallery', 'Cart') group by 3
 union all select 'exact_domain', 'event_type', 'share', null""")
_add("qa_items", lambda fx: tidy(D.qa_report(stage(fx, "items", _items_dataset, True), ["item", "is_accessory"], ["region", "item"], {"bulk": ["1_high", "2_medium", "3_low", "4_least"]}, {"is_accessory": [0, 1]}, ["min_unit_price"])),
     f"""with {IM.BULK} select 'domain' as "check", 'bulk' as column_name, '5_unknown' as value, count(*) as n
 from (select distinct region, item from base_item) b where (region, item) not in (select region, item from bulk) having count(*) > 0""")

# --- reporting ------------------------------------------------------------------------------

_ENG = f"{RAW}, {engaged_sql(False)}, browsed as (select * from engaged where kind in ('view', 'click'))"


def _browsed(fx):
    return stage(fx, "browsed", lambda f: _engaged(f, ["view", "click"], False))


_CLICKS = "clicks as (select locale, item_id, count(*) as clicks, row_number() over (partition by locale order by count(*) desc, item_id) as click_rank from browsed group by 1, 2)"
_add("click_rank", lambda fx: tidy(Q.click_rank(_browsed(fx))), f"with {_ENG}, {_CLICKS} select locale, item_id, clicks, click_rank from clicks")

VERSIONS = """model_version as (select concat('model:solution/sol', cast(s_nationkey as string), '/', lpad(cast(s_suppkey as string), 8, '0')) as version_arn,
 cast(date '2023-10-01' + cast((s_suppkey * 37) % 110 as int) as timestamp) as created_at, case when s_suppkey % 4 = 0 then 'FAILED' else 'ACTIVE' end as status, s_acctbal from supplier)"""
_CURRENT = """current_version as (select version_arn, created_at, string_split(version_arn, '/')[2] as solution, string_split(version_arn, '/')[3] as solution_version,
  cast(round(date_diff('second', created_at, timestamp '2024-01-31') / 86400) as bigint) as days_since_retrain, s_acctbal from (
  select *, row_number() over (partition by substring(version_arn, 1, length(version_arn) - 9) order by created_at desc, version_arn desc) as n from model_version where status = 'ACTIVE') v where n = 1)"""


def _versions(fx):
    return fx.sql("with " + VERSIONS + " select * from model_version")


def _served(fx):
    return R.popularity_count(_shared(fx)).withColumn("solution", F.concat(F.lit("sol"), F.substring("locale", 2, 2)))


_POP = """popular as (select * from (select locale, item_id, count(*) as score, row_number() over (partition by locale order by count(*) desc, item_id) as rank
  from (select distinct locale, user_id, item_id, timestamp from interactions) d group by 1, 2) p where rank <= 20)"""
_add("current_versions", lambda fx: tidy(Q.current_versions(_versions(fx), UNTIL)),
     f"with {VERSIONS}, {_CURRENT} select version_arn, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at, days_since_retrain, solution, solution_version from current_version")
_add("cold_start_report", lambda fx: tidy(Q.cold_start_report(_served(fx), Q.click_rank(_browsed(fx)), Q.current_versions(_versions(fx), UNTIL))),
     f"""with {INTER}, {_POP}, {engaged_sql(False, 'engaged2')}, browsed as (select * from engaged2 where kind in ('view', 'click')), {_CLICKS}, {VERSIONS}, {_CURRENT}
 select p.locale, p.item_id, concat('sol', substring(p.locale, 2, 2)) as solution, p.score, row_number() over (partition by p.locale order by p.score desc, p.item_id) as model_rank,
 c.clicks, c.click_rank, v.days_since_retrain from popular p left join clicks c on c.locale = p.locale and c.item_id = p.item_id
 left join current_version v on v.solution = concat('sol', substring(p.locale, 2, 2))""")

_SAMPLE = """banded as (select user_id, count(*) as engagements, arg_max(locale, {'t': timestamp, 'l': locale}) as user_locale from browsed group by 1),
sample as (select * from (select b.*, g.region, case when engagements = 1 then '1. 1' when engagements between 2 and 10 then '2. 2-10' when engagements between 11 and 49 then '3. 11-49' else '4. 50+' end as band,
  row_number() over (partition by g.region, case when engagements = 1 then '1. 1' when engagements between 2 and 10 then '2. 2-10' when engagements between 11 and 49 then '3. 11-49' else '4. 50+' end order by md5(concat('sample', user_id)), user_id) as n
  from banded b join country_region g on g.country = b.user_locale) s where n = 1)"""


def _sample(fx):
    return Q.stratified_user_sample(_browsed(fx), fx.country_region)


_add("stratified_user_sample", lambda fx: tidy(_sample(fx)),
     f"with {_ENG}, {_SAMPLE} select user_locale, user_id, engagements, band, region from sample")
_SUBS = """eng_counts as (select s.user_id, s.user_locale, s.region, s.band, b.subcategory, count(*) as n from sample s join browsed e on e.user_id = s.user_id
  join base_item b on cast(b.item as string) = e.item_id group by 1, 2, 3, 4, 5),
eng_subs as (select user_id, user_locale, region, band, string_agg(subcategory, ',' order by n desc, subcategory) as subcategories from eng_counts group by 1, 2, 3, 4)"""


def _subs(fx):
    return Q.engaged_subcategories(_sample(fx), _browsed(fx), fx.base_item)


_add("engaged_subcategories", lambda fx: tidy(_subs(fx).withColumn("subcategories", F.array_join("subcategories", ","))),
     f"with {_ENG}, {_SAMPLE}, {_SUBS} select * from eng_subs")


def _overlap(fx):
    cats = fx.product.select(F.col("item").cast("string").alias("item_id"), "subcategory")
    recs = R.popularity_count(_shared(fx), 5).join(cats, "item_id", "left")
    users = _sample(fx).select("user_id", F.col("user_locale").alias("locale"))
    return Q.engaged_overlap(recs.join(users, "locale"), _subs(fx)).select("locale", "user_id", "item_id", "rank", "subcategory", "band", "engaged_flag")


_add("engaged_overlap", lambda fx: tidy(_overlap(fx)),
     f"""with {INTER}, {_POP}, {engaged_sql(False, 'engaged2')}, browsed as (select * from engaged2 where kind in ('view', 'click')), {_SAMPLE}, {_SUBS}
 select p.locale, s.user_id, p.item_id, p.rank, c.subcategory, e.band, case when list_contains(string_split(e.subcategories, ','), c.subcategory) then 1 else 0 end::bigint as engaged_flag
 from popular p join sample s on s.user_locale = p.locale left join product c on cast(c.item as string) = p.item_id left join eng_subs e on e.user_id = s.user_id where p.rank <= 5""")


def _metrics(fx):
    m = F.create_map(F.lit("coverage"), F.col("s_acctbal") / 10000, F.lit("ndcg"), F.col("s_acctbal") / 20000)
    rows = Q.metric_rows(_versions(fx).drop("s_acctbal"), _versions(fx).select("version_arn", m.alias("metrics")), UNTIL)
    old = rows.filter("metric_name = 'coverage'").withColumn("metric_score", F.lit(0.0)).withColumn("solution_version", F.lit("old"))
    old = old.withColumn("created_on", F.when(F.col("solution").like("%1%"), F.date_sub("created_on", 1)).otherwise(F.col("created_on")))
    return Q.metric_history(old, rows)


_add("metric_history", lambda fx: tidy(_metrics(fx)),
     f"""with {VERSIONS}, {_CURRENT}, fresh as (select solution, solution_version, cast(created_at as date) as created_on, 'coverage' as metric_name, s_acctbal / 10000 as metric_score from current_version
   union all select solution, solution_version, cast(created_at as date), 'ndcg', s_acctbal / 20000 from current_version)
 select solution, solution_version, strftime(created_on, '%Y-%m-%d') as created_on, metric_name, round(metric_score, 6) as metric_score from fresh
 union all select solution, 'old', strftime(created_on - 1, '%Y-%m-%d'), metric_name, 0.0::double from fresh where metric_name = 'coverage' and solution like '%1%'""")
_add("popular_by_event", lambda fx: tidy(Q.popular_by_event(_interactions(fx), "2024-01-10")),
     f"""with {INTER} select * from (select event_type, locale, item_id, count(*) as n, row_number() over (partition by event_type, locale order by count(*) desc, item_id) as rank
 from interactions where timestamp >= epoch(timestamp '2024-01-10') group by 1, 2, 3) x where rank <= 20""")


def _snapshots(fx):
    days = F.explode(F.sequence(F.lit(0), F.lit(6)))
    rows = fx.catalog_item.select("locale", "item", "product_group", days.alias("d"))
    return rows.select(
        F.lower("locale").alias("region"), "item", "product_group", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("snapshot_date"),
        F.when((F.col("item") + F.col("d")) % 5 != 0, F.col("item") * (F.col("d") + 1)).alias("min_unit_price"))


_add("feature_timeline", lambda fx: tidy(Q.feature_timeline(_snapshots(fx), [1, 2, 3, 5, 8], ["product_group", "min_unit_price"], "2024-01-02", "2024-01-05")),
     """select lower(locale) as region, item, strftime(date '2024-01-01' + cast(d as int), '%Y-%m-%d') as snapshot_date, product_group, case when (item + d) % 5 <> 0 then item * (d + 1) end as min_unit_price
 from (select *, unnest(range(1, 5)) as d from catalog_item) x where item in (1, 2, 3, 5, 8)""")

# --- models ---------------------------------------------------------------------------------

_add("popularity_count", lambda fx: tidy(R.popularity_count(_shared(fx))), f"with {INTER}, {_POP} select * from popular")


def _similar(fx):
    rows = _shared(fx).join(fx.country_region.select(F.col("country").alias("locale"), "region"), "locale")
    return R.item_to_item(rows, 4, 0.5, 20, "region")


_SIM = """ub as (select distinct g.region as locale, i.user_id, i.item_id from interactions i join country_region g on g.country = i.locale),
nn as (select locale, item_id, count(*) as n from ub group by 1, 2),
sim as (select * from (select p.locale, p.source, p.target, p.n as pair_count, round(p.n / (x.n * pow(y.n, 0.5)), 9) as score,
   row_number() over (partition by p.locale, p.source order by round(p.n / (x.n * pow(y.n, 0.5)), 9) desc, p.target) as rank
  from (select a.locale, a.item_id as source, b.item_id as target, count(distinct a.user_id) as n from ub a join ub b on a.locale = b.locale and a.user_id = b.user_id and a.item_id <> b.item_id group by 1, 2, 3 having count(distinct a.user_id) >= 4) p
  join nn x on x.locale = p.locale and x.item_id = p.source join nn y on y.locale = p.locale and y.item_id = p.target) s where rank <= 20)"""
_add("item_to_item", lambda fx: tidy(_similar(fx)),
     f"with {INTER}, {_SIM} select locale, source, target, pair_count, round(score, 6) as score, rank from sim")


def _allowed(fx):
    ok = fx.base_item.filter("is_accessory = 0 and is_logomaker_enabled = 1 and site_category in ('ring', 'widget', 'bolt', 'anvil', 'plate')")
    return ok.select(F.col("country").alias("locale"), F.col("item").cast("string").alias("item_id")).distinct()


def _filtered(fx):
    return R.serve_with_filter(R.popularity_count(_shared(fx), 50).select("locale", "item_id", "rank"), _allowed(fx), ["locale"])


_FILTERED = """pop50 as (select * from (select locale, item_id, row_number() over (partition by locale order by count(*) desc, item_id) as rank
  from (select distinct locale, user_id, item_id, timestamp from interactions) d group by 1, 2) p where rank <= 50),
allowed as (select distinct country as locale, cast(item as string) as item_id from base_item where is_accessory = 0 and is_logomaker_enabled = 1 and site_category in ('ring', 'widget', 'bolt', 'anvil', 'plate')),
filtered as (select locale, item_id, row_number() over (partition by locale order by rank) as rank from pop50 where (locale, item_id) in (select locale, item_id from allowed))"""
_add("serve_with_filter", lambda fx: tidy(_filtered(fx)), f"with {INTER}, {_FILTERED} select * from filtered")


def _invariants(fx):
    unfiltered = R.popularity_count(_shared(fx), 50).select("locale", "item_id", "rank")
    regions = fx.country_region.select(F.col("region").alias("locale")).distinct()
    partners = regions.select("locale", F.lit("1").alias("source"), F.lit("2").alias("target"))
    forbidden = fx.base_item.filter("is_accessory = 1").select(F.col("country").alias("locale"), F.col("item").cast("string").alias("item_id"))
    return R.broken_invariants(unfiltered, _filtered(fx), _similar(fx), partners, forbidden)


_add("served_invariants", lambda fx: tidy(_invariants(fx)),
     f"""with {INTER}, {_FILTERED}, {_SIM}, lists as (select locale, string_agg(item_id, ',' order by rank) as l from pop50 group by 1)
 select 'partner_missing' as "check", region as locale, '1>2' as detail from (select distinct region from country_region) r where region not in (select locale from sim where source = '1' and target = '2')
 union all select 'forbidden_item', f.locale, f.item_id from filtered f where (f.locale, f.item_id) in (select country, cast(item as string) from base_item where is_accessory = 1)
 union all select 'filter_without_effect', locale, '' from (select locale, count(*) as n from pop50 group by 1) p where n = (select count(*) from filtered f where f.locale = p.locale)
 union all select 'same_for_locales', min(locale), cast(count(*) as string) from lists group by l having count(*) > 1""")

# --- event windows --------------------------------------------------------------------------

_add("events_per_window", lambda fx: tidy(S.events_per_window(fx.item_event, "300 seconds", ["event_type"])),
     """select strftime(w, '%Y-%m-%d %H:%M:%S') as window_start, strftime(w + interval 300 second, '%Y-%m-%d %H:%M:%S') as window_end, event_type, count(*) as events
 from (select time_bucket(interval 300 second, ts) as w, event_type from item_event) x group by 1, 2, 3""")
_add("hourly_item_counts", lambda fx: tidy(S.hourly_item_counts(fx.item_event.withColumn("item_id", F.col("item").cast("string")))),
     "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour, cast(item as string) as item_id, count(*) as events from item_event group by 1, 2")
def _watched(fx):
    """Every country with every event type, and a type that no event has."""
    kinds = F.explode(F.array(*[F.lit(k) for k in ("productView", "click", "purchase", "addToCart", "addToFavorites", "share")]))
    return fx.country_region.select("country", kinds.alias("event_type"))


_add("idle_windows", lambda fx: tidy(S.idle_windows(fx.item_event, 3600, ["country", "event_type"], "2024-01-05 00:00:00", "2024-01-12 00:00:00", _watched(fx))),
     """with busy as (select country, event_type, date_trunc('hour', ts) as h from item_event where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-12'),
 spine as (select country, event_type, timestamp '2024-01-05' + to_hours(cast(i as int)) as h from (select country, unnest(['productView', 'click', 'purchase', 'addToCart', 'addToFavorites', 'share']) as event_type from country_region) k, unnest(range(0, 168)) t(i))
 select country, event_type, strftime(h, '%Y-%m-%d %H:%M:%S') as window_start from spine where (country, event_type, h) not in (select country, event_type, h from busy)""")
_add("stream_interactions", lambda fx: tidy(S.stream_interactions(fx.item_event)),
     """select distinct user_id, cast(item as string) as item_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, page_section, country as locale,
 case when event_type = 'productView' and page_section = 'Configure - Recommendation' then 'addToCart' when event_type = 'productView' and page_section in ('Gallery', 'Studio') then 'click' else event_type end as event_type
 from item_event where user_id is not null""")


# --- the same as streams: slices of the events arrive one after the other, the query restarts with each -------------------------

EDGES = ["2024-01-06 12:30:00", "2024-01-09 00:00:00", "2024-01-20 07:00:00"]
DELAY = "2 hours"


def _slices(rows, again=None, close="2024-02-15 00:00:00"):
    """The rows cut at the edges, then `again` (rows that come a second time or late), then a row of no key, far ahead, that closes all windows."""
    bounds = [None, *EDGES, None]
    for low, high in zip(bounds, bounds[1:]):
        inside = F.lit(True)
        if low:
            inside = inside & (F.col("ts") >= F.lit(low).cast("timestamp"))
        if high:
            inside = inside & (F.col("ts") < F.lit(high).cast("timestamp"))
        yield rows.filter(inside)
    if again is not None:
        yield again
    empty = [F.lit(close).cast("timestamp").alias("ts") if c == "ts" else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]
    yield rows.sparkSession.range(1).select(*empty)


def _replayed(fx, rows, build, again=None):
    S.with_state_store(fx.spark)
    rows = cut_lineage(rows.withColumn("ts", F.col("ts").cast("timestamp")))
    return S.replay(_slices(rows, again(rows) if again else None), build, f"{ensure_checkpoint_dir(fx.spark)}/stream-{uuid.uuid4().hex}")


def _window_stream(fx):
    rows = fx.item_event.select("ts", "event_type")
    # Events of the first slice once more: all windows of it are closed, so each is dropped and counted.
    late = lambda rows: rows.filter(F.col("ts") < F.lit(EDGES[0]).cast("timestamp"))
    out, dropped = _replayed(fx, rows, lambda s: S.events_per_window(s, "300 seconds", ["event_type"], DELAY), late)
    return out.withColumn("late_windows", F.lit(dropped > 0))


def _interaction_stream(fx):
    rows = fx.item_event.select("user_id", "item", "ts", "page_section", "country", "event_type")
    again = lambda rows: rows.filter(F.col("ts") >= F.lit(EDGES[1]).cast("timestamp"))
    return _replayed(fx, rows, S.stream_interactions, again)[0]


def _idle_stream(fx):
    rows = fx.item_event.select("ts", "country", "event_type")
    return _replayed(fx, rows, lambda s: idle.idle_stream(s, 3600, ["country", "event_type"], "2024-01-05 00:00:00", "2024-01-12 00:00:00", _watched(fx), DELAY))[0]


_add("events_per_window_stream", lambda fx: tidy(_window_stream(fx)),
     ORACLE["events_per_window"].replace("count(*) as events", "count(*) as events, true as late_windows"))
_add("stream_interactions_stream", lambda fx: tidy(_interaction_stream(fx)), ORACLE["stream_interactions"])
_add("idle_windows_stream", lambda fx: tidy(_idle_stream(fx)), ORACLE["idle_windows"])
