"""Training datasets: items, users, interactions, their identity stitching and QA."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinora.operators import quality, ranking

# fixed values: bands of spend ventiles
SPEND_BANDS = {1: [1], 2: [2], 3: [3, 4], 4: [5], 5: [6, 7, 8], 6: [9, 10, 11]}
LAST_BAND = 7
UNKNOWN_LABEL = "5_unknown"


def items_dataset(
    base: DataFrame, high_value: DataFrame, bulk: DataFrame, ratings: DataFrame, complexity: DataFrame
) -> DataFrame:
    """One row per (region, item): collapsed countries, proxy labels, values with group fallback."""
    keys = ["region", "category", "subcategory", "product_group", "item", "product_key", "is_accessory"]
    items = base.groupBy(*keys).agg(
        F.max("parent_site_category").alias("parent_site_category"), F.max("site_category").alias("site_category"),
        F.max("is_logomaker_enabled").alias("is_logomaker_enabled"),
        F.max("days_since_merchandisable").alias("days_since_merchandisable"),
        F.min("creation_timestamp").alias("timestamp"),
    )
    sub = ["region", "category", "subcategory"]
    own = {
        "hv": high_value.select("region", "item", F.col("label").alias("hv_label"), "default_moq", F.col("price").alias("own_price")),
        "bulk": bulk.select("region", "item", F.col("label").alias("bulk_label"), F.col("score").alias("own_quantity")),
        "rating": ratings.select("region", "item", F.col("label").alias("rating_label"), F.col("score").alias("own_rating")),
        "design": complexity.select("region", "item", F.col("label").alias("design_label"), F.col("median_minutes").alias("own_minutes")),
    }
    joined = items
    for frame in own.values():
        joined = joined.join(frame, ["region", "item"], "left")
    joined = (
        joined.join(high_value.select(*sub, "subcategory_median").distinct(), sub, "left")
        .join(ratings.select(*sub, "system_rating_avg").distinct(), sub, "left")
        .join(complexity.select(*sub, "system_median_minutes").distinct(), sub, "left")
        .join(bulk.select(*sub, "product_group", "system_median").distinct(), [*sub, "product_group"], "left")
    )

    def label(column: str) -> Column:
        return F.coalesce(column, F.lit(UNKNOWN_LABEL))

    full = joined.select(
        "region", "category", "subcategory", "product_group", "item", "product_key", "parent_site_category", "site_category",
        "is_accessory", "is_logomaker_enabled", label("design_label").alias("design_complexity"),
        F.coalesce("own_minutes", "system_median_minutes").alias("median_studio_duration"),
        label("bulk_label").alias("bulk"), F.coalesce("own_quantity", "system_median").alias("median_order_quantity"),
        label("rating_label").alias("rating"), F.coalesce("own_rating", "system_rating_avg").alias("calc_product_rating"),
        label("hv_label").alias("high_value"), "default_moq", F.coalesce("own_price", "subcategory_median").alias("min_unit_price"),
        "days_since_merchandisable", "timestamp",
    )
    return ranking.latest(full, ["region", "item"], [F.desc("is_logomaker_enabled"), F.asc("product_key")]).drop("product_key")


def spend_band(ventile: Column) -> Column:
    cases = [(band, values) for band, values in SPEND_BANDS.items()]
    expr = functools.reduce(lambda e, bv: e.when(ventile.isin(bv[1]), bv[0]), cases[1:], F.when(ventile.isin(cases[0][1]), cases[0][0]))
    return expr.otherwise(LAST_BAND)


def users_dataset(orders: DataFrame, customers: DataFrame, countries: DataFrame, as_of: str, months: int = 15) -> DataFrame:
    """Reachable customers with order count, spend band and profile; region comes from the main country."""
    start = F.add_months(F.lit(as_of).cast("date"), -months)
    recent = orders.filter(F.to_date("created_at") > start)
    per_country = recent.select("customer_id", "country", "order_number").distinct().groupBy("customer_id", "country").agg(
        F.count(F.lit(1)).alias("n")
    )
    main = ranking.latest(per_country, ["customer_id"], [F.desc("n"), F.asc("country")]).select("customer_id", F.col("country").alias("main_country"))
    spend = recent.groupBy("customer_id").agg(
        F.countDistinct("order_number").alias("total_order_count"), F.sum(F.col("total").cast("decimal(20,2)")).alias("bookings"),
        F.max(F.to_date("created_at")).alias("last_order_date"),
    )
    never = F.lit("1900-01-01").cast("date")
    last_seen = F.greatest(*[F.coalesce(c, never) for c in ("registration_date", "last_order_date", "last_page_view_date")])
    users = (
        customers.filter((F.col("is_employee") == 0) & (F.upper("opt_status") == "OPTED IN") & F.col("user_id").isNotNull())
        .join(main, "customer_id", "left").join(spend, "customer_id", "left").filter(last_seen > start)
        .withColumn("country", F.coalesce("main_country", "country")).drop("region").join(countries.select("country", "region"), "country")
        .withColumn("bookings", F.coalesce("bookings", F.lit(0).cast("decimal(20,2)")))
        .withColumn("_tie", F.md5("user_id"))
    )
    # Buckets follow the order (spend desc, md5): log-scale spend, and for zero spend the hash prefix.
    size = -F.floor(F.log2(F.greatest(F.col("bookings").cast("double"), F.lit(0.0)) + 1) * 8)
    prefix = F.when(F.col("bookings") == 0, F.substring("_tie", 1, 2)).otherwise("")
    numbered = ranking.distributed_row_number(
        users, ["region"], [size, prefix], [F.desc("bookings"), F.asc("_tie"), F.asc("user_id")], "_row", "_users"
    )
    unknown = F.lit("Unknown")
    return numbered.select(
        "region", "user_id", F.coalesce("total_order_count", F.lit(0)).alias("total_order_count"),
        spend_band(ranking.ntile_of(F.col("_row"), F.col("_users"), 20)).alias("booking_budget_category"),
        F.coalesce("opt_status", unknown).alias("current_opt_status"),
        F.coalesce(F.col("is_digital_purchaser").cast("string"), F.lit("0")).alias("is_digital_purchaser"),
        F.coalesce("lifecycle_segment", unknown).alias("lifecycle_segment"),
        F.coalesce("master_segment", unknown).alias("master_segment"), F.coalesce("industry", unknown).alias("industry"),
    )


def resolve_identity(events: DataFrame, identifiers: DataFrame, consent: DataFrame | None = None) -> DataFrame:
    """Give every event its user id; anonymous ones go through their canonical id; unresolved ones drop out.

    Rows that a join does not concern carry a key made from their event id, so no join meets a mass of
    null keys. ``consent`` (user_id, functional_consent) removes known users who declined.
    """
    anonymous = identifiers.filter("type = 'anonymous_id'").select(F.concat(F.lit("a:"), "value").alias("_key"), "canonical_id")
    users = identifiers.filter("type = 'user_id'").select(F.col("value").alias("_linked"), "canonical_id")
    link = anonymous.join(users, "canonical_id").select("_key", "_linked")
    spread = F.concat(F.lit("e:"), F.col("event_id").cast("string"))
    known = F.col("user_id").isNotNull()
    rows = events
    if consent is not None:
        declined = consent.filter("functional_consent = 0").select(F.concat(F.lit("u:"), "user_id").alias("_key")).distinct()
        own = F.when(known, F.concat(F.lit("u:"), "user_id")).otherwise(spread)
        rows = rows.withColumn("_key", own).join(declined, "_key", "left_anti").drop("_key")
    key = F.when(~known, F.concat(F.lit("a:"), F.coalesce("anonymous_id", spread))).otherwise(spread)
    resolved = rows.withColumn("_key", key).join(link, "_key", "left")
    resolved = resolved.withColumn("user_id", F.coalesce("user_id", "_linked")).select(*events.columns)
    return resolved.filter(F.col("user_id").isNotNull() & ~F.col("user_id").like("%@%"))


_VIEW_SECTIONS_CLICK = ["Gallery", "Studio"]
_CONFIGURE = "Configure - Recommendation"
_WISH_SECTIONS = ["Search Results Page", "Product Page", "My Account"]
_CLICK_SECTIONS = ["Design Services", _CONFIGURE, "My Account"]
_MATCHING_SECTIONS = ["Cart", "Home Page"]


def eligible(exclude_search: bool = True) -> Column:
    """Which raw events count, per kind. SQL three-valued logic: a null referrer or url drops the row."""
    section, item = F.col("page_section"), F.col("item_id")
    not_key = ~item.like("%PRD-%")
    view = (
        section.isin(_CONFIGURE, "Gallery")
        | ((section == "Studio") & ~F.col("page_url").like("%recommendationsId=%"))
        | ((section == "Product Page") & ~F.col("referrer").like("%/xs/%"))
    )
    if exclude_search:
        view = view & ~F.col("referrer").like("%/search%")
    matching = F.coalesce(F.lower("list_section_id"), F.lower("offer_type")).like("%matching%")
    routed = F.col("route") == "recommendations"
    click = routed & (section.isin(_CLICK_SECTIONS) | (section.isin(_MATCHING_SECTIONS) & matching))
    return (
        F.when(F.col("kind") == "view", view & not_key)
        .when(F.col("kind") == "cart", routed & not_key)
        .when(F.col("kind") == "wish", section.isin(_WISH_SECTIONS) & not_key)
        .when(F.col("kind") == "click", click & not_key)
        .when(F.col("kind") == "order", F.col("user_id").isNotNull() & ~item.like("PRD-%"))
        .when(F.col("kind") == "search_click", (section == "Search Results Page") & not_key)
        .otherwise(False)
    )


def explode_orders(events: DataFrame) -> DataFrame:
    """One event per ordered product; other kinds pass through."""
    products = F.transform(F.from_json("products", "array<struct<product_id:string>>"), lambda p: p["product_id"])
    ids = F.when(F.col("kind") == "order", products).otherwise(F.array("item_id"))
    cols = [c for c in events.columns if c not in ("item_id", "products")]
    return events.select(*cols, F.posexplode(ids).alias("position", "item_id"))


def engagement(
    events: DataFrame, identifiers: DataFrame, consent: DataFrame | None, since: str, until: str,
    kinds: list[str] | None = None, exclude_search: bool = True,
) -> DataFrame:
    """Normalised interactions before the customer filter.

    A configure-page view counts only at the first time of its search in its region (compared as search
    and time, so the mass of views without a search never meets in one window); gallery and studio views
    count once per visit, item and section.
    """
    rows = events if kinds is None else events.filter(F.col("kind").isin(kinds))
    in_time = (F.col("ts") > F.lit(since).cast("timestamp")) & (F.col("ts") < F.lit(until).cast("timestamp"))
    rows = resolve_identity(explode_orders(rows.filter(in_time)).filter(eligible(exclude_search)), identifiers, consent)

    is_view, section = F.col("kind") == "view", F.col("page_section")
    is_configure = is_view & (section == _CONFIGURE)
    is_browse = is_view & section.isin(_VIEW_SECTIONS_CLICK)
    firsts = rows.filter(is_view).groupBy(F.col("region").alias("_region"), F.col("page_search").alias("_search")).agg(F.min("ts").alias("_first"))
    same = F.col("region").eqNullSafe(F.col("_region")) & F.col("page_search").eqNullSafe(F.col("_search"))
    rows = rows.join(firsts, same & (F.col("ts") == F.col("_first")), "left")
    rows = rows.filter(~is_configure | F.col("_first").isNotNull())

    # One aggregate does both jobs: a browse view keeps its first row per visit, item and section,
    # everything else is distinct on its output columns (ordered products stay row by row).
    first = F.struct("ts", "event_id", "user_id", "country")
    own = ~is_browse
    keys = [
        F.col("kind"), F.col("item_id"), F.col("page_section"), F.when(is_browse, F.col("visit")).alias("_visit"),
        F.when(own, F.col("user_id")).alias("_user"), F.when(own, F.unix_seconds(F.col("ts").cast("timestamp"))).alias("_second"),
        F.when(own, F.col("country")).alias("_country"),
        F.when(F.col("kind") == "order", F.struct("event_id", "position", "user_id")).alias("_order_row"),
    ]
    kept = rows.groupBy(*keys).agg(F.min(first).alias("f"))
    event_type = (
        F.when(is_configure, "addToCart").when(is_browse, "click")
        .when(is_view, "productView").when(F.col("kind") == "cart", "addToCart").when(F.col("kind") == "wish", "addToFavorites")
        .when(F.col("kind") == "order", "purchase").otherwise("click")
    )
    shaped = kept.select(
        "_order_row", "kind", F.col("f.user_id").alias("user_id"), "item_id", F.unix_seconds(F.col("f.ts").cast("timestamp")).alias("timestamp"),
        "page_section", F.col("f.country").alias("locale"), event_type.alias("event_type"),
    )
    return shaped.distinct().drop("_order_row")


def interactions_dataset(engaged: DataFrame, customers: DataFrame, remap: dict[str, str] | None = None) -> DataFrame:
    """Interactions of real customers (no employees, no anonymous profiles), with item ids remapped."""
    allowed = customers.filter("is_employee = 0 and is_anonymous_user = 0").select("user_id")
    item = F.col("item_id")
    if remap:
        table = F.create_map(*[F.lit(x) for pair in remap.items() for x in pair])
        item = F.coalesce(F.try_element_at(table, item), item)
    return engaged.join(allowed, "user_id").select("user_id", item.alias("item_id"), "timestamp", "page_section", "locale", "event_type")


def qa_report(
    df: DataFrame, not_null: list[str], unique: list[str] | None = None, domains: dict[str, list] | None = None,
    exact: dict[str, list] | None = None, non_negative: list[str] | None = None,
) -> DataFrame:
    """All checks of a dataset as one violations table (check, column_name, value, n)."""

    def shape(frame: DataFrame, check: str, column: Column, value: Column, n: Column) -> DataFrame:
        return frame.select(F.lit(check).alias("check"), column.alias("column_name"), value.cast("string").alias("value"), n.cast("bigint").alias("n"))

    none = F.lit(None)
    parts = [
        shape(quality.null_columns(df, not_null), "null", F.col("column_name"), none, F.col("n")),
        shape(quality.all_null_columns(df, df.columns), "all_null", F.col("column_name"), none, none),
    ]
    if unique:
        parts.append(shape(quality.duplicates(df, unique), "duplicate", F.lit(",".join(unique)), F.concat_ws("|", *unique), F.col("n")))
    for column, allowed in (domains or {}).items():
        parts.append(shape(quality.outside_domain(df, column, allowed), "domain", F.lit(column), F.col(column), F.col("n")))
    for column, values in (exact or {}).items():
        parts.append(shape(quality.domain_difference(df, column, values), "exact_domain", F.lit(column), F.col("value"), none))
    for column in non_negative or []:
        bad = quality.negatives(df, column).groupBy().agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
        parts.append(shape(bad, "negative", F.lit(column), none, F.col("n")))
    return functools.reduce(DataFrame.unionByName, parts)
