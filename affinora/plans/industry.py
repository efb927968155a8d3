"""Industry popularity: user uptake, over-index, top lists, user-industry sync."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinora import config
from affinora.functions import stats
from affinora.operators import lists, ranking


def confident_events(
    events: DataFrame, since: str, event_type: str, section: str | None = None,
    confidence: int = config.INDUSTRY_CONFIDENCE,
) -> DataFrame:
    """Distinct (locale, industry, user, item) of one event type by logged-in, confidently classified users.

    This is the one pre-aggregated base of both uptake levels: distinct combines map-side, so a hot
    article or region ships one row per user, not per event.
    """
    rows = events.filter(
        (F.col("event_type") == event_type)
        & F.col("user_id").isNotNull()
        & (F.col("ts") >= F.lit(since).cast("timestamp"))
        & (F.col("confidence_rank") <= confidence)
    )
    if section is not None:
        rows = rows.filter(F.col("page_section") == section)
    return rows.select(F.upper("region").alias("locale"), "industry", "user_id", "item").distinct()


def _distinct_users(base: DataFrame, keys: list[str], name: str) -> DataFrame:
    return base.select(*keys, "user_id").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def uptake(base: DataFrame, keys: list[str]) -> DataFrame:
    """Users of an item over users of the segment, in exact hundredths of a unit (two decimals)."""
    whole = _distinct_users(base, keys, "segment_users")
    part = _distinct_users(base, [*keys, "item"], "item_users")
    hundredths = stats.percent_hundredths(F.col("item_users"), F.col("segment_users"))
    return part.join(whole, keys).withColumn("percent_hundredths", hundredths)


def uptake_region_product(base: DataFrame) -> DataFrame:
    return uptake(base, ["locale"])


def uptake_region_industry_product(base: DataFrame) -> DataFrame:
    return uptake(base, ["locale", "industry"])


def over_index(segment: DataFrame, region: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Over-index of the industry's uptake against the region's, from the rounded percents.

    With ``keys`` (locale, item, product_key) both sides must map to the same product key.
    """
    base = region.select(
        "locale", "item", F.col("segment_users").alias("region_users"), F.col("item_users").alias("region_item_users"),
        F.col("percent_hundredths").alias("region_percent"),
    )
    seg = segment.select(
        "locale", "industry", "item", F.col("segment_users").alias("industry_users"),
        F.col("item_users").alias("industry_item_users"), F.col("percent_hundredths").alias("industry_percent"),
    )
    on = ["locale", "item"]
    if keys is not None:
        keys = keys.filter(F.col("product_key").isNotNull()).select("locale", "item", "product_key").distinct()
        seg, base, on = seg.join(keys, ["locale", "item"]), base.join(keys, ["locale", "item"]), [*on, "product_key"]
    index = stats.over_index_hundredths(F.col("industry_percent"), F.col("region_percent"))
    return seg.join(base, on).withColumn("index_hundredths", index).filter(F.col("index_hundredths").isNotNull())


def order_events(orders: DataFrame, keys: DataFrame) -> DataFrame:
    """Orders as events: order line -> product -> item, kept distinct."""
    return orders.join(keys.select("product_key", "item").distinct(), "product_key").select(
        "locale", "industry", "user_id", "item"
    ).distinct()


def top_industry_items(
    views: DataFrame, carts: DataFrame, orders: DataFrame, items: DataFrame, base_items: DataFrame,
    flagship_category: str, top: int = config.INDUSTRY_TOP, weights: dict[str, float] | None = None,
) -> DataFrame:
    """Weighted index over three event types, one article per product group (per category for the
    flagship category), best ``top`` per (locale, industry), then only articles on sale (no re-rank).

    An article needs all three indexes, so the join starts from the indexes instead of a
    region x industry x product cross join.
    """
    w = weights or config.INDEX_WEIGHTS
    keys = ["locale", "industry", "item"]

    def side(df: DataFrame, name: str, *extra: Column | str) -> DataFrame:
        return df.select(*keys, F.col("index_hundredths").alias(name), *extra)

    scored = (
        side(orders, "_order", F.col("industry_item_users").alias("order_users"))
        .join(side(carts, "_cart"), keys).join(side(views, "_view"), keys)
        .withColumn("final_index", (w["order"] * F.col("_order") + w["cart"] * F.col("_cart") + w["view"] * F.col("_view")) / 100)
        .drop("_order", "_cart", "_view").filter(F.col("final_index") >= 0)
    )
    text = F.col("item_name")
    usable = text.isNotNull() & ~text.like("PRD-%") & text.try_cast("decimal(38,0)").isNull()
    named = scored.join(items.select("locale", "item", "item_name", "category", "product_group"), ["locale", "item"]).filter(usable)
    is_flagship = F.col("category") == flagship_category
    slot = F.when(is_flagship, F.concat(F.lit("category:"), "category")).otherwise(F.concat(F.lit("group:"), "product_group"))
    order = [F.desc("final_index"), F.desc("order_users"), F.asc("item")]
    one_each = ranking.latest(named.withColumn("_slot", slot), ["locale", "industry", "_slot"], order)
    ranked = ranking.top_k(one_each.drop("_slot"), ["locale", "industry"], order, top)
    return ranked.join(base_items.select("locale", "item"), ["locale", "item"], "left_semi")


def industry_lists(top_items: DataFrame, countries: DataFrame) -> DataFrame:
    """Ordered list per (industry, country)."""
    return (
        top_items.join(countries.select("locale", "country"), "locale")
        .groupBy("industry", "country").agg(lists.ordered_text("rank", "item").alias("items"))
    )


def list_gates(lists_df: DataFrame, industries: int, countries: int, at_least: int = 5) -> DataFrame:
    """Violated gates: number of industries, number of countries, lists that are too short."""
    facts = lists_df.agg(
        F.countDistinct("industry").alias("industries"), F.countDistinct("country").alias("countries"),
        F.sum((F.size(F.split("items", ",")) < at_least).cast("bigint")).alias("short_lists"),
    )
    rows = facts.select(
        F.explode(F.array(
            F.struct(F.lit("industries").alias("gate"), F.col("industries").alias("value"), F.lit(industries).cast("bigint").alias("expected")),
            F.struct(F.lit("countries").alias("gate"), F.col("countries").alias("value"), F.lit(countries).cast("bigint").alias("expected")),
            F.struct(F.lit("short_lists").alias("gate"), F.coalesce("short_lists", F.lit(0)).alias("value"), F.lit(0).cast("bigint").alias("expected")),
        )).alias("g")
    ).select("g.*")
    return rows.filter("value <> expected")


def confident_users(users: DataFrame, confidence: int = config.INDUSTRY_CONFIDENCE) -> DataFrame:
    return users.filter((F.col("confidence_rank") <= confidence) & F.col("user_id").isNotNull()).select("user_id", "industry")
