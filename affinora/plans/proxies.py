"""Marketing proxies: price, bulk, rating and design-complexity tags with Bayesian shrinkage.

Group medians and prior weights are exact selections by value bucket, joined back; no group is gathered in one task. Percent ranks run on one row per region and item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinora import config
from affinora.functions import stats
from affinora.operators import ranking
from affinora.operators.quantiles import exact_quantiles, with_quantiles
from affinora.plans.item_master import canonical_country
from affinora.session import cut_packed as cut_lineage


def utc_time(column: str, zone: str | None) -> Column:
    """A local time as UTC; ``zone`` is a column with the zone or offset of the row, none for times in UTC."""
    return F.col(column) if zone is None else F.to_utc_timestamp(F.col(column), F.col(zone))


def valid_mapping(rows: DataFrame, mapping: DataFrame, at: str | Column) -> DataFrame:
    """Join the key mapping valid at the row's time; intervals are half-open, so at most one matches."""
    time = F.col(at) if isinstance(at, str) else at
    keys = mapping.select("product_key", "country", F.col("item").alias("mapped_item"), "valid_from", "valid_to")
    joined = rows.withColumn("_at", time).join(keys, ["product_key", "country"])
    return joined.filter("_at >= valid_from and _at < valid_to").drop("_at", "valid_from", "valid_to")


def rates_of(rates: DataFrame, as_of: str, to_currency: str = "USD") -> DataFrame:
    """(currency, rate_to_usd): the rates into one currency of the day before ``as_of``."""
    day = F.date_sub(F.lit(as_of).cast("date"), 1)
    return rates.filter((F.col("rate_date") == day) & (F.col("to_currency") == to_currency)).select("currency", "rate_to_usd")


def high_value_proxy(items: DataFrame, rates: DataFrame, excluded: list[str]) -> DataFrame:
    """Price tag per (region, item): USD price, imputed by group then subcategory median, ranked in its category."""
    keys = ["region", "category", "subcategory", "product_group", "item"]
    priced = (
        items.filter(~F.col("category").isin(excluded)).join(rates, "currency", "left")
        .select(*keys, "product_key", "moq", (F.col("unit_price") * F.col("rate_to_usd")).alias("usd")).distinct()
    )
    avg = priced.groupBy(*keys).agg(
        F.min("moq").alias("default_moq"),
        # a float sum depends on row order: six places keep equal prices equal in the rank
        F.round(F.avg("usd"), 6).alias("avg_price"),
    )
    avg = cut_lineage(avg)
    imputing = with_quantiles(avg, avg, ["region", "product_group"], "avg_price", {"group_median": 0.5})
    imputing = cut_lineage(with_quantiles(imputing, avg, ["region", "subcategory"], "avg_price", {"subcategory_median": 0.5}))
    by_cat = avg.groupBy("region", "category").agg(
        F.avg("avg_price").alias("category_avg"), F.countDistinct("item").alias("category_items")
    )
    joined = (
        imputing.join(by_cat, ["region", "category"])
        .withColumn("price", F.coalesce("avg_price", "group_median", "subcategory_median"))
        .withColumn("price_imputed", F.col("avg_price").isNull().cast("int"))
        .withColumn("category_ratio", F.try_divide("price", "category_avg"))
    )
    ranked = ranking.percent_rank_of_known(joined, ["region", "category"], "price", "pct_rank")
    return ranked.withColumn("label", stats.quartile_label(F.col("pct_rank")))


def _shrunk(product: DataFrame, system: DataFrame, groups: list[str], n: str, value: str, prior: str) -> DataFrame:
    """Product rows with prior weight (20 % quantile of counts), prior value and the shrunk value."""
    weight = exact_quantiles(product, groups, n, {"system_weight": config.PRIOR_WEIGHT_QUANTILE})
    joined = product.join(weight, groups).join(system, groups)
    shrunk = stats.shrunk_mean(F.col(n), F.col(value), F.col("system_weight"), F.col(prior))
    return joined.withColumn("shrunk", shrunk)


def _labelled(df: DataFrame, score: Column) -> DataFrame:
    scored = cut_lineage(df.withColumn("score", score).drop("shrunk"))
    ranked = ranking.percent_rank_of_known(scored, ["region"], "score", "pct_rank")
    return ranked.withColumn("label", stats.quartile_label(F.col("pct_rank"))).drop("pct_rank")


def bulk_proxy(
    lines: DataFrame, mapping: DataFrame, base: DataFrame, since: str, excluded: list[str], zone: str | None = None
) -> DataFrame:
    """Order-quantity tag per (region, item); products below 50 orders are shrunk to their group.

    Order times are local: ``zone`` names the column with their zone. UK on the order side is GB.
    """
    groups = ["region", "category", "subcategory", "product_group"]
    recent = lines.filter((F.col("created_at") >= F.lit(since).cast("timestamp")) & F.col("product_key").isNotNull())
    timed = recent.select("product_key", canonical_country("country").alias("country"), "order_number", "quantity", utc_time("created_at", zone).alias("_time"))
    mapped = valid_mapping(timed, mapping, "_time").drop("_time")
    levels = base.select(F.col("item").alias("mapped_item"), "country", *groups)
    sold = mapped.join(levels, ["mapped_item", "country"]).withColumnRenamed("mapped_item", "item")
    sold = cut_lineage(sold)
    kept = sold.filter(~F.col("category").isin(excluded))
    product = kept.groupBy(*groups, "item").agg(F.countDistinct("order_number").alias("order_count"))
    product = cut_lineage(with_quantiles(product, kept, [*groups, "item"], "quantity", {"median_quantity": 0.5}))
    system = sold.groupBy(*groups).agg(F.countDistinct("order_number").alias("system_order_count"))
    system = with_quantiles(system, sold, groups, "quantity", {"system_median": 0.5})
    rows = _shrunk(product, system, groups, "order_count", "median_quantity", "system_median")
    score = F.when(F.col("order_count") < config.BULK_SHRINK_BELOW, F.round("shrunk")).otherwise(F.col("median_quantity"))
    return _labelled(rows, score)


def ratings_proxy(
    reviews: DataFrame, lines: DataFrame, mapping: DataFrame, base: DataFrame, excluded: list[str], zone: str | None = None
) -> DataFrame:
    """Rating tag per (region, item), always shrunk to the subcategory; dated by the order, else by the review.

    A review counts once: repeated order lines of its key give the earliest time.
    """
    groups = ["region", "category", "subcategory"]
    ordered = lines.groupBy("order_number", "line_no").agg(F.min(utc_time("created_at", zone)).alias("_ordered_at"))
    dated = reviews.filter("published_flag = 1").join(ordered, ["order_number", "line_no"], "left")
    mapped = valid_mapping(
        dated.select("review_id", "product_key", canonical_country("country").alias("country"), "rating", "_ordered_at", "created_at"),
        mapping, F.coalesce("_ordered_at", "created_at"),
    )
    levels = base.select(F.col("item").alias("mapped_item"), "country", *groups, "product_group")
    rated = (
        mapped.join(levels, ["mapped_item", "country"]).filter(~F.col("category").isin(excluded))
        .withColumnRenamed("mapped_item", "item").select(*groups, "product_group", "item", "review_id", "rating")
    )
    rated = cut_lineage(rated)
    product = rated.groupBy(*groups, "product_group", "item").agg(
        F.countDistinct("review_id").alias("rating_count"), F.avg("rating").alias("rating_avg")
    )
    system = rated.groupBy(*groups).agg(
        F.countDistinct("review_id").alias("system_rating_count"), F.avg("rating").alias("system_rating_avg")
    )
    rows = _shrunk(product, system, groups, "rating_count", "rating_avg", "system_rating_avg")
    return _labelled(rows, F.round(F.round("shrunk", 9), 3))


def visit_starts(site_sessions: DataFrame, since: str) -> DataFrame:
    visits = F.explode(F.from_json("visit_ids", "array<string>"))
    return (
        site_sessions.filter(F.col("session_start") >= F.lit(since).cast("timestamp"))
        .select(visits.alias("visit_id"), "session_start").groupBy("visit_id").agg(F.min("session_start").alias("session_start"))
    )


def design_durations(
    tracking: DataFrame, site_sessions: DataFrame, mapping: DataFrame, since: str,
    done_label: str = "Continue Button", timed_label: str = "Studio review page view",
) -> DataFrame:
    """Minutes per design of completed sessions. A work touched by several sessions is summed per work.

    Completion follows the unique session; works are told apart and times summed by the user's session.
    """
    completed = (
        tracking.filter(F.col("label") == done_label).join(visit_starts(site_sessions, since), "visit_id")
        .groupBy("unique_session_id").agg(F.min("session_start").alias("session_start"))
    )
    shared = (
        tracking.filter("work_id is not null").select("work_id", "session_id").distinct()
        .groupBy("work_id").agg((F.count(F.lit(1)) > 1).alias("is_shared"))
    )
    timed = (
        tracking.filter(F.col("label") == timed_label).join(completed, "unique_session_id").join(shared, "work_id", "left")
        .select("product_key", "country", "session_id", "work_id", "duration_ms", "session_start",
                F.coalesce("is_shared", F.lit(False)).alias("is_shared"))
    )
    mapped = valid_mapping(timed, mapping, "session_start").withColumnRenamed("mapped_item", "item")
    design = F.when(F.col("is_shared"), F.col("work_id")).otherwise(F.col("session_id"))
    summed = mapped.groupBy("country", "item", "is_shared", design.alias("design_id")).agg(F.sum("duration_ms").alias("ms"))
    tenths = F.call_function("div", F.col("ms") * 20 + 60000, F.lit(120000).cast("bigint"))
    return summed.select("country", "item", "is_shared", "design_id", (tenths / 10).alias("minutes"))


def design_complexity_proxy(durations: DataFrame, base: DataFrame, excluded: list[str]) -> DataFrame:
    """Design-time tag per (region, item), shrunk to the subcategory."""
    groups = ["region", "category", "subcategory"]
    timed = durations.join(base.select("item", "country", *groups, "product_group"), ["item", "country"]).filter(
        ~F.col("category").isin(excluded)
    )
    timed = cut_lineage(timed)
    product = timed.groupBy(*groups, "product_group", "item").agg(F.count("design_id").alias("design_count"))
    product = cut_lineage(with_quantiles(product, timed, [*groups, "product_group", "item"], "minutes", {"median_minutes": 0.5}))
    system = timed.groupBy(*groups).agg(F.count("design_id").alias("system_design_count"))
    system = with_quantiles(system, timed, groups, "minutes", {"system_median_minutes": 0.5})
    rows = _shrunk(product, system, groups, "design_count", "median_minutes", "system_median_minutes")
    return _labelled(rows, F.round("shrunk", 9))
