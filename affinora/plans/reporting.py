"""Model QA and reporting: click rank, cold start, user samples, metric history, timelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinora.operators import lists, merge, ranking


def click_rank(engaged: DataFrame) -> DataFrame:
    """Clicks per (locale, item) and the item's rank in its locale, numbered per count and first character of the id."""
    counts = engaged.groupBy("locale", "item_id").agg(F.count(F.lit(1)).alias("clicks"))
    order = [F.desc("clicks"), F.asc("item_id")]
    return ranking.distributed_row_number(counts, ["locale"], [-F.col("clicks"), F.substring("item_id", 1, 1)], order, "click_rank", "_items").drop("_items")


def current_versions(versions: DataFrame, as_of: str) -> DataFrame:
    """Newest active version per solution with its age in days."""
    path = F.expr("substring(version_arn, 1, length(version_arn) - 9)")
    active = versions.filter("status = 'ACTIVE'").withColumn("solution_path", path)
    newest = ranking.latest(active, ["solution_path"], [F.desc("created_at"), F.desc("version_arn")])
    age = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("created_at")) / 86400
    parts = F.split("version_arn", "/")
    return newest.select(
        "version_arn", "created_at", F.round(age).cast("bigint").alias("days_since_retrain"),
        F.get(parts, F.lit(1)).alias("solution"), F.get(parts, F.lit(2)).alias("solution_version"),
    )


def cold_start_report(served: DataFrame, clicks: DataFrame, versions: DataFrame) -> DataFrame:
    """Model rank of served items beside their click rank and the age of the serving version."""
    bucket = F.coalesce(F.floor(F.col("score") * -1024), F.lit(1 << 60))  # a locale is numbered bucket by bucket of its scores
    ranked = ranking.distributed_row_number(served, ["locale"], [bucket], [F.desc("score"), F.asc("item_id")], "model_rank", "_total")
    age = versions.select("solution", "days_since_retrain")
    return ranked.join(clicks, ["locale", "item_id"], "left").join(age, "solution", "left").select(
        "locale", "item_id", "solution", "score", "model_rank", "clicks", "click_rank", "days_since_retrain"
    )


def engagement_band(count):
    return (
        F.when(count == 1, "1. 1").when(count.between(2, 10), "2. 2-10").when(count.between(11, 49), "3. 11-49").otherwise("4. 50+")
    )


def stratified_user_sample(engaged: DataFrame, countries: DataFrame, seed: str = "sample") -> DataFrame:
    """One user per (region, engagement band), chosen by a seeded hash; the locale is the user's latest."""
    users = engaged.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("engagements"), F.max(F.struct("timestamp", "locale"))["locale"].alias("user_locale")
    )
    banded = users.withColumn("band", engagement_band(F.col("engagements"))).join(
        countries.select(F.col("country").alias("user_locale"), "region"), "user_locale"
    )
    draw = F.md5(F.concat(F.lit(seed), "user_id"))
    return ranking.latest(banded.withColumn("_draw", draw), ["region", "band"], ["_draw", "user_id"]).drop("_draw")


def engaged_subcategories(sample: DataFrame, engaged: DataFrame, base: DataFrame) -> DataFrame:
    """Subcategories a sampled user engaged with, most engaged first."""
    subs = base.select(F.col("item").cast("string").alias("item_id"), "subcategory")
    counts = (
        engaged.select("user_id", "item_id").join(sample.select("user_id", "user_locale", "region", "band"), "user_id")
        .groupBy("user_id", "user_locale", "region", "band", "item_id").agg(F.count(F.lit(1)).alias("n"))
        .join(subs.groupBy("item_id", "subcategory").agg(F.count(F.lit(1)).alias("copies")), "item_id")
        .groupBy("user_id", "user_locale", "region", "band", "subcategory").agg(F.sum(F.col("n") * F.col("copies")).alias("n"))
    )
    order = F.struct((-F.col("n")).alias("n"), F.col("subcategory").alias("s"))
    return counts.groupBy("user_id", "user_locale", "region", "band").agg(lists.ordered_array(order, "subcategory").alias("subcategories"))


def engaged_overlap(recommended: DataFrame, sampled: DataFrame) -> DataFrame:
    """Flag recommendations whose subcategory the user engaged with before."""
    joined = recommended.join(sampled.select("user_id", "band", "subcategories"), "user_id", "left")
    hit = F.coalesce(F.array_contains("subcategories", F.col("subcategory")), F.lit(False))
    return joined.withColumn("engaged_flag", hit.cast("int")).drop("subcategories")


def metric_rows(versions: DataFrame, metrics: DataFrame, as_of: str) -> DataFrame:
    """Metric maps of the current versions as (solution, metric, date) rows."""
    current = current_versions(versions, as_of)
    return current.join(metrics, "version_arn").select(
        "solution", "solution_version", F.to_date("created_at").alias("created_on"), F.explode("metrics").alias("metric_name", "metric_score")
    )


def metric_history(history: DataFrame, rows: DataFrame) -> DataFrame:
    return merge.merge_upsert(history, rows, ["solution", "metric_name", "created_on"], ["solution_version", "metric_score"])


def popular_by_event(interactions: DataFrame, since: str, k: int = 20) -> DataFrame:
    """Top items per (event_type, locale) since a day."""
    recent = interactions.filter(F.timestamp_seconds("timestamp") >= F.lit(since).cast("timestamp"))
    counts = recent.groupBy("event_type", "locale", "item_id").agg(F.count(F.lit(1)).alias("n"))
    return ranking.top_k(counts, ["event_type", "locale"], [F.desc("n"), F.asc("item_id")], k)


def feature_timeline(snapshots: DataFrame, items: list, features: list[str], start: str, end: str) -> DataFrame:
    """Feature values of chosen items over the snapshots of a date range."""
    in_range = F.col("snapshot_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return snapshots.filter(in_range & F.col("item").isin(items)).select("region", "item", "snapshot_date", *features)
