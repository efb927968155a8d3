"""Re-aimed managed recipes: popularity, item-to-item, filtered serving and their invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinora.operators import cooccurrence, ranking


def popularity_count(interactions: DataFrame, k: int = 20) -> DataFrame:
    """Most popular items per locale by distinct (user, item, time) events."""
    events = interactions.select("locale", "user_id", "item_id", "timestamp").distinct()
    counts = events.groupBy("locale", "item_id").agg(F.count(F.lit(1)).alias("score"))
    return ranking.top_k(counts, ["locale"], [F.desc("score"), F.asc("item_id")], k)


def item_to_item(
    interactions: DataFrame, min_cointeraction: int = 8, popularity_discount: float = 0.5, k: int = 20,
    locale: str = "locale", basket: str = "user_id", item: str = "item_id",
) -> DataFrame:
    """Similar items by shared users: n_xy / (n_x * n_y ^ discount), for pairs with enough shared users."""
    baskets = cooccurrence.distinct_baskets(interactions, locale, basket, item)
    pairs = cooccurrence.pair_counts(baskets, min_cointeraction)
    totals = cooccurrence.item_totals(baskets).select("segment", "item", "item_baskets")
    sides = F.explode(F.array(
        F.struct(F.col("item").alias("source"), F.col("other").alias("target")),
        F.struct(F.col("other").alias("source"), F.col("item").alias("target")),
    ))
    directed = pairs.select("segment", "pair_count", sides.alias("s")).select("segment", "pair_count", "s.*")
    scored = (
        directed.join(totals.withColumnsRenamed({"item": "source", "item_baskets": "_nx"}), ["segment", "source"])
        .join(totals.withColumnsRenamed({"item": "target", "item_baskets": "_ny"}), ["segment", "target"])
    )
    score = F.col("pair_count") / (F.col("_nx") * F.pow(F.col("_ny").cast("double"), F.lit(popularity_discount)))
    rows = scored.select(F.col("segment").alias("locale"), "source", "target", "pair_count", F.round(score, 9).alias("score"))
    return ranking.top_k(rows, ["locale", "source"], [F.desc("score"), F.asc("target")], k)


def serve_with_filter(recommended: DataFrame, allowed: DataFrame, keys: list[str], item: str = "item_id") -> DataFrame:
    """Keep recommendations of allowed items and close the rank gaps."""
    kept = recommended.join(allowed.select("locale", item), ["locale", item], "left_semi")
    return ranking.rerank(kept, keys, ["rank", item])


def broken_invariants(
    unfiltered: DataFrame, filtered: DataFrame, similar: DataFrame, partners: DataFrame, forbidden: DataFrame
) -> DataFrame:
    """Behavioural checks on served lists, one row per broken one.

    * ``partner_missing``: an expected (source, target) pair absent from the similar lists
    * ``forbidden_item``: an item the filter must remove is still served
    * ``filter_without_effect``: a locale whose filtered list equals the unfiltered one
    * ``same_for_locales``: two locales serving the same list
    """
    missing = partners.join(similar, ["locale", "source", "target"], "left_anti").select(
        F.lit("partner_missing").alias("check"), "locale", F.concat_ws(">", "source", "target").alias("detail")
    )
    leaked = filtered.join(forbidden, ["locale", "item_id"], "left_semi").select(
        F.lit("forbidden_item").alias("check"), "locale", F.col("item_id").alias("detail")
    )
    removed = unfiltered.select("locale", "item_id").join(filtered.select("locale", "item_id"), ["locale", "item_id"], "left_anti")
    effect = unfiltered.select("locale").distinct().join(removed.select("locale"), "locale", "left_anti")
    no_effect = effect.select(F.lit("filter_without_effect").alias("check"), "locale", F.lit("").alias("detail"))
    text = unfiltered.groupBy("locale").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "item_id"))), lambda x: x["item_id"]), ",").alias("_list")
    )
    same = text.groupBy("_list").agg(F.count(F.lit(1)).alias("n"), F.min("locale").alias("locale")).filter("n > 1").select(
        F.lit("same_for_locales").alias("check"), "locale", F.col("n").cast("string").alias("detail")
    )
    return missing.unionByName(leaked).unionByName(no_effect).unionByName(same)
