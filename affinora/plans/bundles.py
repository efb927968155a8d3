"""Frequently-bought-together lists: rules, ranking, exclusion, fallback cascade, country lists.

List rows have: locale, source, target, rank, target_count and the rule measures. ``locale`` is a
column, so all locales run in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinora import config
from affinora.operators import cooccurrence, lists, ranking
from affinora.plans.item_master import canonical_country

KEYS = ["locale", "source"]


def _purchase_order():
    return [F.desc("conviction"), F.desc("confidence"), F.desc("support"), F.asc("avg_basket_size"), F.asc("target")]


def _view_order():
    return [F.desc("conviction"), F.desc("confidence"), F.desc("support"), F.asc("target")]


def valid_at(mapping: DataFrame, as_of: str) -> DataFrame:
    """Rows of a validity table (valid_from, valid_to; half-open) that hold at a time."""
    at = F.lit(as_of).cast("timestamp")
    return mapping.filter((F.col("valid_from") <= at) & (F.col("valid_to") > at))


def map_items(lines: DataFrame, mapping: DataFrame, as_of: str) -> DataFrame:
    """Order lines with the article of their product key and country valid at ``as_of``; UK on the order side is GB."""
    keys = valid_at(mapping, as_of).select("product_key", "country", "item").distinct()
    return lines.withColumn("country", canonical_country("country")).join(keys, ["product_key", "country"])


def co_purchase_rules(
    lines: DataFrame, since: str, locale: str = "locale", basket: str = "basket", item: str = "item",
    created_at: str = "created_at", min_count: int = config.MIN_PAIR_COUNT, min_targets: int = config.MIN_LIST_LENGTH,
    tile: int = config.BASKET_TILE, sketch_bits: int = 0,
) -> DataFrame:
    """Rules over the orders created at or after ``since``."""
    recent = lines.filter(F.col(created_at) >= F.lit(since).cast("timestamp"))
    rules = cooccurrence.association_rules(recent, locale, basket, item, min_count, min_targets, tile, sketch_bits)
    return rules.withColumnRenamed("segment", "locale")


def co_view_rules(
    views: DataFrame, since: str, locale: str = "locale", visit: str = "visit", item: str = "item",
    viewed_at: str = "ts", page_section: str = "page_section", section: str = "Product Page",
    top: int = config.MAX_VIEW_RANK, min_count: int = config.MIN_PAIR_COUNT,
    min_targets: int = config.MIN_LIST_LENGTH,
) -> DataFrame:
    """Rules over articles viewed in one visit, the best ``top`` targets per source."""
    recent = views.filter((F.col(viewed_at) >= F.lit(since).cast("timestamp")) & (F.col(page_section) == section))
    rules = cooccurrence.association_rules(recent, locale, visit, item, min_count, min_targets)
    rules = rules.withColumnRenamed("segment", "locale").withColumn("avg_basket_size", F.lit(0.0))
    return ranking.top_k(rules, KEYS, _view_order(), top, "view_rank")


def rank_rules(rules: DataFrame, accessories: DataFrame, by: str = "purchase", top: int = config.MAX_BUNDLE_RANK) -> DataFrame:
    """Drop accessory targets of the locale and keep the best ``top`` targets per source."""
    accessory = accessories.select("locale", F.col("item").alias("target")).distinct()
    order = _purchase_order() if by == "purchase" else _view_order()
    return ranking.top_k(rules.join(accessory, ["locale", "target"], "left_anti"), KEYS, order, top)


def _categories(items: DataFrame, category: str, item: str, name: str) -> DataFrame:
    return items.groupBy("locale", F.col("item").alias(item)).agg(F.min(category).alias(name))


def with_target_category(ranked: DataFrame, items: DataFrame, category: str = "site_category") -> DataFrame:
    return ranked.join(_categories(items, category, "target", "_target_cat"), ["locale", "target"], "left")


def _numbered(countries: DataFrame) -> tuple[DataFrame, int, bool]:
    """(locale, country, _no): countries numbered within their locale; the most of a locale; whether a country is in several. A table of nations: few rows."""
    pairs = sorted({(r["locale"], r["country"]) for r in countries.select("locale", "country").dropna().distinct().collect()})
    rows, seen = [], {}
    for locale, country in pairs:
        rows.append((locale, country, seen.get(locale, 0)))
        seen[locale] = seen.get(locale, 0) + 1
    kind = dict(countries.dtypes)
    frame = countries.sparkSession.createDataFrame(rows, f"locale {kind['locale']}, country {kind['country']}, _no int")
    return F.broadcast(frame), max(seen.values(), default=0), len({c for _, c in pairs}) < len(pairs)


def _bit(at):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at.cast("int"))


def with_target_countries(ranked: DataFrame, countries: DataFrame, base_items: DataFrame) -> DataFrame:
    """The locale's countries that sell the target, as bits (_sold_0, ...) in the countries' order; null where none does."""
    numbered, most, _ = _numbered(countries)
    sold = base_items.select("country", F.col("item").alias("target")).join(numbered, "country")
    word = F.floor(F.col("_no") / 64)
    bits = [F.bit_or(F.when(word == k, _bit(F.col("_no") % 64))).alias(f"_sold_{k}") for k in range(most // 64 + 1)]
    return ranked.join(sold.groupBy("locale", "target").agg(*bits), ["locale", "target"], "left")


def exclude_same_category(ranked: DataFrame, items: DataFrame, category: str = "site_category") -> DataFrame:
    """Drop pairs of one category and close the rank gaps. A side without category is kept.

    The source's category joins last: that join and the ranking share one shuffle. Rows may bring their target's category along.
    """
    rows = ranked if "_target_cat" in ranked.columns else with_target_category(ranked, items, category)
    joined = rows.join(_categories(items, category, "source", "_source_cat"), KEYS, "left")
    differs = (
        F.col("_source_cat").isNull() | F.col("_target_cat").isNull() | (F.col("_source_cat") != F.col("_target_cat"))
    )
    kept = joined.filter(differs).drop("_source_cat", "_target_cat")
    return ranking.rerank(kept, KEYS, ["rank", "target"])


def min_list_length(ranked: DataFrame, at_least: int = config.MIN_LIST_LENGTH) -> DataFrame:
    return ranking.min_list_length(ranked, KEYS, "rank", at_least)


def uncovered(universe: DataFrame, covered: DataFrame) -> DataFrame:
    """Universe articles (locale, item) that own no list."""
    have = covered.select("locale", F.col("source").alias("item"))
    return universe.join(have, ["locale", "item"], "left_anti")


def fallback_fill(
    primary: DataFrame, secondary_rules: DataFrame, universe: DataFrame, accessories: DataFrame,
    top: int = config.MAX_BUNDLE_RANK,
) -> DataFrame:
    """Primary lists plus ranked secondary rules for universe articles the primary does not cover."""
    open_items = uncovered(universe, primary).select("locale", F.col("item").alias("source")).distinct()
    fill = rank_rules(secondary_rules.join(open_items, KEYS, "left_semi"), accessories, "view", top)
    cols = ["locale", "source", "target", "rank", "target_count", "source_baskets", "pair_count",
            "confidence", "support", "conviction"]
    return (
        primary.select(*cols, F.lit("purchase").alias("origin"))
        .unionByName(fill.select(*cols, F.lit("view").alias("origin")))
    )


def donor_fill(primary: DataFrame, filled: DataFrame, universe: DataFrame) -> DataFrame:
    """Give articles without a list the list of a donor of the same (locale, product_group).

    The donor is the article with the largest rule count; primary donors win over all others. One
    donor exists per (locale, product_group), so the borrowed list is a small join side.
    """
    universe = universe.groupBy("locale", "item").agg(F.min("product_group").alias("product_group"))
    groups = universe.select("locale", F.col("item").alias("source"), "product_group")

    def donors(rows: DataFrame, name: str) -> DataFrame:
        sources = rows.groupBy(*KEYS).agg(F.max("target_count").alias("target_count"))
        best = ranking.latest(
            sources.join(groups, KEYS).filter(F.col("product_group").isNotNull()),
            ["locale", "product_group"], [F.desc("target_count"), F.asc("source")],
        )
        return best.select("locale", "product_group", F.col("source").alias(name))

    missing = uncovered(universe, filled)
    first = donors(primary, "_first").join(donors(filled, "_second"), ["locale", "product_group"], "full_outer")
    # The donor's list travels as one array per (locale, product_group), so that the many articles of a group
    # that lack a list don't all meet the donor's rows under one join key.
    rest = [c for c in filled.columns if c not in [*KEYS, "origin"]]
    lent = (
        first.select("locale", "product_group", F.coalesce("_first", "_second").alias("source")).join(filled, KEYS)
        .groupBy("locale", "product_group").agg(F.collect_list(F.struct(*rest)).alias("_list"))
    )
    borrowed = missing.join(lent, ["locale", "product_group"]).select("locale", F.col("item").alias("source"), F.explode("_list").alias("_row")).select(*KEYS, "_row.*")
    return filled.unionByName(borrowed.withColumn("origin", F.lit("donor")).select(*filled.columns))


def region_lists(ranked: DataFrame, countries: DataFrame, base_items: DataFrame) -> DataFrame:
    """Fan the locale's lists out to its countries and keep targets sold in the country.

    Rows may bring their targets' countries along (`with_target_countries`). While each country is of one locale, rows keep the
    locale: what is then grouped by locale, country and source needs no shuffle beyond the one that grouped the locale's lists.
    """
    numbered, _, shared = _numbered(countries)
    rows = ranked if "_sold_0" in ranked.columns else with_target_countries(ranked, countries, base_items)
    words = [c for c in rows.columns if c.startswith("_sold_")]
    rows = rows.select("locale", "source", "target", "rank", *words)
    if not shared:
        rows = rows.distinct()
    fanned = rows.join(numbered, "locale")
    word = F.get(F.array(*words), F.floor(F.col("_no") / 64).cast("int"))
    fanned = fanned.filter(word.bitwiseAND(_bit(F.col("_no") % 64)) != 0)
    if shared:
        return fanned.select("country", "source", "target", "rank").distinct()
    return fanned.select("locale", "country", "source", "target", "rank")


def _country_keys(rows: DataFrame) -> list[str]:
    return [c for c in ("locale", "country", "source") if c in rows.columns]


def country_list_text(rows: DataFrame, at_least: int = config.MIN_LIST_LENGTH) -> DataFrame:
    """One ordered comma list per (country, source) with at least ``at_least`` targets."""
    return (
        rows.groupBy(*_country_keys(rows))
        .agg(F.count("target").alias("n"), lists.ordered_text("rank", "target").alias("items"))
        .filter(F.col("n") >= at_least)
        .select("country", "source", "items")
    )


def country_list_rows(rows: DataFrame, at_least: int = config.MIN_LIST_LENGTH) -> DataFrame:
    """The same lists as rows with contiguous ranks; the lists stay in the order of the rank while they are counted."""
    keys = _country_keys(rows)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    ranked = ranking.rerank(rows, keys, ["rank", "target"])
    return ranked.withColumn("_n", n).filter(F.col("_n") >= at_least).select("country", "source", "target", "rank")


def coverage(ranked: DataFrame) -> DataFrame:
    """Articles with a list, per locale."""
    return ranked.select(*KEYS).distinct().groupBy("locale").agg(F.count(F.lit(1)).alias("sources"))


def uncovered_count(universe: DataFrame, ranked: DataFrame, ignore_groups: list[str]) -> DataFrame:
    """Articles without a list, per locale, leaving out some product groups."""
    rest = uncovered(universe, ranked).filter(~F.col("product_group").isin(ignore_groups) | F.col("product_group").isNull())
    return rest.groupBy("locale").agg(F.countDistinct("item").alias("uncovered"))


def head_guard(ranked: DataFrame, locale: str, top_sources: int = 25, ranks: int = 10) -> DataFrame:
    """Smallest pair count among the first ranks of the locale's best-selling sources."""
    rows = ranked.filter(F.col("locale") == locale)
    heads = (
        rows.groupBy("source").agg(F.max("source_baskets").alias("source_baskets"))
        .orderBy(F.desc("source_baskets"), F.asc("source")).limit(top_sources)
    )
    return (
        rows.filter(F.col("rank").between(1, ranks)).join(heads.select("source"), "source", "left_semi")
        .groupBy("source").agg(F.min("pair_count").alias("min_pair_count"), F.max("source_baskets").alias("source_baskets"))
    )


def default_list_flag(served: DataFrame) -> DataFrame:
    """Served comma lists as ranked rows, flagged where the text contains the locale's modal list."""
    modal = ranking.mode_value(served, ["locale"], "items").withColumnRenamed("items", "_modal")
    flagged = served.join(modal, "locale").withColumn(
        "is_default", F.contains(F.col("items"), F.col("_modal")).cast("int")
    )
    return flagged.select(
        "locale", "source", "is_default", F.posexplode(F.split("items", ",")).alias("pos", "target")
    ).select("locale", "source", F.trim("target").alias("target"), (F.col("pos") + 1).alias("rank"), "is_default")


def subset_and_backfill(
    flagged: DataFrame, allowed: DataFrame, rules: DataFrame, accessories: DataFrame,
    at_least: int = 3, top: int = 20,
) -> DataFrame:
    """Restrict served lists to allowed targets; replace default or short lists by rules over the same targets."""
    allowed = allowed.select("locale", F.col("item").cast("string").alias("target")).distinct()
    cols = ["locale", "source", "target", "rank", "is_default"]
    default = flagged.filter("is_default = 1").select(*cols)
    subset = ranking.top_k(
        flagged.filter("is_default = 0").join(allowed, ["locale", "target"], "left_semi").drop("is_default"),
        KEYS, ["rank", "target"], top, "new_rank",
    ).drop("rank").withColumnRenamed("new_rank", "rank")
    longest = F.max("rank").over(Window.partitionBy(*KEYS))
    subset = subset.withColumn("is_default", (longest < at_least).cast("int")).select(*cols)

    manual = rules.withColumn("target", F.col("target").cast("string")).withColumn("source", F.col("source").cast("string"))
    manual = manual.join(allowed, ["locale", "target"], "left_semi")
    n = F.count(F.lit(1)).over(Window.partitionBy(*KEYS))
    manual = manual.withColumn("_n", n).filter(F.col("_n") >= at_least).drop("_n")
    accessory = accessories.select("locale", F.col("item").cast("string").alias("item"))
    manual = min_list_length(rank_rules(manual, accessory, "purchase", top), at_least)
    manual = manual.select("locale", "source", "target", "rank", F.lit(0).alias("is_default"))

    served = default.unionByName(subset)
    open_sources = served.filter("is_default = 1").select(*KEYS).distinct()
    replacement = manual.join(open_sources, KEYS, "left_semi")
    replaced = replacement.select(*KEYS).distinct()
    return served.join(replaced, KEYS, "left_anti").unionByName(replacement).distinct()


def bundle_arrays(served: DataFrame, keys: DataFrame) -> DataFrame:
    """Non-default lists as one ordered array of product keys per source key."""
    source = keys.select("locale", F.col("item").alias("source"), F.col("product_key").alias("source_key"))
    target = keys.select("locale", F.col("item").alias("target"), F.col("product_key").alias("target_key"))
    rows = served.filter("is_default = 0").join(source, KEYS).join(target, ["locale", "target"])
    order = F.struct("rank", "target_key")
    return rows.groupBy("locale", "source_key").agg(lists.ordered_array(order, "target_key").alias("bundle"))
