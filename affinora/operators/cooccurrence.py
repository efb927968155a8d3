"""Co-occurrence counting and association rules over (segment, basket, item) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinora import config
from affinora.session import cut_lineage, cut_packed


def distinct_baskets(df: DataFrame, segment: str, basket: str, item: str) -> DataFrame:
    """Distinct (segment, basket, item) rows with the basket's article count.

    The distinct combines map-side, so a basket repeated in a third of the input collapses to its
    distinct articles before the shuffle; its size is a combined count joined back, not a window over it.
    """
    return with_sizes(distinct_members(df, segment, basket, item))


def distinct_members(df: DataFrame, segment: str, basket: str, item: str) -> DataFrame:
    rows = df.select(F.col(segment).alias("segment"), F.col(basket).alias("basket"), F.col(item).alias("item"))
    return rows.filter("segment is not null and basket is not null and item is not null").distinct()


def with_sizes(members: DataFrame) -> DataFrame:
    sizes = members.groupBy("segment", "basket").agg(F.count(F.lit(1)).alias("basket_size"))
    return members.join(sizes, ["segment", "basket"])


def item_totals(baskets: DataFrame) -> DataFrame:
    """Baskets per item and the item's share of all basket memberships of the segment."""
    totals = baskets.groupBy("segment", "item").agg(F.count(F.lit(1)).alias("item_baskets"))
    whole = totals.groupBy("segment").agg(F.sum("item_baskets").alias("_whole"))
    return totals.join(whole, "segment").select(
        "segment", "item", "item_baskets", (F.col("item_baskets") / F.col("_whole")).alias("support")
    )


def _pair_bucket(bits: int) -> Column:
    return F.pmod(F.xxhash64("segment", "item", "other"), F.lit(1 << bits))


def likely_frequent(pairs: DataFrame, min_count: int, bits: int) -> DataFrame:
    """Pairs without most of those that occur less than ``min_count`` times: a pair whose hash bucket counts too few cannot occur often enough.

    Bucket counts combine map-side to 2^bits rows at most, and the filter that goes to all tasks holds one bit for each: both have a fixed size.
    Pairs of a full enough bucket stay, whatever their own count, so the exact count that follows decides alone.
    """
    h = _pair_bucket(bits)
    full = pairs.groupBy(h.alias("_h")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_count)
    word = lambda c: F.call_function("div", c, F.lit(64).cast("bigint"))
    bits_of = full.select(word(F.col("_h")).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_h") % 64).cast("int")).alias("_bit"))
    bits_of = bits_of.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    marked = pairs.withColumn("_h", h)
    set_bit = F.call_function("shiftright", F.col("_bits"), (F.col("_h") % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
    return marked.join(F.broadcast(bits_of), (word(F.col("_h")) == F.col("_word")) & set_bit, "left_semi").drop("_h")


def pair_counts(
    baskets: DataFrame, min_count: int = config.MIN_PAIR_COUNT, tile: int = config.BASKET_TILE, sketch_bits: int = 0,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Unordered article pairs (item < other) with basket count and summed basket size.

    * An item in fewer than ``min_count`` baskets cannot be in a qualifying pair: it is dropped first.
    * With ``totals`` (segment, item and facts of the item), every pair also has the facts of both sides as ``item_<name>`` and
      ``other_<name>``. They join the basket rows, so the far more numerous pairs need no join of their own.
    * Baskets up to ``tile`` articles join on the basket key, which their size count already hashed.
    * Larger baskets are cut into blocks of about ``tile`` articles; each pair of blocks is a join key of
      its own, so a basket holding a large share of all rows spreads over many tasks and no key
      produces more than about tile^2 pairs. Counting combines map-side.
    * With ``sketch_bits``, pairs are formed twice: bucket counts of the first time keep rare pairs out of the exact count's shuffle.
    """
    rows = baskets.filter("basket_size > 1")
    if min_count > 1:
        frequent = (
            baskets.groupBy("segment", "item").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_count)
        ).drop("_n")
        rows = rows.join(frequent, ["segment", "item"], "left_semi")
    facts = [c for c in totals.columns if c not in ("segment", "item")] if totals is not None else []
    if facts:
        rows = rows.join(totals, ["segment", "item"])
    mine, theirs = [f"item_{c}" for c in facts], [f"other_{c}" for c in facts]
    rows = rows.select("segment", "basket", "item", "basket_size", *[F.col(c).alias(m) for c, m in zip(facts, mine)])
    if facts:
        rows = cut_lineage(rows)  # both sides of the pairs read it
    of_other = [F.col(m).alias(t) for m, t in zip(mine, theirs)]
    light = rows.filter(F.col("basket_size") <= tile)
    right = light.select("segment", "basket", F.col("item").alias("other"), *of_other)
    small_pairs = light.join(right, ["segment", "basket"]).filter("item < other")

    heavy = rows.filter(F.col("basket_size") > tile).withColumn(
        "_blocks", F.ceil(F.col("basket_size") / tile).cast("int")
    )
    heavy = heavy.withColumn("_block", F.pmod(F.xxhash64("item"), F.col("_blocks")).cast("int"))
    first = heavy.withColumn("_b2", F.explode(F.sequence("_block", F.col("_blocks") - 1))).withColumnRenamed(
        "_block", "_b1"
    )
    second = (
        heavy.withColumn("_b1", F.explode(F.sequence(F.lit(0), F.col("_block"))))
        .withColumnRenamed("_block", "_b2")
        .select("segment", "basket", "_b1", "_b2", F.col("item").alias("other"), *of_other)
    )
    big_pairs = first.join(second, ["segment", "basket", "_b1", "_b2"]).filter("_b1 < _b2 or item < other")
    straight = F.col("item") < F.col("other")
    big_pairs = big_pairs.select(
        "segment", F.least("item", "other").alias("item"), F.greatest("item", "other").alias("other"), "basket_size",
        *[F.when(straight, F.col(m)).otherwise(F.col(t)).alias(m) for m, t in zip(mine, theirs)],
        *[F.when(straight, F.col(t)).otherwise(F.col(m)).alias(t) for m, t in zip(mine, theirs)],
    )
    pairs = small_pairs.select("segment", "item", "other", "basket_size", *mine, *theirs).unionByName(big_pairs)
    if sketch_bits and min_count > 1:
        pairs = likely_frequent(pairs, min_count, sketch_bits)
    return (
        pairs.groupBy("segment", "item", "other")
        .agg(F.count(F.lit(1)).alias("pair_count"), F.sum("basket_size").alias("_size_sum"), *[F.max(c).alias(c) for c in mine + theirs])
        .filter(F.col("pair_count") >= min_count)
    )


def association_rules(
    df: DataFrame,
    segment: str,
    basket: str,
    item: str,
    min_count: int = config.MIN_PAIR_COUNT,
    min_targets: int = config.MIN_LIST_LENGTH,
    tile: int = config.BASKET_TILE,
    sketch_bits: int = 0,
) -> DataFrame:
    """Directed rules source -> target with support of the target, confidence and conviction.

    Both directions of a pair come from one counted row. Only sources with at least ``min_targets``
    rules remain; ``target_count`` is their number of rules. Totals, sizes and pairs read the distinct rows,
    which are written once; pairs bring the totals of their articles along.
    """
    members = cut_packed(distinct_members(df, segment, basket, item))
    pairs = pair_counts(with_sizes(members), min_count, tile, sketch_bits, item_totals(members))

    def side(source: str, target: str) -> Column:
        return F.struct(
            F.col(source).alias("source"), F.col(target).alias("target"),
            F.col(f"{source}_item_baskets").alias("source_baskets"), F.col(f"{target}_support").alias("support"),
        )

    directed = pairs.withColumn("_side", F.explode(F.array(side("item", "other"), side("other", "item"))))
    confidence = F.col("pair_count") / F.col("source_baskets")
    rules = directed.select("segment", "_side.*", "pair_count", "_size_sum").select(
        "segment", "source", "target", "source_baskets", "pair_count",
        (F.col("_size_sum") / F.col("pair_count")).alias("avg_basket_size"),
        confidence.alias("confidence"),
        "support",
        ((1 - F.col("support")) / (1 - confidence + F.lit(config.CONVICTION_EPSILON))).alias("conviction"),
    )
    n = F.count(F.lit(1)).over(Window.partitionBy("segment", "source"))
    return rules.withColumn("target_count", n).filter(F.col("target_count") >= min_targets)
