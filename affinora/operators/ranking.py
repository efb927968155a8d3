"""Version picks, top-k and contiguous ranks. Every order ends in a unique key (stable results)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = str | Column


def _order(cols: Sequence[Order]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def with_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Order], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(order))))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Order], k: int, name: str = "rank") -> DataFrame:
    """First k rows per key with their rank. Catalyst adds a partial WindowGroupLimit before the
    shuffle, so a hot key ships at most k rows per map task."""
    return with_row_number(df, keys, order, name).filter(F.col(name) <= k)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """One row per key: the first in the given order."""
    return top_k(df, keys, order, 1, "_latest").drop("_latest")


def min_list_length(df: DataFrame, keys: Sequence[str], rank: str, at_least: int) -> DataFrame:
    """Keep keys whose longest rank reaches ``at_least``."""
    best = F.max(rank).over(Window.partitionBy(*keys))
    return df.withColumn("_max_rank", best).filter(F.col("_max_rank") >= at_least).drop("_max_rank")


def rerank(df: DataFrame, keys: Sequence[str], by: Sequence[Order], name: str = "rank") -> DataFrame:
    """Close the gaps that filters left in a rank."""
    return with_row_number(df, keys, by, name)


def mode_value(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent value per key; ties go to the smaller value."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return latest(counts, keys, [F.desc("_n"), F.asc(value)]).drop("_n")


def percent_rank_of_known(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Percent rank among the non-null values of each key; null values get a null rank.

    Works on counts per distinct value and bucket of values, so no key is sorted in one task: the rank is
    the number of rows with smaller values, from the sizes of smaller buckets and of smaller values inside one.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    # signed power-of-two scale: ascending in the value, so rows of one bucket are neighbours
    size = F.floor(F.log2(F.abs(F.col(value)) + 1) * 16)
    counts = counts.withColumn("_bucket", F.when(F.col(value) < 0, -size - 1).otherwise(size))
    sizes = counts.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"), F.sum("_size").over(Window.partitionBy(*keys)).alias("_total"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    smaller = counts.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(offsets, [*keys, "_bucket"])
    rank = F.when(F.col("_total") > 1, (F.col("_offset") + F.col("_inside")) / (F.col("_total") - 1)).otherwise(F.lit(0.0))
    return df.join(smaller.select(*keys, value, rank.alias(name)), [*keys, value], "left").select(*df.columns, name)


def distributed_row_number(
    df: DataFrame, keys: Sequence[str], buckets: Sequence[Column], order: Sequence[Order], name: str, total: str
) -> DataFrame:
    """Exact row number (and row total) per key without sorting a key in one task.

    ``buckets`` are ascending functions of the order: rows sort by (buckets, order). Each bucket is
    numbered on its own; the bucket sizes, a small table, give its offset.
    """
    names = [f"_bucket{i}" for i in range(len(buckets))]
    rows = df.select("*", *[b.alias(n) for b, n in zip(buckets, names)])
    sizes = rows.groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("_size"))
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select(
        *keys, *names, (F.sum("_size").over(before) - F.col("_size")).alias("_offset"), F.sum("_size").over(by_key).alias(total)
    )
    local = F.row_number().over(Window.partitionBy(*keys, *names).orderBy(*_order(order)))
    numbered = rows.withColumn("_local", local).join(offsets, [*keys, *names])
    return numbered.withColumn(name, F.col("_offset") + F.col("_local")).drop("_local", "_offset", *names)


def ntile_of(row: Column, total: Column, tiles: int) -> Column:
    """Tile of a row number among ``total`` rows, with the remainder spread over the first tiles."""
    n = F.lit(tiles).cast("bigint")
    small = F.call_function("div", total, n)
    extra = total % n
    wide = extra * (small + 1)
    in_wide = F.call_function("div", row - 1, small + 1) + 1
    in_small = extra + F.call_function("div", row - wide - 1, F.nullif(small, F.lit(0))) + 1
    return F.when(row <= wide, in_wide).otherwise(in_small)
