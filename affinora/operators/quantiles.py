"""Exact quantiles of groups by selection: no group's values meet in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_bucket(value: str):
    """Ascending in the value: sixteen buckets for each doubling of 1 + its size, on both sides of zero."""
    size = F.floor(F.log2(F.abs(F.col(value)) + 1) * 16)
    return F.when(F.col(value) < 0, -size - 1).otherwise(size)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """One row for each group with a known value: its quantiles (name -> share), interpolated between neighbouring ranks.

    Equal values combine map-side. Counts per bucket of values tell which bucket holds a wanted rank; only these buckets are kept, and
    ranks are counted inside them, each in a task of its own.
    """
    keys = list(keys)
    counts = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_value")).groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_bucket", value_bucket("_value"))
    sizes = counts.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_size"))
    upto = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sizes.withColumn("_end", F.sum("_size").over(upto)).withColumn("_total", F.sum("_size").over(Window.partitionBy(*keys)))
    ranks = F.array(*[F.struct(F.lit(k).alias("k"), ((F.col("_total") - 1) * F.lit(q)).alias("at")) for k, q in enumerate(quantiles.values())])
    wanted = placed.withColumn("_q", F.explode(ranks)).select(
        *keys, "_bucket", (F.col("_end") - F.col("_size")).alias("_start"), F.col("_q.k").alias("_k"), F.col("_q.at").alias("_at"), "_end")
    low, high = F.floor("_at"), F.ceil("_at")
    wanted = wanted.filter((high >= F.col("_start")) & (low < F.col("_end"))).drop("_end")
    asked = wanted.groupBy(*keys, "_bucket").agg(F.first("_start").alias("_start"), F.collect_list(F.struct("_k", "_at")).alias("_asked"))
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]
    on = F.col("c._bucket") == F.col("a._bucket")
    for k in same:
        on = on & k
    inside = counts.alias("c").join(asked.alias("a"), on).select(*[F.col(f"c.{k}") for k in keys], "c._bucket", "_value", "_n", "_start", "_asked")
    within = Window.partitionBy(*keys, "_bucket").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_end", F.col("_start") + F.sum("_n").over(within)).withColumn("_first", F.col("_end") - F.col("_n"))
    hits = inside.select(*keys, "_value", "_first", "_end", F.explode("_asked").alias("_q")).select(
        *keys, F.col("_q._k").alias("_k"), F.col("_q._at").alias("_at"),
        F.when((F.floor("_q._at") >= F.col("_first")) & (F.floor("_q._at") < F.col("_end")), F.col("_value")).alias("_low"),
        F.when((F.ceil("_q._at") >= F.col("_first")) & (F.ceil("_q._at") < F.col("_end")), F.col("_value")).alias("_high"))
    out = []
    for k, name in enumerate(quantiles):
        mine = F.col("_k") == k
        a, b, at = F.max(F.when(mine, F.col("_low"))), F.max(F.when(mine, F.col("_high"))), F.max(F.when(mine, F.col("_at")))
        out.append(F.when(a == b, a).otherwise((F.ceil(at) - at) * a + (at - F.floor(at)) * b).alias(name))
    return hits.filter("_low is not null or _high is not null").groupBy(*keys).agg(*out)


def with_quantiles(groups: DataFrame, rows: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """The groups with quantiles of the rows' value; null where a group has no known value. Null keys are keys."""
    found = exact_quantiles(rows, keys, value, quantiles).alias("f")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"g.{k}").eqNullSafe(F.col(f"f.{k}"))
    return groups.alias("g").join(found, on, "left").select("g.*", *[F.col(f"f.{name}") for name in quantiles])
