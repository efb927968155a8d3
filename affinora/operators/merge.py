"""Table maintenance without a transactional format: upsert, scoped delete, change detection, sync."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinora.operators import ranking


def one_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """The first source row of each key in ``order``; without an order, a job that meets a repeated key fails."""
    if order is not None:
        return ranking.latest(source, keys, order)
    refused = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("several source rows share one merge key")).cast("boolean")).otherwise(F.lit(True))
    # An aggregate combines before the shuffle; every group comes back as its one row, or the job fails.
    rest = [c for c in source.columns if c not in keys]
    single = source.groupBy(*keys).agg(refused.alias("_single"), F.first(F.struct(*rest) if rest else F.lit(1)).alias("_row")).filter("_single")
    return single.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in source.columns])


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Target after MERGE: matched rows updated, new rows inserted. New source columns are added.

    With ``update_cols`` only those columns change on a match. Repeated source keys are refused, or reduced by ``order``.
    """
    keys = list(keys)
    source = one_per_key(source, keys, order)
    if update_cols is None:
        kept = target.join(source.select(*keys), keys, "left_anti")
        return kept.unionByName(source, allowMissingColumns=True)
    mark = source.withColumn("_in_source", F.lit(True)).alias("s")
    joined = target.withColumn("_in_target", F.lit(True)).alias("t").join(mark, keys, "full_outer")
    cols = []
    for c in dict.fromkeys([*target.columns, *source.columns]):
        if c in keys:
            cols.append(F.col(c))
        elif c not in source.columns:
            cols.append(F.col(f"t.{c}").alias(c))
        elif c not in target.columns:
            cols.append(F.col(f"s.{c}").alias(c))
        elif c in update_cols:
            cols.append(F.when(F.col("_in_source"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.when(F.col("_in_target"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return joined.select(*cols)


def delete_not_matched_by_source(target: DataFrame, source: DataFrame, keys: Sequence[str], scope: Column) -> DataFrame:
    """Remove target rows inside ``scope`` whose key is missing in the source."""
    outside = target.filter(~F.coalesce(scope, F.lit(False)))
    inside = target.filter(scope).join(source.select(*keys), list(keys), "left_semi")
    return outside.unionByName(inside)


def changed_rows(
    incoming: DataFrame, current: DataFrame, keys: Sequence[str], version: str, price: str,
    attributes: Sequence[str], price_tolerance: float = 0.05, full_refresh: bool = False,
) -> DataFrame:
    """Incoming rows that are new, changed version, moved price by the tolerance, or changed an attribute.

    A full refresh takes every incoming row, as ``refresh``.
    """
    if full_refresh:
        return incoming.withColumn("change", F.lit("refresh"))
    old = current.select(
        *keys, *[F.col(c).alias(f"_old_{c}") for c in (version, price, *attributes)], F.lit(True).alias("_known")
    )
    joined = incoming.join(old, list(keys), "left")
    is_new = F.col("_known").isNull()
    new_version = ~F.col(version).eqNullSafe(F.col(f"_old_{version}"))
    drift = F.abs(F.try_divide(F.col(price) - F.col(f"_old_{price}"), F.col(f"_old_{price}")))
    moved = F.coalesce(drift >= price_tolerance, F.col(price).isNotNull() & F.col(f"_old_{price}").isNull())
    differs = functools.reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in attributes], F.lit(False)
    )
    reason = (
        F.when(is_new, "new").when(new_version, "version").when(moved, "price").when(differs, "attribute")
    )
    return joined.withColumn("change", reason).filter(F.col("change").isNotNull()).select(*incoming.columns, "change")


def sync_changes(current_keys: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change set for a keyed store: ``delete`` keys that vanished, ``put`` every new row."""
    gone = current_keys.select(*keys).distinct().join(new.select(*keys), list(keys), "left_anti")
    return new.withColumn("op", F.lit("put")).unionByName(gone.withColumn("op", F.lit("delete")), allowMissingColumns=True)


def apply_changes(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    kept = current.join(changes.select(*keys), list(keys), "left_anti")
    return kept.unionByName(changes.filter("op = 'put'").drop("op"))


def retain_since(df: DataFrame, column: str, as_of: str, months: int = 13) -> DataFrame:
    """Drop rows older than ``months`` before ``as_of``."""
    return df.filter(F.col(column) >= F.add_months(F.lit(as_of).cast("date"), -months))


def lower_case_columns(df: DataFrame) -> DataFrame:
    """All column names in lower case; names that only differ in case are refused."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"columns differ only in case: {df.columns}")
    return df.toDF(*names)
