"""Data-quality checks. A check returns its violations as a DataFrame; ``require_empty`` raises."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A check found violations."""


def require_empty(violations: DataFrame, message: str) -> None:
    sample = violations.limit(5).collect()
    if sample:
        raise QualityError(f"{message}: {[r.asDict() for r in sample]}")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def _long(df: DataFrame, values: dict[str, Column], name: str = "column_name", value: str = "n") -> DataFrame:
    """One aggregate row turned into (name, value) rows."""
    one = df.agg(*[v.alias(k) for k, v in values.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias(name), F.col(f"`{k}`").alias(value)) for k in values])
    return one.select(F.explode(pairs).alias("p")).select("p.*")


def is_missing(column: str) -> Column:
    return F.col(column).isNull() | (F.length(F.col(column).cast("string")) < 1)


def null_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns holding nulls, with their null count; all columns in one pass."""
    return _long(df, {c: F.count_if(F.col(c).isNull()) for c in columns}).filter("n > 0")


def all_null_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _long(df, {c: F.count(F.col(c)) for c in columns}).filter("n = 0").drop("n")


def outside_domain(df: DataFrame, column: str, allowed: Sequence, nulls_allowed: bool = True) -> DataFrame:
    """Values outside the allowed set with their row count."""
    bad = ~F.col(column).isin(list(allowed))
    bad = F.coalesce(bad, F.lit(not nulls_allowed))
    return df.filter(bad).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def domain_difference(df: DataFrame, column: str, expected: Sequence) -> DataFrame:
    """Values that are unexpected or expected but absent; empty when the domain is exact."""
    kind = df.schema[column].dataType
    want = df.sparkSession.createDataFrame([(v,) for v in expected], f"value {kind.simpleString()}")
    have = df.select(F.col(column).alias("value")).distinct()
    extra = have.join(F.broadcast(want), have["value"].eqNullSafe(want["value"]), "left_anti")
    absent = want.join(have, "value", "left_anti")
    return extra.select("value", F.lit("unexpected").alias("problem")).unionByName(
        absent.select("value", F.lit("absent").alias("problem"))
    )


def negatives(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def count_drift(current: DataFrame, previous: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """One row when the row count moved by more than the tolerance."""
    both = current.select(F.lit(1).alias("c"), F.lit(0).alias("p")).unionAll(previous.select(F.lit(0), F.lit(1)))
    sums = both.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("current_rows"), F.coalesce(F.sum("p"), F.lit(0)).alias("previous_rows"))
    change = F.try_divide(F.abs(F.col("current_rows") - F.col("previous_rows")), F.col("previous_rows"))
    return sums.withColumn("change", change).filter(F.col("change") > tolerance)


def group_drift(current: DataFrame, previous: DataFrame, key: str, value: str, tolerance: float = 0.1) -> DataFrame:
    """Groups present in both whose value moved by more than the tolerance."""
    old = previous.select(key, F.col(value).alias("old_value"))
    new = current.select(key, F.col(value).alias("new_value"))
    change = F.try_divide(F.col("new_value") - F.col("old_value"), F.col("old_value"))
    return new.join(old, key).withColumn("change", change).filter(F.abs("change") > tolerance)


def null_ratio_above(df: DataFrame, column: str, tolerance: float = 0.05) -> DataFrame:
    facts = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(column).isNull()).alias("nulls"))
    ratio = F.round(F.try_divide(F.col("nulls"), F.col("rows")), 2)
    return facts.withColumn("null_ratio", ratio).filter(F.col("null_ratio") > tolerance)


def cardinality(df: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Columns whose number of distinct values is not the expected one."""
    facts = _long(df, {c: F.countDistinct(c) for c in expected}, value="found")
    want = F.create_map(*[x for c, n in expected.items() for x in (F.lit(c), F.lit(n).cast("bigint"))])
    return facts.withColumn("expected", want[F.col("column_name")]).filter("found <> expected")


def missing_flags(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[is_missing(c).cast("int").alias(f"{c}_missing") for c in features])


def newly_missing(history: DataFrame, latest: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(key, feature) present in the history and missing now; one join for all features."""
    flags = [f"{c}_missing" for c in features]
    old = history.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in flags])
    joined = latest.join(old, list(keys))
    hits = F.array_compact(F.array(*[
        F.when((F.col(f"_old_{f}_missing") == 0) & (F.col(f"{f}_missing") == 1), F.lit(f)) for f in features
    ]))
    return joined.select(*keys, F.explode(hits).alias("feature"), F.lit(1).alias("is_missing"))


def undefined_values(df: DataFrame, vocabulary: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Observed attribute values that the vocabulary (attribute, value) does not define."""
    pairs = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])
    seen = df.select(F.explode(pairs).alias("p")).select("p.*").filter("value is not null").distinct()
    known = vocabulary.select("attribute", "value").distinct()
    return seen.withColumn("_v", F.upper("value")).join(
        known.withColumnRenamed("value", "_v"), ["attribute", "_v"], "left_anti"
    ).select("attribute", "value")


def null_profile(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(is_missing(c)).alias(f"{c}_missing") for c in columns]
    )


def rows_with_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(functools.reduce(lambda a, b: a | b, [is_missing(c) for c in columns]))


def observed_checks(nulls: Sequence[str] = (), domains: dict[str, Sequence] | None = None, non_negative: Sequence[str] = ()) -> dict[str, Column]:
    """Aggregates that count violations by name (``kind:column``), and all rows; fit for an Observation: no shuffle, one pass."""
    out = {"rows:": F.count(F.lit(1))}
    out |= {f"null:{c}": F.count_if(is_missing(c)) for c in nulls}
    out |= {f"domain:{c}": F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(v))) for c, v in (domains or {}).items()}
    return out | {f"negative:{c}": F.count_if(F.col(c) < 0) for c in non_negative}


def write_observed(df: DataFrame, path: str, checks: dict[str, Column], previous_rows: int | None = None, drift: float = 0.05) -> DataFrame:
    """Write the frame as Parquet and return what its checks found, as (check, column_name, n, failed), without reading anything twice.

    The counts ride on the write as Observation metrics. The row count fails where it left ``previous_rows`` by more than
    ``drift``; a written file whose checks fail is the caller's to discard.
    """
    seen = Observation()
    df.observe(seen, *[v.alias(k) for k, v in checks.items()]).write.mode("overwrite").parquet(path)
    found = seen.get
    rows = []
    for name, n in found.items():
        kind, column = name.split(":", 1)
        failed = n > 0 if kind != "rows" else bool(previous_rows) and abs(n - previous_rows) / previous_rows > drift
        rows.append((kind, column, int(n), failed))
    return df.sparkSession.createDataFrame(rows, "check string, column_name string, n long, failed boolean")
