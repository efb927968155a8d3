"""Statistics as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shrunk_mean(n: Column, mean: Column, prior_weight: Column, prior_mean: Column) -> Column:
    """Bayesian mean: the prior counts as ``prior_weight`` extra observations."""
    return (prior_weight * prior_mean + n * mean) / (prior_weight + n)


def quartile_label(percent_rank: Column) -> Column:
    """Four ordered labels over a percent rank; null stays null."""
    return (
        F.when(percent_rank.isNull(), F.lit(None).cast("string"))
        .when(percent_rank <= 0.25, "4_least")
        .when(percent_rank <= 0.5, "3_low")
        .when(percent_rank <= 0.75, "2_medium")
        .otherwise("1_high")
    )


def percent_hundredths(part: Column, whole: Column) -> Column:
    """``round(part / whole, 2) * 100`` for non-negative integers, in exact integer arithmetic."""
    return _div(part * 200 + whole, whole * 2)


def over_index_hundredths(segment: Column, base: Column) -> Column:
    """``round((segment / base - 1) * 100, 2) * 100`` on two percents given in hundredths; null on base 0."""
    gap = segment - base
    size = _div(F.abs(gap) * 20000 + base, F.nullif(base, F.lit(0)) * 2)
    return F.when(gap >= 0, size).otherwise(-size)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a.cast("bigint"), b.cast("bigint"))


def minor_to_major(minor: Column, digits: Column) -> Column:
    return minor / F.pow(F.lit(10.0), digits)
