"""Ordered lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_array(order: str | Column, value: str | Column) -> Column:
    """Aggregate: values as an array in ascending order of ``order``."""
    o = F.col(order) if isinstance(order, str) else order
    v = F.col(value) if isinstance(value, str) else value
    packed = F.array_sort(F.collect_list(F.struct(o.alias("o"), v.alias("v"))))
    return F.transform(packed, lambda x: x["v"])


def ordered_text(order: str | Column, value: str | Column, sep: str = ",") -> Column:
    """Aggregate: values as one text in ascending order of ``order``."""
    return F.array_join(F.transform(ordered_array(order, value), lambda x: x.cast("string")), sep)
