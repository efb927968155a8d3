"""Text and map canonicalisation, hashing, dictionaries and sentence templates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_map(options: Column) -> Column:
    """Map as text with sorted keys: equal maps give equal text whatever their insertion order."""
    entries = F.array_sort(F.map_entries(options))
    pairs = F.transform(entries, lambda e: F.concat(F.lit('"'), e["key"], F.lit('": "'), F.coalesce(e["value"], F.lit("")), F.lit('"')))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def options_hash(options: Column) -> Column:
    return F.md5(canonical_map(options))


def canonical_list(text: Column, sep: str = "/") -> Column:
    return F.array_join(F.array_sort(F.split(text, sep)), sep)


def none_to_null(c: Column) -> Column:
    return F.when(~c.rlike("(?i)^none$"), c)


def translate_values(c: Column, table: dict[str, str | None]) -> Column:
    """Replace exact values by a small dictionary; a null target clears the value."""
    def quoted(x: str | None) -> str:
        return "cast(null as string)" if x is None else '"' + x.replace('"', '\\"') + '"'

    mapping = F.expr("map(" + ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in table.items()) + ")")
    return F.when(F.map_contains_key(mapping, c), F.try_element_at(mapping, c)).otherwise(c)


def sentence(template: str) -> Column:
    """Column of a template with ``{column}`` placeholders; null when a placeholder is null."""
    parts = [p for p in re.split(r"(\{\w+\})", template) if p]
    return F.concat(*[F.col(p[1:-1]) if p.startswith("{") else F.lit(p) for p in parts])


def compact_time(epoch: Column) -> Column:
    """10-digit seconds or 13-digit milliseconds as ``yyyyMMddHHmmss``; anything else raises."""
    digits = F.length(epoch.cast("string"))
    seconds = (
        F.when(digits == 13, F.timestamp_millis(epoch.cast("bigint"))).when(digits == 10, F.timestamp_seconds(epoch.cast("bigint")))
        .otherwise(F.raise_error(F.lit("epoch must have 10 or 13 digits")).cast("timestamp"))
    )
    return F.date_format(seconds, "yyyyMMddHHmmss")
