"""JSON payloads whose keys drift: read as variants, so that unknown keys and broken rows lose nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def opened(payload: DataFrame, body: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a variant column ``parsed``, reject rows): a text that is no JSON is rejected with its columns; null stays null."""
    parsed = payload.withColumn("parsed", F.try_parse_json(body))
    broken = F.col("parsed").isNull() & F.col(body).isNotNull()
    return parsed.filter(~broken), parsed.filter(broken).drop("parsed")


def fields(rows: DataFrame, types: dict[str, tuple[str, str]], variant: str = "parsed") -> DataFrame:
    """Columns by JSON path: name -> (path, type). A value of another type, or none, is null."""
    return rows.withColumns({name: F.try_variant_get(variant, path, kind) for name, (path, kind) in types.items()})


def key_profile(rows: DataFrame, known: list[str], variant: str = "parsed", path: str = "$") -> DataFrame:
    """(key, kind, n, known) of the fields that objects at a path hold: what a schema would have dropped."""
    view = rows.select(F.try_variant_get(variant, path, "variant").alias("v"))
    pairs = view.filter(F.schema_of_variant("v").startswith("OBJECT")).lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("v").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^([A-Z]+)", 1)
    return pairs.groupBy("key", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).withColumn("known", F.col("key").isin(known))
