"""Shared helpers of the query catalogue: rounding for comparison with the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinora.session import cut_lineage, cut_packed

# as_of 2001-08-02 less 15 months (bundles) and 24 months (bulk)
SINCE_BUNDLES = "2000-05-02"
SINCE_BULK = "1999-08-02"
# The given orders hold few pairs twice, so article rules start at one common order.
ITEM_MIN_COUNT = 1


def stage(fx, name, build, packed=False):
    """Build a stage that later steps read several times once per query, in reliable storage; packed where it holds many rows."""
    stages = fx.__dict__.setdefault("stages", {})
    if name not in stages:
        stages[name] = (cut_packed if packed else cut_lineage)(build(fx))
    return stages[name]


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round fractions, text for dates and times, bigint for whole numbers: comparable across engines."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        cols.append(c.alias(field.name))
    return df.select(*cols)
