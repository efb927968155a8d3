"""Catalog tables through Spark's own writer: read, overwrite, append, create once, evolve."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def write(df: DataFrame, name: str, mode: str = "append", partition_by: list[str] | None = None) -> None:
    """Append to a table or overwrite it as a whole, schema included. A table isn't written from a plan that reads it."""
    writer = df.write.mode(mode).format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def create_if_absent(df: DataFrame, name: str) -> bool:
    if df.sparkSession.catalog.tableExists(name):
        return False
    df.write.format("parquet").saveAsTable(name)
    return True


def add_columns(spark: SparkSession, name: str, like: DataFrame) -> None:
    """Additive schema evolution: columns of `like` that the table lacks."""
    have = {c.lower() for c in spark.table(name).columns}
    missing = [f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields if f.name.lower() not in have]
    if missing:
        spark.sql(f"alter table {name} add columns ({', '.join(missing)})")


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, mode: str = "overwrite") -> None:
    """A table bucketed and sorted by the keys: joins and groupings on them, or on more columns besides, read it without an exchange."""
    df.repartition(buckets, *keys).write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
