"""Parquet folders partitioned by key columns: upsert, delete and retention that rewrite touched partitions only.

New rows are staged in the checkpoint folder before a partition is replaced, since they derive from it. Spark's dynamic partition
overwrite moves whole partitions when the job commits; files of other partitions keep their names and times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinora.operators import merge
from affinora.session import cut_lineage


def create(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """A new folder; rows of a partition are written by one task each, or by several where AQE splits a large one."""
    df.repartition(*partition_by).write.partitionBy(*partition_by).parquet(path)


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return on


def _touched(target: DataFrame, values: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Target rows of the named partitions: the join prunes the scan to them at run time."""
    return target.alias("t").join(values.alias("v"), _same("t", "v", partition_by), "left_semi")


def _replace(path: str, rows: DataFrame, values: DataFrame, partition_by: Sequence[str]) -> int:
    """Put staged rows in place of the named partitions; the number of partitions that are empty now and so are removed."""
    spark = rows.sparkSession
    old = spark.read.parquet(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]+$", 1)
    emptied = values.alias("v").join(rows.select(*partition_by).distinct().alias("r"), _same("v", "r", partition_by), "left_anti")
    # One path for each emptied partition, not for each row.
    gone = [r[0] for r in _touched(old.select(*partition_by, folder.alias("folder")), emptied, partition_by).select("folder").distinct().collect()]
    rows.repartition(*partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    for name in gone:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(gone)


def upsert(path: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str], update_cols: Sequence[str] | None = None, order: Sequence[str | Column] | None = None) -> None:
    """MERGE into the folder: reads and rewrites only partitions that hold source keys. Partition columns belong to the keys, so no row moves."""
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be keys, or a row could change its partition")
    source = cut_lineage(source)
    values = source.select(*partition_by).distinct()
    target = _touched(source.sparkSession.read.parquet(path), values, partition_by)
    merged = cut_lineage(merge.merge_upsert(target, source, keys, update_cols, order))
    _replace(path, merged, values, partition_by)


def delete_not_matched_by_source(path: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str], scope: Column) -> int:
    """Remove rows inside `scope` whose key the source lacks; only partitions that lose a row are rewritten. Number of emptied partitions."""
    target = source.sparkSession.read.parquet(path)
    lost = target.filter(scope).join(source.select(*keys), list(keys), "left_anti")
    values = cut_lineage(lost.select(*partition_by).distinct())
    kept = cut_lineage(merge.delete_not_matched_by_source(_touched(target, values, partition_by), source, keys, scope))
    return _replace(path, kept, values, partition_by)


def retain(spark: SparkSession, path: str, partition_by: Sequence[str], keep: Column) -> int:
    """Remove rows that fail `keep`; only partitions that hold one are rewritten. Number of emptied partitions."""
    target = spark.read.parquet(path)
    values = cut_lineage(target.filter(~F.coalesce(keep, F.lit(False))).select(*partition_by).distinct())
    return _replace(path, cut_lineage(_touched(target, values, partition_by).filter(keep)), values, partition_by)
