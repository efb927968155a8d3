"""CSV snapshots of datasets, in two eras of folder layout; only finished ones (with ``_SUCCESS``) are read.

Older: ``root/<group>/<dataset>/<yyyyMMddHHmmss>/``, a group of regions to a folder. Newer: ``root/<dataset>/region=<region>/snapshot=<stamp>/``.
Either is read as one frame over one scan: the newer through partition discovery, so that region and snapshot filters prune folders,
the older by its finished folders, with region and snapshot taken from the path of each row's file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, root: str, group: str, dataset: str, stamp: str, parts: int = 10) -> str:
    """Export as ``parts`` CSV files. Rows spread by their hash, so a rerun writes the same split."""
    path = f"{root}/{group}/{dataset}/{stamp}"
    df.repartition(parts, F.xxhash64(*df.columns)).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_regional_snapshot(df: DataFrame, root: str, dataset: str, region: str, stamp: str, parts: int = 10) -> str:
    """The same in the newer layout."""
    path = f"{root}/{dataset}/region={region}/snapshot={stamp}"
    df.repartition(parts, F.xxhash64(*df.columns)).write.mode("overwrite").option("header", True).csv(path)
    return path


def _finished(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match the glob and hold ``_SUCCESS``; a half-written one has none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().getParent().toString() for s in found or [])


def snapshot_stamps(spark: SparkSession, root: str, group: str, dataset: str, cutoff: str | None = None) -> list[str]:
    """Names of finished snapshots, newest first, before the cutoff. Lists folders only."""
    names = [p.rsplit("/", 1)[1] for p in _finished(spark, f"{root}/{group}/{dataset}/*")]
    return sorted((n for n in names if cutoff is None or n < cutoff), reverse=True)


def _read(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(paths)


def _empty(spark: SparkSession, schema: str, *names: str) -> DataFrame:
    return spark.createDataFrame([], schema).withColumns({n: F.lit(None).cast("string") for n in names})


def _from_path(pattern: str) -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def read_latest(
    spark: SparkSession, root: str, group: str, dataset: str, schema: str, top_k: int = 1, cutoff: str | None = None
) -> DataFrame:
    """The newest ``top_k`` snapshots as one frame, tagged with their name; empty when there is none."""
    stamps = snapshot_stamps(spark, root, group, dataset, cutoff)[:top_k]
    if not stamps:
        return _empty(spark, schema, "snapshot")
    frame = _read(spark, [f"{root}/{group}/{dataset}/{s}" for s in stamps], schema)
    return frame.select("*", _from_path(r"/(\d{14})/[^/]+$").alias("snapshot"))


def read_range(
    spark: SparkSession, root: str, groups: dict[str, str], dataset: str, schema: str, start: str, end: str
) -> DataFrame:
    """Older layout: snapshots of a time range for several regions (region -> group), tagged with region and snapshot.

    One scan over all folders. Regions that share a group each get its rows.
    """
    paths = [f"{root}/{g}/{dataset}/{s}" for g in sorted(set(groups.values())) for s in snapshot_stamps(spark, root, g, dataset) if start <= s <= end]
    if not paths:
        return _empty(spark, schema, "region", "snapshot")
    frame = _read(spark, paths, schema)
    tagged = frame.select("*", _from_path(r"/([^/]+)/[^/]+/\d{14}/[^/]+$").alias("_group"), _from_path(r"/(\d{14})/[^/]+$").alias("snapshot"))
    of_group: dict[str, list[str]] = {}
    for region, group in sorted(groups.items()):
        of_group.setdefault(group, []).append(region)
    regions = F.create_map(*[x for g, rs in of_group.items() for x in (F.lit(g), F.array(*map(F.lit, rs)))])
    return tagged.withColumn("region", F.explode(regions[F.col("_group")])).select(*frame.columns, "region", "snapshot")


def read_regional(spark: SparkSession, root: str, dataset: str, schema: str, regions: list[str], start: str, end: str) -> DataFrame:
    """Newer layout: region and snapshot are partition columns, and the filters on them prune the scan; half-written snapshots stay out."""
    base = f"{root}/{dataset}"
    done = [tuple(part.split("=", 1)[1] for part in p.rsplit("/", 2)[1:]) for p in _finished(spark, f"{base}/region=*/snapshot=*")]
    done = [(r, s) for r, s in done if r in regions and start <= s <= end]
    if not done:
        return _empty(spark, schema, "region", "snapshot")
    frame = spark.read.option("header", True).schema(f"{schema}, region string, snapshot string").csv(base)
    per_region: dict[str, list[str]] = {}
    for r, s in done:
        per_region.setdefault(r, []).append(s)
    wanted = F.lit(False)
    for r, stamps in per_region.items():
        wanted = wanted | ((F.col("region") == r) & F.col("snapshot").isin(stamps))
    return frame.filter(wanted)


def read_eras(
    spark: SparkSession, root: str, groups: dict[str, str], dataset: str, schema: str, start: str, end: str, changed: str
) -> DataFrame:
    """A time range across the change of layout: snapshots before ``changed`` in the older one, from it on in the newer one."""
    newer = read_regional(spark, root, dataset, schema, sorted(groups), max(start, changed), end)
    if start >= changed:
        return newer
    older = read_range(spark, root, groups, dataset, schema, start, end)
    return older.filter(F.col("snapshot") < changed).unionByName(newer)
