"""Lineage cuts in the shared checkpoint folder, and the tables of a run."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; one of our own only where none is named and the master is local."""
    context = spark.sparkContext
    path = context.getCheckpointDir()
    if path:
        return path
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="affinora-llm-")
    context.setCheckpointDir(path)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write a frame that later steps read more than once; a lost executor costs no recomputation of it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of an Arrow batch: with long texts a batch of Spark's default length takes hundreds of MB on both sides.
ARROW_ROWS = 1000


def bounded_batches(df: DataFrame) -> None:
    """Lets the session send rows to Python in batches of at most `ARROW_ROWS`; a smaller setting stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= ARROW_ROWS:
        conf.set(key, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
