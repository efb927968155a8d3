"""Event monitoring and ingestion. The frame functions take batch and streaming input alike."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EVENT_KEY = ["user_id", "item_id", "ts", "page_section"]


def events_per_window(events: DataFrame, width: str, keys: list[str], watermark: str | None = None) -> DataFrame:
    """Event counts per tumbling window and key."""
    rows = events.withWatermark("ts", watermark) if watermark else events
    counts = rows.groupBy(F.window("ts", width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("events"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "events")


def hourly_item_counts(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return events.groupBy(F.date_trunc("hour", "ts").alias("hour"), *(keys or ["item_id"])).agg(F.count(F.lit(1)).alias("events"))


def idle_windows(events: DataFrame, seconds: int, keys: list[str], start: str, end: str, watched: DataFrame) -> DataFrame:
    """Windows of the range without any event, per key of ``watched``; a key without events is idle throughout.

    Gaps come from the neighbouring non-empty windows of a key, so no key x window grid is built and
    an always-busy key costs nothing. Merged back to single windows by a sequence over each gap.
    """
    first = F.unix_seconds(F.lit(start).cast("timestamp"))
    last = F.unix_seconds(F.lit(end).cast("timestamp"))
    slot = F.call_function("div", F.unix_seconds(F.col("ts").cast("timestamp")) - first, F.lit(seconds).cast("bigint"))
    slots = F.call_function("div", last - first, F.lit(seconds).cast("bigint"))
    inside = (F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp"))
    busy = events.filter(inside).select(*keys, slot.alias("_slot")).distinct().join(watched.select(*keys).distinct(), keys, "left_semi")
    by_key = Window.partitionBy(*keys).orderBy("_slot")
    previous = F.coalesce(F.lag("_slot").over(by_key), F.lit(-1).cast("bigint"))
    following = F.lead("_slot").over(by_key)
    marked = busy.select(*keys, "_slot", previous.alias("_prev"), following.isNull().alias("_is_last"))
    before = marked.filter("_slot - _prev > 1").select(*keys, (F.col("_prev") + 1).alias("_from"), (F.col("_slot") - 1).alias("_to"))
    after = marked.filter(F.col("_is_last") & (F.col("_slot") < slots - 1)).select(
        *keys, (F.col("_slot") + 1).alias("_from"), (slots - 1).alias("_to")
    )
    silent = watched.select(*keys).distinct().join(busy.select(*keys), keys, "left_anti")
    never = silent.select(*keys, F.lit(0).cast("bigint").alias("_from"), (slots - 1).alias("_to"))
    gaps = before.unionByName(after).unionByName(never).select(*keys, F.explode(F.sequence("_from", "_to")).alias("_slot"))
    return gaps.select(*keys, F.timestamp_seconds(first + F.col("_slot") * seconds).alias("window_start"))


def normalise_events(events: DataFrame) -> DataFrame:
    """Raw tracker events as (user_id, item_id, ts, page_section, locale, event_type)."""
    section = F.col("page_section")
    kind = (
        F.when((F.col("event_type") == "productView") & (section == "Configure - Recommendation"), "addToCart")
        .when((F.col("event_type") == "productView") & section.isin("Gallery", "Studio"), "click")
        .otherwise(F.col("event_type"))
    )
    return events.filter("user_id is not null and user_id not like '%@%'").select(
        "user_id", F.col("item").cast("string").alias("item_id"), "ts", "page_section", F.col("country").alias("locale"), kind.alias("event_type")
    )


def stream_interactions(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Normalised interactions, each (user, item, time, section) once; late repeats are dropped by the watermark."""
    rows = normalise_events(events)
    if rows.isStreaming:
        return rows.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(EVENT_KEY)
    return rows.dropDuplicates(EVENT_KEY)


def read_event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def write_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append"):
    """Process all available input once into a parquet folder; restart-safe through its checkpoint."""
    query = df.writeStream.format("parquet").outputMode(mode).option("path", out).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def with_state_store(spark: SparkSession) -> None:
    """The state store that holds timers and map states on disk, with its change log in the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def run_available(stream: DataFrame, out: str, checkpoint: str) -> int:
    """Process what is there and stop; the number of input rows that came behind the watermark and were dropped."""
    query = write_available(stream, out, checkpoint)
    query.awaitTermination()
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def replay(slices: Iterable[DataFrame], build: Callable[[DataFrame], DataFrame], folder: str) -> tuple[DataFrame, int]:
    """What a stream query writes when event slices arrive one by one, and how many rows it dropped as late.

    Each slice is appended to the source folder, then the query starts anew from its checkpoint, takes what is new and stops: offsets,
    watermark and state outlive every restart.
    """
    late = 0
    for part in slices:
        part.write.mode("append").parquet(f"{folder}/events")
        spark = part.sparkSession
        late += run_available(build(read_event_stream(spark, f"{folder}/events", part.schema, 1_000_000)), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out"), late
