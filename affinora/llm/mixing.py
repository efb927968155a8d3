"""A time-varying mix of sources: weights over training time, targets in words, and a training position for every document.

Sources have target words by weight: a share of all words (150%) is dealt out in proportion to the weights, no source above a
multiple of its own size (2), the excess going to the others by weight until none is above. That level is found in closed form: with the
sources in order of limit / weight, the first at which the level of the remaining ones stays under their own limits.

Within a source the documents stand in the order of a hash. The source is read whole as often as its target allows, and then once more
up to the exact word at which the target is met, which may lie inside a document. Running totals come from sums of hash
buckets, so that no source, however large, is summed or sorted in one task.

The weight of a source changes over training time along straight lines between knots (`SCHEDULES`); its integral is the source's
cumulative demand. A reading of a document starts after a known number of the source's words; the time at which demand
reaches the middle of the reading is its position, found by inverting the integral in its segment. Range-sorting by position gives the training order.

Defined results: a null, empty or wordless text has size 0 and is taken 0 times; a null source is a source of its own, last in order;
rows that repeat are separate documents; an empty table gives an empty mix. Reruns agree, as the hash is of doc_id.
Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, LIMIT = 1.5, 2


@dataclass(frozen=True)
class Schedule:
    """Relative weights at the knots 0 = t0 < t1 < ... = 1 of training time, straight in between; none below 0, not all 0."""

    knots: tuple[float, ...]
    weights: tuple[float, ...]

    def segments(self) -> list[tuple[float, float, float, float, float]]:
        """(start, length, weight at start, weight at end, share of the demand before it) of each segment."""
        areas = [(b - a) * (u + v) / 2 for a, b, u, v in zip(self.knots, self.knots[1:], self.weights, self.weights[1:])]
        total, done, out = sum(areas), 0.0, []
        for a, b, u, v, area in zip(self.knots, self.knots[1:], self.weights, self.weights[1:], areas):
            if area > 0:
                out.append((a, b - a, u / total, v / total, done / total))
                done += area
        return out

    def position(self, share: Column) -> Column:
        """The training time at which this share of the demand has been met."""
        out = None
        for a, length, u, v, before in reversed(self.segments()):
            area = share - F.lit(before)
            if u == v:
                at = F.lit(a) + area / u
            else:
                slope = (v - u) / length
                at = F.lit(a) + (F.sqrt(F.greatest(F.lit(0.0), F.lit(u * u) + 2 * slope * area)) - u) / slope
            out = at if out is None else F.when(share < following, at).otherwise(out)
            following = before
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), out))


#: For the sources of each weight in turn: falling, rising to a late peak, even.
SCHEDULES = (Schedule((0.0, 0.5, 1.0), (2.0, 1.0, 0.5)), Schedule((0.0, 0.7, 1.0), (0.25, 1.5, 1.0)), Schedule((0.0, 1.0), (1.0, 1.0)))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, kind, target) from (source, size); `kind` is the place of the weight in the cycle.

    One row per source passes the single-task windows here, whatever the number of documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    kind = (F.row_number().over(order) - 1) % len(weights)
    rows = totals.withColumn("kind", kind).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("kind") + 1))
    rows = rows.withColumn("cap", limit * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    rows = rows.withColumn("dealt", F.lit(share) * F.sum("source_size").over(everywhere))
    rows = rows.withColumn("level", (F.col("dealt") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward))
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everywhere)
    target = F.least(F.coalesce(level * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    return rows.select("source", "source_size", "kind", target.alias("target"))


def readings(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, size, source_size, target, taken, and `passes`, an array of (pass, words, position)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
    rows = rows.withColumn("place", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))).withColumn("bucket", F.substring("place", 1, 4))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(up_to), F.lit(0)).alias("bucket_start"))
    targets = source_targets(sums.select("source", F.col("words").alias("size")))
    plan = starts.join(targets.withColumnRenamed("source", "s2"), F.col("s").eqNullSafe(F.col("s2"))).drop("s2")
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    inside = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.col("bucket_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    left = F.floor(F.col("target")) - whole * F.col("source_size")
    rows = rows.withColumn("whole", whole).withColumn("more", F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("start"))).cast("long"))

    def reading(n: Column, words: Column) -> Column:
        share = (n * F.col("source_size") + F.col("start") + words / 2) / F.col("target")
        position = None
        for kind, schedule in enumerate(SCHEDULES):
            at = schedule.position(share)
            position = at if position is None else F.when(F.col("kind") == kind, at).otherwise(position)
        return F.struct(n.alias("pass"), words.alias("words"), position.alias("position"))

    full = F.transform(F.sequence(F.lit(1), F.lit(LIMIT)), lambda k: F.when(k <= F.col("whole"), reading(k - 1, F.col("size"))))
    last = F.array(F.when(F.col("more") > 0, reading(F.col("whole").cast("int"), F.col("more"))))
    passes = F.filter(F.concat(full, last), lambda p: p.isNotNull() & (p["words"] > 0))
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("more")).alias("taken"), passes.alias("passes"))


def curriculum(docs: DataFrame) -> DataFrame:
    """The training order: (doc_id, pass, words, position), range-sorted by position."""
    rows = readings(docs).select("doc_id", F.explode("passes").alias("p")).select("doc_id", "p.pass", "p.words", "p.position")
    return rows.orderBy("position", "doc_id", "pass")


def mixed(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, size, source_size, target, taken, position and last_position of its readings (null if none, equal
    if one; there are `LIMIT` = 2 at most), n_readings, in the order of the first."""
    at = lambda f: F.round(f("passes.position"), 6)
    out = readings(docs).select("doc_id", "size", "source_size", "target", "taken", at(F.array_min).alias("position"),
                                at(F.array_max).alias("last_position"), F.size("passes").cast("long").alias("n_readings"))
    return out.orderBy(F.col("position").asc_nulls_last(), "doc_id")
