"""Connected components of a link table: union-find within partitions, then star contraction across them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinora.llm.cut import cut
from affinora.llm.text import in_batches

_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root and x != root:
            parent[x] = root
            x = up
        return root

    def union(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.parent[b] = a
        self.parent.setdefault(a, a)
        return True

    def edges(self) -> Iterator[tuple[int, int]]:
        for x in list(self.parent):
            root = self.find(x)
            if root != x:
                yield x, root


#: Nodes that one forest holds before it is handed on; more links of the partition start another one.
FOREST_NODES = 500_000


def _forests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.union(a, b)
        if len(forest.parent) > FOREST_NODES:
            yield from in_batches(forest.edges(), _EDGE)
            forest = Forest()
    yield from in_batches(forest.edges(), _EDGE)


def _downward(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    `edges` has long columns a and b; direction, repeats and loops don't matter, nulls are ignored. Each round hooks the
    neighbours of a node to the smallest of them (first those above it, then those below), which halves the depth of what
    is left; all steps are aggregates with map-side combine and equi-joins on the node, so that a hub is split by AQE.
    Rounds end when only stars are left.
    """
    clean = edges.select("a", "b").dropna()
    state = cut(_downward(clean.mapInArrow(_forests, "a long, b long")))
    if state.isEmpty():
        return state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    while True:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        state = cut(_downward(small.unionByName(low.select("a", F.col("low").alias("b")))))
        if _stars(state):
            break
    roots = state.select("b").distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component")))


def _stars(state: DataFrame) -> bool:
    """Whether each hooked node has one link only and hangs on a root."""
    up = state.select("a", F.lit(1).alias("hooked"), F.lit(0).alias("root"))
    down = state.select(F.col("b").alias("a"), F.lit(0).alias("hooked"), F.lit(1).alias("root"))
    per_node = up.unionByName(down).groupBy("a").agg(F.sum("hooked").alias("hooked"), F.max("root").alias("root"))
    return per_node.filter("hooked > 1 or hooked = 1 and root = 1").isEmpty()
