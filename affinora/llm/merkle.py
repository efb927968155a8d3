"""Merkle manifest of a dataset: a content-addressed DAG of digests, descended from the root for proofs.

Leaves are digests of rows. Per group (a source) the leaves stand in order; runs of `FAN` consecutive nodes become one
parent, level by level, until one node remains. These subroots, ordered by group, are the leaves of the top tree, whose last
node is the root. The store holds one record for each inner node: its digest and the digests of its children.

A proof is found by descent. Requests start together at the root and follow the digits of their rank (base `FAN`, highest
first). At each node a request looks up the record of its digest, collects the children it does not select, as
the text left and right of the selected one, and goes on with that child. The collected segments, reversed, lead from the leaf to
the root. Requests that share a node descend as one row, so a level is a join of unique digests on both sides and no hot key
exists; they part at the last level, where leaves meet their parent's request and hash their proofs at once, so that proofs of
single leaves are never shuffled.

Ranks come from a range sort: a partition's rows are numbered by their place and shifted by counts of the partitions before,
so that no group is numbered in one task. All steps are built-in expressions.

Defined results: null fields are `-` in a leaf, an empty text is `0:`; a null group is a group of its own and sorts first;
null doc_ids sort first within their group and rows that repeat a doc_id sort by leaf, so equal rows are equal leaves side by
side. A table without rows gives no rows. Other columns are not read.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinora.llm.cut import cut

FAN = 16
_BITS = 4
#: monotonically_increasing_id holds the partition above this many bits.
_PART_BITS = 33
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, `:` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """Digest of a row of documents with the given text."""
    doc_id, n_chars = F.col("doc_id").cast("long"), F.col("n_chars").cast("long")
    return digest(*map(framed, (doc_id, F.col("source"), F.col("lang"), n_chars, text)))


def tampered_text() -> Column:
    """The text as a forger leaves it: one in five documents has A-Z in lower case."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return F.when(hit, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))


def placed(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Range-sorted rows with their place `_at`; where each partition's part of a group begins and how many rows lie before; group sizes.

    The rank of a row in its group is `_at - _first + _before`.
    """
    sorted_rows = cut(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id()))
    sorted_rows = sorted_rows.withColumn("_part", F.shiftright("_at", _PART_BITS))
    # One row for each partition and group that meet: at most partitions plus groups.
    parts = cut(sorted_rows.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n")))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("_part", group, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return sorted_rows, before, parts.groupBy(group).agg(F.sum("_n").alias("_n"))


def _renamed(info: DataFrame, **names: str) -> DataFrame:
    return info.select(*[F.col(c).alias(names.get(c, c)) for c in info.columns])


def _height(n: Column) -> Column:
    """Levels above n leaves: how often n is divided by FAN, rounded up, until 1 is left."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.ceil(F.length(F.conv((n - 1).cast("string"), 10, 2)) / _BITS).cast("int"))


def _levels(leaves: DataFrame) -> tuple[dict[int, DataFrame], DataFrame]:
    """(records by level, roots) of trees whose leaves are (tree, height, rank, digest): records have node and children, roots tree and node."""
    highest = leaves.agg(F.max("height")).first()[0] or 0
    records = {}
    roots = leaves.filter("height = 0").select("tree", F.col("digest").alias("node"))
    nodes = leaves.filter("height > 0")
    for level in range(1, highest + 1):
        runs = nodes.groupBy("tree", "height", F.shiftright("rank", _BITS).alias("up")).agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("run"))
        children = F.col("run.digest")
        built = cut(runs.select("tree", "height", F.col("up").alias("rank"), F.sha2(F.array_join(children, "").cast("binary"), 256).alias("node"), children.alias("children")))
        records[level] = built.select("node", "children").dropDuplicates(["node"])
        roots = roots.unionByName(built.filter(F.col("height") == level).select("tree", "node"))
        nodes = built.filter(F.col("height") > level).select("tree", "height", "rank", F.col("node").alias("digest"))
    return records, roots


@dataclasses.dataclass
class Manifest:
    """A dataset's tree.

    leaves: doc_id, source, tree, height, rank, leaf and the columns kept; groups: source, tree, height, subroot. The store:
    records and top_records hold, for each level, node (a digest) and children. root is null for a dataset without rows.
    """

    leaves: DataFrame
    groups: DataFrame
    records: dict[int, DataFrame]
    top_records: dict[int, DataFrame]
    root: str | None

    def store(self) -> DataFrame:
        """All records as one content-addressed table."""
        frames = [*self.records.values(), *self.top_records.values()]
        whole = self.groups.limit(0).select(F.col("subroot").alias("node"), F.array("subroot").alias("children"))
        for frame in frames:
            whole = whole.unionByName(frame)
        return whole.dropDuplicates(["node"])


def build(docs: DataFrame, keep: dict[str, Column] | None = None) -> Manifest:
    """The manifest of documents; `keep` names further columns of its leaves."""
    rows = cut(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf(F.col("text")).alias("leaf"), *[c.alias(k) for k, c in (keep or {}).items()]))
    leaves, before, sizes = placed(rows, "source", ["doc_id", "leaf"])
    groups, group_before, _ = placed(sizes.withColumn("_all", F.lit(0)), "_all", ["source"])
    at = F.col("_at") - F.col("_first") + F.col("_before")
    groups = cut(groups.join(group_before.drop("_all"), "_part").select("source", at.alias("tree"), _height(F.col("_n")).alias("height")))
    # What a partition must know of its groups: small, so that the leaves join by partition and group and no source is a hot key.
    info = _renamed(before, _part="_p", source="_s").join(_renamed(groups, source="_g"), F.col("_s").eqNullSafe(F.col("_g"))).drop("_g")
    leaves = leaves.join(info, (F.col("_part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s"))).withColumn("rank", at)
    leaves = cut(leaves.drop("_at", "_part", "_p", "_s", "_first", "_before"))
    records, subroots = _levels(leaves.select("tree", "height", "rank", F.col("leaf").alias("digest")))
    groups = cut(groups.join(subroots.withColumnRenamed("node", "subroot"), "tree"))
    top = groups.agg(_height(F.count("*"))).first()[0]
    top_records, root = _levels(groups.select(F.lit(0).alias("tree"), F.lit(top).alias("height"), F.col("tree").alias("rank"), F.col("subroot").alias("digest")))
    first = root.first()
    return Manifest(leaves, groups, records, top_records, first["node"] if first else None)


def _selected(children: Column, digit: Column) -> Column:
    """The path segment of a child: the digests left and right of it."""
    return F.struct(
        F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"), F.array_join(F.slice(children, digit + 2, F.lit(FAN)), "").alias("right"))


def _step(state: DataFrame, records: DataFrame) -> DataFrame:
    """Requests (tree, rank, node, path) one level further down: one for each child of their nodes."""
    opened = state.join(records, "node").select("tree", "rank", "path", "children", F.posexplode("children").alias("digit", "child"))
    return opened.select(
        "tree", (F.col("rank") * FAN + F.col("digit")).alias("rank"), F.col("child").alias("node"),
        F.concat("path", F.array(_selected(F.col("children"), F.col("digit")))).alias("path"))


def _wanted(state: DataFrame, requests: DataFrame | None, level: int) -> DataFrame:
    """Requests that have a leaf below them."""
    if requests is None:
        return state
    return state.join(requests.select("tree", F.shiftright("rank", _BITS * level).alias("rank")).distinct(), ["tree", "rank"], "left_semi")


def with_paths(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The leaves (or `requests`, some of their rows) with `path`, the segments from the root down, and `subroot`."""
    leaves = manifest.leaves if requests is None else requests
    spark = manifest.groups.sparkSession
    state = spark.createDataFrame([(0, 0, manifest.root, [])], f"tree long, rank long, node string, path {_PATH}") if manifest.root else (
        manifest.groups.select("tree", F.col("tree").alias("rank"), F.col("subroot").alias("node"), F.array().cast(_PATH).alias("path")))
    for level in range(len(manifest.top_records), 0, -1):
        state = _step(state, manifest.top_records[level])
    starts = cut(state.select(F.col("rank").alias("tree"), F.lit(0).cast("long").alias("rank"), "node", "path").join(manifest.groups.select("tree", "height"), "tree"))
    names = ["tree", "rank", "node", "path"]
    state = None
    for level in range(len(manifest.records), 0, -1):
        entering = _wanted(starts.filter(F.col("height") == level).select(names), requests, level)
        state = entering if state is None else _wanted(state, requests, level).unionByName(entering)
        if level > 1:
            state = _step(state, manifest.records[level])
    # The last step opens nodes beside their leaves: paths of single leaves never travel.
    single = starts.filter("height = 0").select(F.col("tree").alias("_tree"), F.lit(0).cast("long").alias("_up"), "path", F.array("node").alias("children"), F.col("node").alias("_alone"))
    lowest = single
    if state is not None:
        opened = state.join(manifest.records[1], "node").select(F.col("tree").alias("_tree"), F.col("rank").alias("_up"), "path", "children", F.lit(None).cast("string").alias("_alone"))
        lowest = opened.unionByName(single)
    digit = F.col("rank").bitwiseAND(F.lit(FAN - 1)).cast("int")
    path = F.when(F.col("_alone").isNull(), F.concat("path", F.array(_selected(F.col("children"), digit)))).otherwise(F.col("path"))
    rows = leaves.join(lowest, (F.col("tree") == F.col("_tree")) & (F.shiftright("rank", _BITS) == F.col("_up")))
    return rows.select(*leaves.columns, path.alias("path"))


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(F.reverse(path), start, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level from the leaf up, left to right."""
    siblings = F.transform(F.reverse(path), lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)


def audit(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: the proof of every document, held against its tampered text."""
    manifest = build(docs, {"claimed": leaf(tampered_text())})
    rows = with_paths(manifest)
    names = manifest.groups.select(F.col("tree").alias("_t"), "subroot")
    rows = rows.join(names, F.col("tree") == F.col("_t"))
    root = F.lit(manifest.root).cast("string")
    out = rows.select(
        "doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), folded(F.col("path"), F.col("claimed")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
