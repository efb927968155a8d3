"""Near-duplicate documents by SuperMinHash: signatures, banding, exact verification, union-find grouping.

A signature has `SLOTS` slots. Every element of a document draws one random permutation of the slots and one fraction per
step; at step j it offers j + fraction to the j-th slot of its permutation, and a slot keeps the smallest offer. The ranks of
an element are therefore all different, which lowers the variance of the estimate, and a document stops at the first step
after which no later offer can win: one step for a document of average length.

Defined results: text null, empty or without words has no shingles and links with nothing; under five words the whole
sequence is the one shingle. Equal sets always share a component. A null doc_id keeps a row of its own with a null component.
Rows that repeat a doc_id are nodes of one name, which ties their sets together; where it is the smallest doc_id of several
different sets, it links by the one with the smallest digest. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinora.llm import text as tx
from affinora.llm.components import Forest, components
from affinora.llm.cut import bounded_batches, cut

SLOTS = 64
#: Rows of a band: 16 bands of 4 miss a pair at similarity 0.85 once in 130,000 times, one at 0.9 once in ten million.
ROWS = 4
BANDS = SLOTS // ROWS
#: Documents, and shingles of all of them, of a tile of a crowded bucket (on average); two tiles at a time are compared in a task.
TILE = 256
TILE_SHINGLES = 1 << 20
#: Bits of the membership filter that spares the shuffle of texts without candidates; fixed, so its broadcast has a bound.
FILTER_BITS = 1 << 23

_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("node", pa.int64()), ("digest", pa.binary()), ("elements", pa.list_(pa.int64()))])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_ROUND = np.uint64(0xD1B54A32D192ED03)


def super_minhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """Signatures (documents x slots) of non-empty sets of hashes; each offer is step << 48 | 48 random bits."""
    sizes = np.array([len(s) for s in sets])
    best = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    if not len(sets):
        return best
    flat = best.reshape(-1)
    element, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = None
    for j in range(slots):
        drawn = tx.mix(element + np.uint64((j + 1) * int(_ROUND) % (1 << 64)))
        k = j + ((drawn >> np.uint64(48)) % np.uint64(slots - j)).astype(np.int64)
        if j == 0:
            slot = k
        else:
            line = np.arange(len(element))
            slot = order[line, k]
            order[line, k] = order[line, j]
        offer = (np.uint64(j) << np.uint64(48)) | (drawn & np.uint64(0xFFFFFFFFFFFF))
        np.minimum.at(flat, owner * slots + slot, offer)
        open_docs = best.max(axis=1) >= np.uint64(j + 1) << np.uint64(48)
        going = open_docs[owner]
        if not going.any():
            break
        if j == 0:
            element, owner, k = element[going], owner[going], k[going]
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(element), 1))
            order[np.arange(len(element)), k] = 0
        elif not going.all():
            element, owner, order = element[going], owner[going], order[going]
    return best


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    n, slots = signatures.shape
    key = np.tile(np.arange(slots // rows, dtype=np.uint64), (n, 1))
    for k in range(rows):
        key = tx.mix(key * _ROUND + signatures[:, k::rows])
    return key


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(ids, sets):
        full = [i for i, s in enumerate(sets) if len(s)]
        bands = band_keys(super_minhash([sets[i] for i in full])).view(np.int64).tolist()
        place = dict(zip(full, bands))
        return tx.to_batch([(d, len(s), tx.set_digest(s) if len(s) else None, place.get(i)) for i, (d, s) in enumerate(zip(ids, sets))], _SKETCH)

    for batch in batches:
        ids, sets, held = [], [], 0
        for doc_id, body in tx.rows(batch, "doc_id", "text"):
            ids.append(doc_id)
            sets.append(tx.shingles(body))
            held += len(sets[-1])
            if held > 200_000:
                yield flush(ids, sets)
                ids, sets, held = [], [], 0
        if ids:
            yield flush(ids, sets)


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = ((i, tx.set_digest(s), s.view(np.int64)) for i, s in ((i, tx.shingles(body)) for i, body in tx.rows(batch, "doc_id", "text")))
        yield from tx.in_batches(found, _SETS, 256)


def _alike(common: Column, size_a: Column, size_b: Column, percent: int) -> Column:
    return 100 * common >= percent * (size_a + size_b - common)


def membership(ids: DataFrame, key: str) -> DataFrame:
    """(word, bits): a fixed-size filter that holds every key and lets few others pass."""
    h = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    return ids.select((h / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (h % 64).cast("int")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def likely_members(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is in `ids` (same column name), and few others, by the broadcast filter."""
    h = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    word, bit = (h / 64).cast("int"), (h % 64).cast("int")
    bits = F.broadcast(membership(ids, key))
    return rows.join(bits, (word == bits["word"]) & (F.call_function("shiftright", bits["bits"], bit).bitwiseAND(F.lit(1)) == 1), "left_semi")


def only_members(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is in `ids` (distinct, same column name): first by the broadcast filter, then exactly."""
    return likely_members(rows, key, ids).join(ids, key, "left_semi")


def _tile_links(percent: int):
    def compare(key: tuple[pa.Scalar, ...], batch: pa.Table) -> pa.Table:
        tile, elements = batch.column("tile").to_numpy(), batch.column("elements").combine_chunks()
        comp = batch.column("comp").to_pylist()
        offsets, flat = elements.offsets.to_numpy(), elements.values.to_numpy()
        flat, offsets = flat[offsets[0]:offsets[-1]], offsets - offsets[0]
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        values, column, times = np.unique(flat, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(times > 1)
        place = np.full(len(values), -1)
        place[shared] = np.arange(len(shared))
        column = place[column]
        i_tile, j_tile = key[1].as_py(), key[2].as_py()
        left, right = np.flatnonzero(tile == i_tile), np.flatnonzero(tile == j_tile)
        common = np.zeros((len(left), len(right)), np.float32)
        at = np.full(len(sizes), -1)
        for start in range(0, len(shared), 4096):
            inside = (column >= start) & (column < start + 4096)
            cells = np.zeros((len(sizes), min(4096, len(shared) - start)), np.float32)
            cells[owner[inside], column[inside] - start] = 1
            common += cells[left] @ cells[right].T
        fits = 100 * common >= percent * (sizes[left][:, None] + sizes[right][None, :] - common)
        forest = Forest()
        at[:] = np.unique(comp, return_inverse=True)[1]
        for x, y in zip(*np.nonzero(fits & (at[left][:, None] != at[right][None, :]))):
            forest.union(comp[left[x]], comp[right[y]])
        return pa.Table.from_batches(list(tx.in_batches(forest.edges(), _LINK)), _LINK)

    return compare


def crowded_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components left in buckets (key, node, comp, n_shingles) that still hold several, compared exactly tile by tile.

    Every pair of a bucket that isn't yet in one component is compared, by a matrix product over the shared shingles of two
    tiles. A task gives back a spanning forest of the components it links, so the output grows with the members and not with their pairs.
    """
    tiles = F.greatest(F.lit(1), F.ceil(F.count("*") / TILE), F.ceil(F.sum("n_shingles") / TILE_SHINGLES)).cast("int")
    several = members.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), tiles.alias("tiles")).filter("low <> high")
    dealt = members.join(several.select("key", "tiles"), "key").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(
        F.least(t, F.col("tile")).alias("i"), F.greatest(t, F.col("tile")).alias("j"))))
    sent = dealt.select("key", "node", "comp", "tile", pair.alias("p")).join(sets, "node")
    sent = sent.select("key", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "comp", "tile", "elements")
    return sent.groupBy("key", "i", "j").applyInArrow(_tile_links(percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text).

    Documents link if 100 * shared shingles >= percent * shingles of either. Equal sets collapse first. Then each bucket
    compares its members with its smallest one: a linear number of pairs, in which almost all groups come together. Buckets that
    still hold more than one component have all remaining pairs compared by `crowded_links`.
    """
    bounded_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    sketch = cut(rows.mapInArrow(_sketches, "doc_id long, n_shingles long, digest binary, bands array<long>"))
    named = sketch.filter("digest is not null and doc_id is not null")
    classes = cut(named.groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles")))
    repeated = named.groupBy("doc_id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).filter("least <> most").select("doc_id", "least")
    single, ties = (classes, None) if repeated.isEmpty() else _several_sets(named, classes, cut(repeated))
    keys = single.select("node", "n_shingles", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("center")).filter("n > 1").select("key", "center")
    buckets = cut(keys.join(shared, "key"))
    pairs = cut(buckets.filter("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct())
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = cut(single.select("node", "digest").join(nodes, "node"))
    # Texts are not shuffled: the filter lets few more than the wanted ones be cut into shingles where they lie.
    sets = likely_members(rows.withColumnRenamed("doc_id", "node"), "node", wanted).withColumnRenamed("node", "doc_id")
    sets = cut(sets.mapInArrow(_sets, "node long, digest binary, elements array<long>").join(wanted, ["node", "digest"]).select("node", "elements").dropDuplicates(["node"]))
    of_a = sets.select(F.col("node").alias("a"), F.col("elements").alias("in_a"))
    of_b = sets.select(F.col("node").alias("b"), F.col("elements").alias("in_b"))
    common = F.size(F.array_intersect("in_a", "in_b"))
    first = pairs.join(of_b, "b").join(of_a, "a").filter(_alike(common, F.size("in_a"), F.size("in_b"), percent)).select("a", "b")
    known = components(first if ties is None else first.unionByName(ties))
    members = buckets.join(known, "node", "left").select("key", "node", "n_shingles", F.coalesce("component", "node").alias("comp"))
    second = cut(crowded_links(members, sets, percent))
    reached = known if second.isEmpty() else _joined(known, components(second))
    named_class = classes.filter("copies > 1").select("digest", F.col("node").alias("class_id"))
    out = sketch.join(named_class, "digest", "left").withColumn("node", F.coalesce("class_id", "doc_id")).join(reached, "node", "left")
    component = F.coalesce("component", "node")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _several_sets(named: DataFrame, classes: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where doc_ids name several sets: the classes without further sets of a node, and links between the classes that such a doc_id ties."""
    further = classes.join(repeated.withColumnRenamed("doc_id", "node"), "node").filter("digest <> least").select("digest")
    single = cut(classes.join(further, "digest", "left_anti"))
    of_doc = named.join(repeated.select("doc_id"), "doc_id").select("doc_id", "digest").join(classes.select("digest", "node"), "digest")
    ties = of_doc.groupBy("doc_id").agg(F.collect_set("node").alias("nodes"), F.min("node").alias("a"))
    return single, ties.select("a", F.explode("nodes").alias("b")).filter("a <> b")


def _joined(known: DataFrame, more: DataFrame) -> DataFrame:
    """Components after those of links between components."""
    onward = more.select(F.col("node").alias("component"), F.col("component").alias("further"))
    moved = known.join(onward, "component", "left").select("node", F.coalesce("further", "component").alias("component"))
    return moved.unionByName(more.join(known, "node", "left_anti"))


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of docs without those whose component has a smaller doc_id; rows that repeat a kept doc_id stay once."""
    found = near_duplicates(docs, percent)
    gone = found.filter("not kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti")
    repeated = cut(docs.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id"))
    if repeated.isEmpty():
        return left
    once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").unionByName(once)
