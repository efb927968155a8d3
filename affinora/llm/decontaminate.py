"""Benchmark items inside documents: size-partitioned MinHash containment search, verified by exact shingle containment.

Items are partitioned by the length of their run of shingles into classes (length up to `u`, each bound half as large again as the one
before). For a class a document is seen as windows of 1.5 u shingles, one every u / 2, so that a passage of an item lies whole in some
window however long the document is, and containment in the window means a resemblance of `RESEMBLANCE` at least. An item is a candidate
where one of `FUNCTIONS` minima of the window equals the item's: a true passage is missed once in 200,000 times.

Items for which that bound doesn't hold (up to `SMALL` different shingles, or few different ones for their length) are looked up by their
shingles: of an item with n, of which a hit holds c, any n - c + 1 hold one of the hit, so no document is missed, scattered or not.
Candidates are then counted exactly against the set of the whole document.

The items are the query set: blocks of a bounded size are broadcast in turn, and each block is held against all documents. Documents
are not shuffled for it; only with several blocks their hits are joined to them in the end. Shingles are compared by 64-bit hashes. Defined results: null, empty or wordless texts contain nothing and are contained in nothing; an item
under five words has its whole sequence as its one shingle, which only a document of just these words has. A repeated row gets the same
result each time; items that repeat an id are separate items. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinora.llm import text as tx
from affinora.llm.cut import bounded_batches, cut

FUNCTIONS = 32
#: Least resemblance of an item and a window with a passage of it; items of so many different shingles are looked up in any case.
RESEMBLANCE, SMALL = 0.32, 5
#: A block of items has about so many items or bytes of text at most.
BLOCK_ITEMS, BLOCK_BYTES = 10_000, 16 << 20
#: Shingles that are hashed at a time: bounds the memory of a task whatever the length of a text.
CHUNK = 1 << 14

_TABLE_BITS = 22
_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1, 1 << 63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

HITS = "array<struct<item_id: bigint, percent: double>>"


def size_class(size: int) -> int:
    """Upper bound of the class of a run: 8, 12, 16, 24, 32, 48 ..."""
    u = 8
    while u < size:
        u = u * 3 // 2 if u & (u - 1) == 0 else u // 3 * 4
    return u


def _looked_up(entries: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted values, their items, and which of their first bits occur."""
    entries.sort()
    values = np.array([v for v, _ in entries], np.uint64)
    maybe = np.zeros(1 << _TABLE_BITS, bool)
    maybe[values >> np.uint64(64 - _TABLE_BITS)] = True
    return values, np.array([i for _, i in entries]), maybe


class Index:
    """The signatures and sets of one block of items."""

    def __init__(self, items: list[tuple[int | None, str | None]], percent: int) -> None:
        self.percent, self.ids, self.sets = percent, [], []
        by_class: dict[int, list[tuple[int, int]]] = {}
        by_shingle: list[tuple[int, int]] = []
        for item_id, body in items:
            run = tx.window_hashes(tx.word_hashes(tx.words(body)))
            found = np.unique(run)
            if len(found):
                n, u = len(found), size_class(len(run))
                held = max(1, -(-percent * n // 100))
                if n <= SMALL or held < RESEMBLANCE * (1.5 * u + n - held):
                    by_shingle.extend((int(v), len(self.ids)) for v in found[:max(1, n - held + 1)])
                else:
                    by_class.setdefault(u, []).extend((int(v), len(self.ids)) for v in (found[:, None] * _FACTORS).min(axis=0))
                self.ids.append(item_id)
                self.sets.append(found)
        self.classes = {u: _looked_up(entries) for u, entries in by_class.items()}
        self.shingles = _looked_up(by_shingle) if by_shingle else None

    def candidates(self, run: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first, past the last shingle) of the windows in a run of shingles that share a minimum, or of a shingle, with an item."""
        if self.shingles:
            values, items, maybe = self.shingles
            hit = np.flatnonzero(maybe[run >> np.uint64(64 - _TABLE_BITS)])
            left, right = np.searchsorted(values, run[hit]), np.searchsorted(values, run[hit], "right")
            for k in np.flatnonzero(right > left):
                for i in items[left[k]:right[k]]:
                    yield int(i), int(hit[k]), int(hit[k]) + 1
        if not self.classes:
            return
        reach = 2 * max(self.classes)
        for start in range(0, len(run), CHUNK):
            part = run[start:start + CHUNK + reach]
            hashed = part[:, None] * _FACTORS
            for u, (values, items, maybe) in self.classes.items():
                half = u // 2
                block = np.minimum.reduceat(hashed, np.arange(0, len(part), half), axis=0)
                low = block.copy()
                for shift in (1, 2):
                    low[:-shift] = np.minimum(low[:-shift], block[shift:])
                hit = np.flatnonzero(maybe[(low >> np.uint64(64 - _TABLE_BITS)).ravel()])
                if not len(hit):
                    continue
                seen = low.ravel()[hit]
                left, right = np.searchsorted(values, seen), np.searchsorted(values, seen, "right")
                for k in np.flatnonzero(right > left):
                    first = start + int(hit[k]) // FUNCTIONS * half
                    for i in items[left[k]:right[k]]:
                        yield int(i), first, min(first + 3 * half, len(run))

    def search(self, texts: list[str | None]) -> list[list[tuple[int, float]]]:
        """Per text its items with enough containment, by id."""
        out: list[list[tuple[int, float]]] = [[] for _ in texts]
        held, owners, size = [], [], 0
        for n, body in enumerate(texts):
            run = tx.window_hashes(tx.word_hashes(tx.words(body)))
            if len(run):
                held.append(run)
                owners.append(n)
                size += len(run)
            if size >= CHUNK or n == len(texts) - 1 and held:
                self._search_runs(held, owners, out)
                held, owners, size = [], [], 0
        return out

    def _search_runs(self, runs: list[np.ndarray], owners: list[int], out: list[list[tuple[int, float]]]) -> None:
        ends = np.cumsum([len(r) for r in runs])
        pairs = set()
        for item, first, past in self.candidates(np.concatenate(runs)):
            for k in range(int(np.searchsorted(ends, first, "right")), int(np.searchsorted(ends, past - 1, "right")) + 1):
                pairs.add((k, item))
        sets: dict[int, np.ndarray] = {}
        for k, item in sorted(pairs):
            if k not in sets:
                sets = {k: np.unique(runs[k])}
            wanted = self.sets[item]
            place = np.searchsorted(sets[k], wanted)
            common = int((sets[k][np.minimum(place, len(sets[k]) - 1)] == wanted).sum())
            if 100 * common >= self.percent * len(wanted):
                out[owners[k]].append((self.ids[item], 100.0 * common / len(wanted)))


def blocks(items: DataFrame) -> tuple[int, Callable[[int], list[tuple[int | None, str | None]]]]:
    """Number of blocks of bounded size, dealt by a hash of id and text; and the items of one."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    count, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    n = max(1, math.ceil(count / BLOCK_ITEMS), math.ceil((size or 0) / BLOCK_BYTES))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    return n, lambda k: [(r["item_id"], r["text"]) for r in dealt.filter(F.col("block") == k).select("item_id", "text").collect()]


def with_hits(docs: DataFrame, items: DataFrame, percent: int = 80) -> tuple[DataFrame, Column]:
    """The rows of docs, and as a column of them the array of (item_id, percent contained).

    One block of items is one map-side pass. Further blocks are searched in turn, each with its own pass and only its own index in
    the tasks' memory; the documents with hits, by doc_id and digest of the text, are written per block and joined to docs in the end.
    """
    bounded_batches(docs)
    context = docs.sparkSession.sparkContext
    n, block = blocks(items)
    if n == 1:
        return docs, _search(context.broadcast(Index(block(0), percent)))(docs["text"])
    taken = {c.lower() for c in docs.columns}
    doc, digest, hits = (next(c for k in range(len(taken) + 1) if (c := f"{name}_{k}") not in taken) for name in ("doc", "digest", "hits"))
    key = [F.coalesce(docs["doc_id"].cast("long"), F.lit(-1)).alias(doc), F.md5(docs["text"].cast("binary")).alias(digest)]
    parts = []
    for k in range(n):
        index = context.broadcast(Index(block(k), percent))
        found = docs.select(*key, _search(index)(docs["text"]).alias(hits)).filter(F.size(hits) > 0)
        parts.append(cut(found.groupBy(doc, digest).agg(F.first(hits).alias(hits))))
        index.destroy()
    # At most one array per block for a text.
    every = reduce(DataFrame.unionAll, parts).groupBy(doc, digest).agg(F.flatten(F.collect_list(hits)).alias(hits))
    joined = docs.join(every, (key[0] == every[doc]) & (key[1] == every[digest]), "left")
    return joined, F.coalesce(every[hits], F.array().cast(HITS))


def _search(index: Broadcast):
    def search(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"item_id": i, "percent": p} for i, p in hits] for hits in index.value.search(texts.tolist())], dtype=object)

    return F.pandas_udf(search, HITS)


def contamination(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """Per row of docs: doc_id, n_items, item_ids (sorted, comma-joined), best_percent (0 if none), contaminated."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    rows, hits = with_hits(rows, items, percent)
    hits = rows.select("doc_id", hits.alias("hits"))
    return hits.select(
        "doc_id", F.size("hits").cast("long").alias("n_items"),
        F.array_join(F.array_sort(F.col("hits.item_id")).cast("array<string>"), ",").alias("item_ids"),
        F.coalesce(F.array_max("hits.percent"), F.lit(0.0)).alias("best_percent"), (F.size("hits") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns."""
    rows, hits = with_hits(docs, items, percent)
    return rows.filter(F.size(hits) == 0).select(*(docs[c] for c in docs.columns))
