"""Removal of repeated passages: windows of `WIDTH` words that also start in a document with a smaller doc_id.

1. Documents with equal word sequences collapse to the one with the smallest doc_id; longer ones than a window go whole.
2. A window's anchor is the smallest hash of its runs of `GRAM` words: equal windows have equal anchors, about one in 22 words is
   the place of one. Anchors of a single document leave; with them all windows that could not repeat.
3. The windows of an anchor, a piece of at most `PIECE` words, go to the shard of the anchor. Equal pieces collapse first,
   so a passage in thousands of documents is one piece: all but its smallest document repeat the whole of it.
4. A shard builds an FM-index of its pieces and streams them through it: backward search over the wavelet matrix gives the
   matching statistics of every piece against smaller documents, reported as intervals of windows. Shards are
   cut by total words, so the index in a task has a bound whatever the corpus holds.
5. Intervals go back to all documents that hold the piece, and covered words are removed.

An anchor of more than `HOT` documents is not one piece for each context but one piece for each window, in no shard: equal windows
collapse, and different pieces of exactly one window cannot repeat each other, so that there is nothing left to search.

Defined results: a text null or without words has no windows; texts shorter than a window keep all words; a null doc_id is
neither smaller nor larger than another, so its row keeps all words and costs no other row any. Rows that repeat a doc_id do not count as
smaller than each other. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinora.llm import text as tx
from affinora.llm.cut import bounded_batches, cut
from affinora.llm.fmindex import FMIndex
from affinora.llm.minhash import likely_members

WIDTH = 50
GRAM = 8
#: Windows of a piece: as many as can share one place of their anchor.
RUN = WIDTH - GRAM + 1
PIECE = RUN + WIDTH - 1
#: Documents from which on an anchor is dealt by windows.
HOT = 2048
#: Words of a shard's index.
SHARD_WORDS = 1 << 20

_SKETCH = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n_words", pa.int64()), ("digest", pa.binary()), ("anchors", pa.list_(pa.int64()))])
_PIECE = pa.schema([
    ("doc_id", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("windows", pa.int64()), ("piece", pa.binary()), ("anchor", pa.int64()), ("words", pa.binary())])
_CUT = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_removed", pa.int64()), ("kept_digest", pa.binary()), ("kept", pa.binary())])
_FOUND = pa.schema([("piece", pa.binary()), ("from", pa.int64()), ("to", pa.int64())])


def split(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`, unchanged."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def sha(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def window_anchors(words: list[bytes]) -> np.ndarray:
    """The anchor of every window, in order."""
    if len(words) < WIDTH:
        return np.zeros(0, np.uint64)
    low, width = tx.window_hashes(tx.word_hashes(words), GRAM), 1
    while 2 * width <= RUN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = RUN - width
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def all_rows():
        for batch in batches:
            for doc_id, mark, body in tx.rows(batch, "doc_id", "mark", "text"):
                words = split(body)
                yield doc_id, mark, len(words), sha(words), np.unique(window_anchors(words)).view(np.int64)

    return tx.in_batches(all_rows(), _SKETCH, 512)


def pieces(words: list[bytes], shared: np.ndarray, hot: np.ndarray) -> Iterator[tuple[int, int, bytes, int | None, bytes | None]]:
    """(start, windows, piece, anchor, words) of all windows whose anchor is shared (sorted); hot ones without anchor and words."""
    anchor = window_anchors(words)
    if not len(anchor) or not len(shared):
        return
    place = np.minimum(np.searchsorted(shared, anchor), len(shared) - 1)
    inside = shared[place] == anchor
    # Runs of one anchor, cut at RUN windows where a text repeats itself.
    change = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    for first, last in zip(change.tolist(), [*change[1:].tolist(), len(anchor)]):
        if not inside[first]:
            continue
        step = 1 if hot[place[first]] else RUN
        for start in range(first, last, step):
            stop = min(last, start + step)
            body = b" ".join(words[start:stop + WIDTH - 1])
            name = xxhash.xxh128_digest(body)
            if step == 1:
                yield start, 1, name, None, None
            else:
                yield start, stop - start, name, int(anchor[first].view(np.int64)), body


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def all_rows():
        for batch in batches:
            for doc_id, mark, body, shared in tx.rows(batch, "doc_id", "mark", "text", "shared"):
                names = np.array([s["anchor"] for s in shared], np.int64).view(np.uint64)
                order = np.argsort(names)
                hot = np.array([s["hot"] for s in shared], bool)
                for piece in pieces(split(body), names[order], hot[order]):
                    yield doc_id, mark, *piece

    return tx.in_batches(all_rows(), _PIECE, 2048)


def search(words: list[bytes], first: list[int], width: int = WIDTH) -> list[tuple[int, int, int]]:
    """(piece, from, to): windows of each piece (words joined by a space) that also stand in a piece of a smaller `first`."""
    split_up = pc.split_pattern(pa.array(words, pa.large_binary()), b" ")
    coded = split_up.flatten().dictionary_encode()
    offsets = np.asarray(split_up.offsets).astype(np.int64)
    order = np.unique(np.array(first, np.int64), return_inverse=True)[1].astype(np.int64)
    index = FMIndex(coded.indices.to_numpy().astype(np.int64), offsets - offsets[0], order, len(coded.dictionary))
    return [tuple(row) for part in index.repeats(width) for row in part.tolist()]


def _shard(batches: pa.Table) -> pa.Table:
    anchor = batches.column("anchor").to_numpy()
    _, place, times = np.unique(anchor, return_inverse=True, return_counts=True)
    table = batches.filter(pa.array(times[place] > 1))
    name = table.column("piece").to_pylist()
    found = search(table.column("words").to_pylist(), table.column("first").to_pylist()) if name else []
    return pa.Table.from_batches(list(tx.in_batches(((name[k], a, b) for k, a, b in found), _FOUND)), _FOUND)


def _cuts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def all_rows():
        for batch in batches:
            for doc_id, body, spans in tx.rows(batch, "doc_id", "text", "spans"):
                words = split(body)
                step = np.zeros(len(words) + 1, np.int64)
                np.add.at(step, [s["from"] for s in spans], 1)
                np.add.at(step, [s["to"] for s in spans], -1)
                stays = np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()
                kept = b" ".join([words[k] for k in stays])
                yield doc_id, sha(words), len(words) - len(stays), hashlib.sha256(kept).digest(), kept

    return tx.in_batches(all_rows(), _CUT, 256)


def _texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (doc_id, mark, text) joined with `wanted` (doc_id, mark, ...): a broadcast filter of fixed size spares most texts the shuffle."""
    return likely_members(rows, "doc_id", wanted).join(wanted, ["doc_id", "mark"])


def _spans(reps: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, mark, spans): words to remove from the documents that stand for their class."""
    anchors = reps.select("doc_id", "mark", F.explode("anchors").alias("anchor"))
    shared = cut(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor", (F.col("n") > HOT).alias("hot")))
    wanted = cut(anchors.join(shared, "anchor").groupBy("doc_id", "mark").agg(F.collect_list(F.struct("anchor", "hot")).alias("shared")))
    found = cut(_texts_of(rows, wanted).mapInArrow(
        _pieces, "doc_id long, mark long, start long, windows long, piece binary, anchor long, words binary"))
    unique = cut(found.groupBy("piece").agg(F.min("doc_id").alias("first"), F.first("anchor").alias("anchor"), F.max("windows").alias("windows")))
    several = unique.filter("anchor is not null").groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.col("windows") + WIDTH - 1).alias("size")).filter("n > 1")
    several = cut(several)
    size = several.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-size // SHARD_WORDS))
    asked = unique.join(several.select("anchor"), "anchor").select("piece", "first")
    texts = found.filter("words is not null").join(asked, "piece").filter("doc_id = first").dropDuplicates(["piece"])
    texts = texts.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "piece", "first", "words")
    hits = texts.groupBy("shard").applyInArrow(_shard, "piece binary, `from` long, `to` long").groupBy("piece").agg(F.collect_list(F.struct("from", "to")).alias("hits"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("from"), (F.col("windows") - 1).alias("to")))
    told = found.select("doc_id", "mark", "start", "windows", "piece").join(unique.select("piece", "first").join(hits, "piece", "left"), "piece")
    told = told.select("doc_id", "mark", "start", F.explode(F.when(F.col("doc_id") > F.col("first"), whole).otherwise(F.col("hits"))).alias("hit"))
    span = F.struct((F.col("start") + F.col("hit.from")).alias("from"), (F.col("start") + F.col("hit.to") + WIDTH).alias("to"))
    return told.groupBy("doc_id", "mark").agg(F.collect_set(span).alias("spans"))


def _state(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sketch, changed): every row with its digest and the first doc_id of its class, and what stays of the classes that lose words."""
    bounded_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.xxhash64("text").alias("mark"))
    sketch = cut(rows.mapInArrow(_sketches, "doc_id long, mark long, n_words long, digest binary, anchors array<long>"))
    long_rows = sketch.filter(f"doc_id is not null and n_words >= {WIDTH}")
    classes = cut(long_rows.groupBy("digest").agg(
        F.min(F.struct("doc_id", "mark")).alias("rep"), F.count("*").alias("copies"), F.first("anchors").alias("anchors")).select("digest", "rep.*", "copies", "anchors"))
    spans = _spans(classes, rows)
    changed = cut(_texts_of(rows, cut(spans)).mapInArrow(_cuts, "doc_id long, digest binary, n_removed long, kept_digest binary, kept binary").dropDuplicates(["doc_id", "digest"]))
    first = classes.filter("copies > 1").select("digest", F.col("doc_id").alias("first"))
    return sketch.select("doc_id", "mark", "n_words", "digest").join(first, "digest", "left"), changed


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of docs (doc_id, text)."""
    sketch, changed = _state(docs)
    rows = sketch.join(changed.drop("kept"), ["doc_id", "digest"], "left")
    copy = F.col("first") < F.col("doc_id")
    n_removed = F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    kept = F.when(copy, F.unhex(F.sha2(F.lit("").cast("binary"), 256))).otherwise(F.coalesce("kept_digest", "digest"))
    return rows.select("doc_id", "n_words", n_removed.cast("long").alias("n_removed"), F.lower(F.hex(kept)).alias("kept_sha256"))


def kept_texts(docs: DataFrame) -> DataFrame:
    """The rows of docs with `text` cut to the words that stay, joined by one space where any was removed."""
    sketch, changed = _state(docs)
    copy = F.col("first") < F.col("doc_id")
    lost = sketch.join(changed.select("doc_id", "digest", "kept"), ["doc_id", "digest"], "left").filter(copy | F.col("kept").isNotNull())
    lost = lost.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.when(copy, F.lit("")).otherwise(F.decode("kept", "UTF-8")).alias("_kept")).dropDuplicates(["_id", "_mark"])
    rows = docs.withColumn("_at", F.xxhash64("text"))
    rows = rows.join(lost, (rows["doc_id"].cast("long") == lost["_id"]) & (rows["_at"] == lost["_mark"]), "left")
    return rows.withColumn("text", F.coalesce("_kept", "text")).select(docs.columns)
