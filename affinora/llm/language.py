"""Language ID by prediction by partial matching: one byte context tree per language, exact code lengths under frozen counts.

A text is read as bytes of its lower-case form: every byte that occurs in the training rows is a symbol, all others share the last. A language's tree holds what followed each context of up to `ORDER`
symbols. A symbol seen in the longest context that the tree has costs -log2 of its share there; one unseen there pays the
escape (method C: as many escapes as the context has different symbols) and is coded in the next shorter context among the symbols not excluded
already, down to equal shares. The shares of every context therefore add up to 1, and the sum of a text's costs is the exact length
of its PPM code. The language with the shortest code wins. Its score is its share of 2^-length over all languages and a background without
context: `LEARNED` of the training rows' byte shares, the rest equal shares of all bytes. A text of random letters or of a language never learned is
shorter under the background than under any tree, so it scores near 0.

The trees are frozen after one pass over a bounded sample of labelled rows (`SAMPLE_PER_LANG`, whole texts), counted in Spark. Scoring reads
every whole text with two table look-ups a byte.

Defined results: text null or without a letter is `und` with score 0; so is every text where nothing could be learned. Rows that
repeat count as they stand; a null lang teaches nothing; ties go to the language that sorts first. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinora.llm import text as tx
from affinora.llm.cut import bounded_batches

UNKNOWN = "und"
ORDER = 3
#: Part of the background that follows the bytes of the training rows; the rest is spread over all 256 bytes.
LEARNED = 15 / 16
#: Labelled documents that a language's tree is counted from.
SAMPLE_PER_LANG = 2500
#: Bytes that are scored at a time: bounds the memory of a task whatever the length of a text.
CHUNK = 1 << 20

_GRAM = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def read_bytes(text: str) -> np.ndarray:
    """Lower-case bytes behind as many spaces as the longest context has symbols."""
    return np.frombuffer(b" " * ORDER + text.lower().encode("utf-8", "surrogatepass"), np.uint8)


def grams(data: np.ndarray) -> np.ndarray:
    """Each byte with its context, as one number."""
    wide = data.astype(np.int64)
    code = wide[:-ORDER].copy()
    for k in range(1, ORDER + 1):
        code = code << 8 | wide[k:len(wide) - ORDER + k]
    return code


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: dict[str, list[np.ndarray]] = {}
        for lang, body in tx.rows(batch, "lang", "text"):
            if has_letter(body):
                held.setdefault(lang, []).append(grams(read_bytes(body)))
        for lang, codes in held.items():
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code)), pa.array(code), pa.array(n)], schema=_GRAM)


def _shares(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Shares of symbols in contexts (rows), given those in the next shorter contexts: method C with exclusion."""
    total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    open_to = np.where(counts > 0, 0.0, shorter)
    rest = open_to.sum(axis=1, keepdims=True)
    full = rest <= 0  # all symbols seen: nothing to escape to
    escape = np.where(full, 0.0, kinds)
    seen = counts / np.maximum(total + escape, 1)
    unseen = np.where(full, 0.0, escape / np.maximum(total + escape, 1) * open_to / np.where(full, 1.0, rest))
    return np.where(total > 0, seen + unseen, shorter)


class Trees:
    """Code lengths of all languages side by side: a row for each context, a column for each symbol."""

    def __init__(self, lang: list[str] | pa.Array, code: np.ndarray, n: np.ndarray) -> None:
        coded = pa.array(lang, pa.string()).dictionary_encode() if isinstance(lang, list) else lang.dictionary_encode()
        names = coded.dictionary.to_pylist()
        self.langs = sorted(names)
        owner = np.array([self.langs.index(x) for x in names], np.int64)[coded.indices.to_numpy()]
        often = np.bincount(code & 255, weights=n, minlength=256)
        self.background = -np.log2(LEARNED * often / max(often.sum(), 1) + (1 - LEARNED if often.any() else 1.0) / 256)
        alphabet = np.flatnonzero(often)
        self.symbol = np.full(256, len(alphabet), np.int32)
        self.symbol[alphabet] = np.arange(len(alphabet))
        s = self.size = len(alphabet) + 1
        packed = np.zeros(len(code), np.int64)
        for k in range(ORDER, -1, -1):
            packed = packed * s + self.symbol[code >> 8 * k & 255]
        contexts = np.unique(packed // s)
        # The table's first rows are all contexts of one symbol, then come those seen one symbol short of the longest: each stands in
        # where a longer one was never seen.
        short = s ** (ORDER - 1)
        shorter = np.unique(packed // s % short)
        stand_in = (np.arange(short) % s).astype(np.int32)
        stand_in[shorter] = s + np.arange(len(shorter), dtype=np.int32)
        self.row = np.tile(stand_in, s)
        self.row[contexts] = s + len(shorter) + np.arange(len(contexts), dtype=np.int32)
        self.bits = np.empty(((s + len(shorter) + len(contexts)) * s, len(self.langs)), np.float32)
        for k in range(len(self.langs)):
            mine = owner == k
            shares = np.full((1, s), 1.0 / s)
            for order in range(ORDER):
                tail = np.bincount(packed[mine] % s ** (order + 1), weights=n[mine], minlength=s ** (order + 1)).reshape(-1, s)
                shares = _shares(tail, np.tile(shares, (len(tail) // len(shares), 1)))
                if order == 1:
                    single = shares
            place = np.searchsorted(contexts, packed[mine] // s)
            longest = np.zeros((len(contexts), s))
            np.add.at(longest, (place, packed[mine] % s), n[mine])
            longest = _shares(longest, shares[contexts % short])
            self.bits[:, k] = -np.log2(np.vstack([single, shares[shorter], longest])).ravel()

    def code_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        held, owners, size = [], [], 0
        for k, body in enumerate(texts):
            data = read_bytes(body)
            for start in range(0, max(1, len(data) - ORDER), CHUNK):
                held.append(data[start:start + CHUNK + ORDER])
                owners.append(k)
                size += len(held[-1])
                if size >= CHUNK:
                    self._add(out, held, owners)
                    held, owners, size = [], [], 0
        if held:
            self._add(out, held, owners)
        return out

    def _add(self, out: np.ndarray, parts: list[np.ndarray], owners: list[int]) -> None:
        sym = self.symbol[np.concatenate(parts)]
        s = self.size
        context = sym[:-ORDER].copy()
        for k in range(1, ORDER):
            context = context * s + sym[k:len(sym) - ORDER + k]
        costs = self.bits[self.row[context] * s + sym[ORDER:]]
        starts = np.cumsum([0] + [len(p) for p in parts])
        # Costs at the joints between two parts belong to neither.
        edges = np.stack([starts[:-1], starts[1:] - ORDER], axis=1)
        keep = [i for i, (a, b) in enumerate(edges) if b > a]
        if keep:
            bounds = edges[keep].ravel()
            sums = np.add.reduceat(np.vstack([costs, np.zeros((1, costs.shape[1]), np.float32)]), bounds, axis=0, dtype=np.float64)[::2]
            np.add.at(out, np.array(owners)[keep], sums)

    def background_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of each text without context."""
        return np.array([np.bincount(read_bytes(body)[ORDER:], minlength=256) @ self.background for body in texts])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [(UNKNOWN, 0.0)] * len(texts)
        known = [i for i, x in enumerate(texts) if has_letter(x)] if self.langs else []
        if known:
            bodies = [texts[i] for i in known]
            bits = self.code_lengths(bodies)
            best_bits = bits.min(axis=1)
            rivals = np.column_stack([bits, self.background_lengths(bodies)])
            share = 1 / np.exp2(np.clip(best_bits[:, None] - rivals, -1000.0, 1000.0)).sum(axis=1)
            for i, best, p in zip(known, bits.argmin(axis=1).tolist(), share.tolist()):
                out[i] = (self.langs[best], p)
        return out


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Trees:
    """Learn from text and lang of rows whose crc32(doc_id as text) mod 4 is not 2."""
    bounded_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.col("lang").alias("lang"))
    rows = rows.filter("lang is not null and text is not null").filter(~held_out("doc_id"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    picked = F.lit(False)
    for lang, n in sorted(counts.items()):
        picked = picked | ((F.col("lang") == lang) & (place < int((1 << 20) * min(1.0, per_lang / n))))
    counted = rows.filter(picked).mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Different grams of the sample: bounded by its size.
    table = counted.toArrow().combine_chunks()
    lang = table.column("lang").combine_chunks()
    return Trees(lang, table.column("gram").to_numpy(), table.column("n").to_numpy())


def predicted(trees: Trees, docs: DataFrame, text: Column) -> Column:
    """Struct of lang_pred and score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shared.value.predict(texts.tolist()), columns=["lang_pred", "score"])

    return F.pandas_udf(predict, "lang_pred string, score double")(text)


def languages(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, held_out, lang_pred, score."""
    trees = fit(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    rows = rows.select("doc_id", predicted(trees, rows, F.col("text")).alias("p"))
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "p.lang_pred", "p.score")


def known_documents(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs whose language is known with a score of `least` or more, with all their columns.

    Texts without letters go, and those that the background explains better than the trees: junk, and languages never learned."""
    found = predicted(fit(docs), docs, docs["text"])
    return docs.filter((found["lang_pred"] != UNKNOWN) & (found["score"] >= least))
