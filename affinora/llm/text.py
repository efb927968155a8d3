"""Text helpers that run inside tasks: words, shingle hashes, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

SHINGLE = 5

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


def words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of the text with A-Z in lower case.

    On bytes, `lower` touches A-Z only and `split` cuts at exactly space and \\x09-\\x0D.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * _MIX_A
    h = (h ^ (h >> np.uint64(27))) * _MIX_B
    return h ^ (h >> np.uint64(31))


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))


def window_hashes(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """One hash per run of `width` words, in text order; a shorter text is one run, no words are none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        out = out * _STEP + hashes[k:n - width + 1 + k]
    return mix(out)


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The document's set of shingles as sorted distinct hashes."""
    return np.unique(window_hashes(word_hashes(words(text)), width))


def set_digest(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a whole set of sorted hashes."""
    return xxhash.xxh128_digest(hashes.tobytes())


def rows(batch: pa.RecordBatch, *names: str) -> Iterable[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names))


def in_batches(items: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Bounded Arrow batches from a stream of tuples."""
    kept: list[tuple] = []
    for item in items:
        kept.append(item)
        if len(kept) >= size:
            yield to_batch(kept, schema)
            kept = []
    if kept:
        yield to_batch(kept, schema)


def to_batch(items: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*items) if items else ([] for _ in schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
