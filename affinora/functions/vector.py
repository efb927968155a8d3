"""Vectors as arrays of double: products, norms, hashed text vectors, seeded projections."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from affinora.functions.binding import let


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def normalised(v: Column) -> Column:
    return let(norm(v), lambda n: F.transform(as_double(v), lambda x: F.try_divide(x, n)))


def text_embedding(text: Column, dim: int) -> Column:
    """Hashed bag of words: each token adds +1 or -1 to the bucket its md5 names; unit length.

    Empty text gives zeros. One pass over a batch of texts in numpy; a token met before is not hashed again.
    """
    return _bags(dim)(F.lower(F.coalesce(text, F.lit(""))))


@functools.lru_cache(maxsize=1 << 16)
def _token_code(token: str) -> tuple[int, int]:
    """Number of a token before it is reduced to a bucket, and its sign."""
    digest = hashlib.md5(token.encode()).hexdigest()
    return int(digest[:8], 16), -1 if int(digest[8], 16) % 2 else 1


def _bags(dim: int):
    def bags(texts: pd.Series) -> pd.Series:
        found = [[_token_code(t) for t in re.findall("[a-z0-9]+", x)] for x in texts]
        owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
        codes = np.array([c for f in found for c in f], np.int64).reshape(-1, 2)
        counts = np.bincount(owner * dim + codes[:, 0] % dim, weights=codes[:, 1], minlength=len(found) * dim).astype(np.float64).reshape(len(found), dim)
        length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        return pd.Series(list(np.divide(counts, length, out=np.zeros_like(counts), where=length > 0)), dtype=object)

    return F.pandas_udf(bags, "array<double>")


def seeded_weight(seed: str, row: int, column: int, scale: float = 1.0) -> float:
    """Reproducible uniform weight in [-scale, scale]."""
    digest = hashlib.md5(f"{seed}:{row}:{column}".encode()).hexdigest()
    return round((int(digest[:8], 16) / 0xFFFFFFFF * 2.0 - 1.0) * scale, 9)


def seeded_dense(inputs: Sequence[str], dim: int, seed: str) -> Column:
    """Fixed random layer with ReLU over numeric columns: max(0, W x)."""
    units = [
        "greatest(" + " + ".join(f"`{c}` * {seeded_weight(seed, i, j)!r}D" for i, c in enumerate(inputs)) + ", 0D)" for j in range(dim)
    ]
    return F.expr(f"array({', '.join(units)})")


def category_lookup(value: Column, dim: int, seed: str, scale: float = 0.05) -> Column:
    """Fixed random vector per category value (null is a category)."""
    text = F.coalesce(value.cast("string"), F.lit("<null>"))
    digits = [F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text, F.lit(f":{j}"))), 1, 8), 16, 10).cast("double") for j in range(dim)]
    return F.array(*[(d / float(0xFFFFFFFF) * 2.0 - 1.0) * scale for d in digits])
