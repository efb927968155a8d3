"""Token totals by source, language and tokenizer version, kept by signed deltas with idempotent batches.

A change says what happened to the count of one document under one tokenizer: `insert` (n_tokens), `delete` (n_tokens, what is taken
back) or `revise` (old_tokens to n_tokens; the document stays). A batch of changes is summed to one signed row per key and written under
the batch's own name; the writer's commit mark makes it visible. A batch that is already committed is not added again, and one that
was cut off is written anew from the start, so that a driver may repeat it at will. Totals are the sum of all committed batches, and
`compact` folds old batches into one the same way and
lists them by name, so that a batch which comes late under a smaller name is still read. Sums are associative, so neither order nor partitioning changes a total.

Defined results: null source or lang is a key of its own; a null or unknown operation, or a null count, changes nothing; an empty batch
commits with no rows; a key whose documents are all gone stays with zeros; rows that repeat count as often as they stand. Columns
other than those named are not read. Batches of one store are added by one driver at a time.
"""

from __future__ import annotations

import base64

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinora.llm.minhash import only_members

KEYS = ["source", "lang", "tokenizer"]
_SCHEMA = T.StructType([T.StructField(k, T.StringType()) for k in KEYS] + [T.StructField("n_docs", T.LongType()), T.StructField("n_tokens", T.LongType())])

#: Tokenizers that are one regular expression: version and pattern of a token.
PATTERNS = {"words-1": r"[^\x20\x09-\x0D]+", "pieces-2": r"[A-Za-z\x80-\x{10FFFF}]+|[0-9]|[^A-Za-z0-9\x80-\x{10FFFF}\x20\x09-\x0D]"}


def pattern_count(text: Column, version: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(PATTERNS[version])).cast("long")


def vocabulary_count(path: str, text: Column) -> Column:
    """Tokens under a byte-level vocabulary file (ranks in base64), read by each task from a path that all machines have."""
    def count(texts: pd.Series) -> pd.Series:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pieces = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        encoder = tiktoken.Encoding("own", pat_str=pieces, mergeable_ranks=ranks, special_tokens={})
        return texts.map(lambda x: len(encoder.encode_ordinary(x)) if x else 0)

    return F.pandas_udf(count, "long")(text)


def deltas(changes: DataFrame) -> DataFrame:
    """One signed row per key from (op, source, lang, tokenizer, n_tokens, old_tokens)."""
    op, new, old = F.col("op"), F.col("n_tokens"), F.col("old_tokens")
    docs = F.when(op == "insert", 1).when(op == "delete", -1).otherwise(0)
    tokens = F.when(op == "insert", new).when(op == "delete", -new).otherwise(new - old)
    valid = op.isin("insert", "delete", "revise") & tokens.isNotNull()
    rows = changes.select(*[F.col(k).cast("string").alias(k) for k in KEYS], "op", F.col("n_tokens").cast("long").alias("n_tokens"), F.col("old_tokens").cast("long").alias("old_tokens"))
    return rows.filter(valid).groupBy(*KEYS).agg(F.sum(docs).cast("long").alias("n_docs"), F.sum(tokens).cast("long").alias("n_tokens"))


class Store:
    """The committed batches under a folder that the cluster shares."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        return self._path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self, batch: str) -> bool:
        return self._files().exists(self._path(f"{self.folder}/batch={batch}/_SUCCESS"))

    def batches(self) -> list[str]:
        files = self._files()
        if not files.exists(self._path(self.folder)):
            return []
        names = [s.getPath().getName() for s in files.listStatus(self._path(self.folder)) if s.isDirectory()]
        return sorted(n[len("batch="):] for n in names if n.startswith("batch=") and self.committed(n[len("batch="):]))

    def add(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch; False if it was committed before, when nothing is computed or written."""
        if batch.startswith("upto-"):
            raise ValueError("names that begin with upto- are kept for compactions")
        if self.committed(batch):
            return False
        deltas(changes).write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
        return True

    def _folded(self, compaction: str) -> set[str] | None:
        """The batches that a compaction holds; None for one without a list, whose batches are read themselves."""
        path = f"{self.folder}/folded={compaction}"
        if not self._files().exists(self._path(f"{path}/_SUCCESS")):
            return None
        return {r["batch"] for r in self.spark.read.schema("batch string").parquet(path).collect()}

    def rows(self) -> DataFrame:
        """All committed signed rows; what a compaction holds is not read twice."""
        names = self.batches()
        compactions = [(len(f), n, f) for n in names if n.startswith("upto-") and (f := self._folded(n)) is not None]
        names = [n for n in names if not n.startswith("upto-")]
        if compactions:
            _, most, folded = max(compactions, key=lambda c: c[:2])
            names = [most] + [n for n in names if n not in folded]
        if not names:
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(*[f"{self.folder}/batch={n}" for n in names])

    def totals(self) -> DataFrame:
        return self.rows().groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def compact(self, last: str) -> None:
        """Fold the batches up to and including `last`, by name, into one; they stay on disk and are no longer read."""
        name = f"upto-{last}"
        if self.committed(name) and self._folded(name) is not None:
            return
        names = [n for n in self.batches() if not n.startswith("upto-") and n <= last]
        if names:
            self._files().delete(self._path(f"{self.folder}/batch={name}"), True)
            self.spark.createDataFrame([(n,) for n in names], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/folded={name}")
            rows = self.spark.read.schema(_SCHEMA).parquet(*[f"{self.folder}/batch={n}" for n in names])
            rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).write.mode("overwrite").parquet(f"{self.folder}/batch={name}")


def document_changes(docs: DataFrame, labels: DataFrame) -> list[tuple[str, DataFrame]]:
    """The life of a corpus in four batches: all documents come in, a new tokenizer version takes over their counts, is revised to its own
    counts, and toxic documents are taken down."""
    first, second = PATTERNS
    rows = docs.select("source", "lang", F.col("doc_id").cast("long").alias("doc_id"), "text")

    def changes(rows: DataFrame, op: str, version: str, old: Column | None = None) -> DataFrame:
        return rows.select(F.lit(op).alias("op"), "source", "lang", F.lit(version).alias("tokenizer"), pattern_count(F.col("text"), version).alias("n_tokens"), (F.lit(None).cast("long") if old is None else old).alias("old_tokens"))

    taken = labels.filter("toxic > 0").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    gone = only_members(rows, "doc_id", taken)  # whole texts of the other documents aren't shuffled
    return [
        ("1-insert", changes(rows, "insert", first)),
        ("2-recount", changes(rows, "insert", first).withColumn("tokenizer", F.lit(second))),
        ("3-revise", changes(rows, "revise", second, pattern_count(F.col("text"), first))),
        ("4-takedown", changes(gone, "delete", first).unionByName(changes(gone, "delete", second))),
    ]
