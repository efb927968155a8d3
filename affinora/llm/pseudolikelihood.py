"""Documents scored by masked pseudo-likelihood: every token predicted from both sides by a small window network.

Words are counted over all documents. The `WORDS` most frequent have a class each; the others share a class by their last two bytes where
these are among the `ENDINGS` commonest, else by length. A token's probability is that of its class, given the classes of the `SIDE`
tokens before and after it, times the share of its word in all tokens of its class. The network sees the neighbours, never the token:
embeddings by distance, one hidden layer of tanh units, and a softmax over the classes. The score of a document is the sum of the
log-probabilities of all its tokens given all the others, and the mean per token.

Every word has its own count, however rare. Words that are at least one in `FREQUENT` of all tokens, hence `FREQUENT` words at most, go to
the tasks as a table; the occurrences of all others join the counts by word, where no word can be a hot key as each is rare. Words are
told apart by 64-bit hashes. Texts are read as words twice, to count and to write classes; training and scoring read the classes.

Training masks every token once: one in `ROUNDS` in each round. Each round sends the parameters out; every task goes over its documents
with Adam in numpy; the parameters are then averaged in Spark, each weighted by its tokens. What is counted and averaged grows with the
corpus, what the driver holds (table and parameters) is bounded.

Defined results: a null, empty or wordless text has 0 tokens, log_prob 0 and a null mean; places past the ends of a text are a class
of their own; rows that repeat count as they stand; an empty table has no scores. The same input in the same splits
gives the same scores. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinora.llm import text as tx
from affinora.llm.cut import bounded_batches, cut

WORDS, ENDINGS, LENGTHS = 64, 48, 15
#: Words that are one in this many tokens, or more, are looked up in a table.
FREQUENT = 1 << 20
SIDE, WIDTH, HIDDEN = 3, 8, 24
ROUNDS, BATCH, RATE = 2, 512, 0.01
#: Distinct words that a task remembers, and tokens that are read, trained or scored at a time.
COUNTED, CHUNK = 150_000, 1 << 15
#: Places that the network scores at a time.
ROWS = 1024
#: Steps of hidden units and of weights when scoring. A float64 holds the sum of their products exactly (up to 2^11), so it does not
#: depend on the order in which the machine adds, and that on a row's place: equal texts get equal scores.
UNIT_STEP, WEIGHT_STEP = 2.0 ** -22, 2.0 ** -20
#: Steps of a sum of logarithms.
UNIT = 1e9

_COUNT = pa.schema([("word", pa.int64()), ("ending", pa.int32()), ("length", pa.int32()), ("n", pa.int64())])
_PART = pa.schema([("cell", pa.int32()), ("value", pa.float64()), ("weight", pa.float64())])
_READ = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("classes", pa.binary()), ("within", pa.float64()),
                   ("rare", pa.list_(pa.int64()))])
_SCORE = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("log_prob", pa.float64())])


def word_ids(words: list[bytes]) -> np.ndarray:
    """Signed 64-bit hashes."""
    return tx.word_hashes(words).view(np.int64)


def endings(words: list[bytes]) -> np.ndarray:
    """The last two bytes as a number."""
    return np.frombuffer(b"".join([w[-2:] if len(w) > 1 else b"\0" + w for w in words]), ">u2").astype(np.int32)


@dataclass
class Vocabulary:
    """Classes by word and by ending (-1: none), tokens of each class, and the counts of frequent words, sorted by word."""

    top: dict[int, int]
    endings: np.ndarray
    tokens: np.ndarray
    frequent: np.ndarray
    counts: np.ndarray

    @property
    def size(self) -> int:
        return WORDS + ENDINGS + LENGTHS

    def classes(self, words: list[bytes], ids: np.ndarray) -> np.ndarray:
        found = self.endings[endings(words)]
        lengths = np.minimum(np.fromiter(map(len, words), np.int32, len(words)), LENGTHS)
        found = np.where(found < 0, WORDS + ENDINGS + lengths - 1, found)
        for k in np.flatnonzero(np.isin(ids, list(self.top))):
            found[k] = self.top[int(ids[k])]
        return found

    def reader(self) -> Reader:
        return Reader(self)


class Reader:
    """Reads runs of tokens; remembers up to `COUNTED` words and those of the run."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.codes: dict[bytes, int] = {}
        self.word = np.zeros(COUNTED + CHUNK, np.int64)
        self.cls = np.zeros(COUNTED + CHUNK, np.uint8)
        self.log_n = np.zeros(COUNTED + CHUNK)
        self.rare = np.zeros(COUNTED + CHUNK, bool)
        self.log_tokens = np.log(np.maximum(vocabulary.tokens, 1.0))

    def _learn(self, new: list[bytes]) -> None:
        v, at = self.vocabulary, len(self.codes)
        here = slice(at, at + len(new))
        ids = word_ids(new)
        self.word[here] = ids
        self.cls[here] = v.classes(new, ids)
        place = np.minimum(np.searchsorted(v.frequent, ids), max(0, len(v.frequent) - 1))
        known = v.frequent[place] == ids if len(v.frequent) else np.zeros(len(new), bool)
        self.rare[here] = ~known
        self.log_n[here] = np.log(np.where(known, v.counts[place], 1.0)) if len(v.frequent) else 0.0
        self.codes.update(zip(new, range(at, at + len(new))))

    def codes_of(self, run: list[bytes]) -> np.ndarray:
        if len(self.codes) > COUNTED:
            self.codes.clear()
        codes = np.fromiter(map(self.codes.get, run, repeat(-1)), np.int32, len(run))
        missing = np.flatnonzero(codes < 0).tolist()
        if missing:
            new = [run[k] for k in missing]
            self._learn(list(dict.fromkeys(new)))
            codes[missing] = np.fromiter(map(self.codes.__getitem__, new), np.int32, len(new))
        return codes

    def read(self, texts: list[list[bytes]]) -> list[tuple[bytes, float, np.ndarray]]:
        """Per text its classes, the log-probabilities within the classes (rare words counted as 1), and the rare words as they occur."""
        tokens = list(chain.from_iterable(texts))
        ends = np.cumsum([len(t) for t in texts])
        classes, rare, word = np.zeros(len(tokens), np.uint8), np.zeros(len(tokens), bool), np.zeros(len(tokens), np.int64)
        within = np.zeros(len(tokens) + 1)
        for start in range(0, len(tokens), CHUNK):
            here = slice(start, start + CHUNK)
            codes = self.codes_of(tokens[here])
            classes[here], rare[here], word[here] = self.cls[codes], self.rare[codes], self.word[codes]
            within[:-1][here] = self.log_n[codes] - self.log_tokens[classes[here]]
        out, start = [], 0
        for end in ends.tolist():
            out.append((classes[start:end].tobytes(), float(within[start:end].sum()), word[start:end][rare[start:end]]))
            start = end
        return out


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(counter: Counter) -> Iterator[pa.RecordBatch]:
        words, n = list(counter), np.fromiter(counter.values(), np.int64, len(counter))
        lengths = np.minimum(np.fromiter(map(len, words), np.int32, len(words)), LENGTHS)
        whole = pa.RecordBatch.from_arrays([pa.array(word_ids(words)), pa.array(endings(words)), pa.array(lengths), pa.array(n)], schema=_COUNT)
        for start in range(0, len(words), 65536):
            yield whole.slice(start, 65536)

    counter: Counter = Counter()
    for batch in batches:
        for (body,) in tx.rows(batch, "text"):
            counter.update(tx.words(body))
            if len(counter) > COUNTED:
                yield from counted(counter)
                counter = Counter()
    yield from counted(counter)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, ending, length, n) of all different words."""
    found = docs.select("text").mapInArrow(_word_counts, "word long, ending int, length int, n long")
    return cut(found.groupBy("word", "ending", "length").agg(F.sum("n").alias("n")))


def vocabulary(counts: DataFrame, frequent_share: int = FREQUENT) -> Vocabulary:
    """What tasks need of the counts: at most `WORDS` + `ENDINGS` + `LENGTHS` + `frequent_share` rows."""
    first = {r["word"]: r["n"] for r in counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()}
    top = list(first)
    others = counts.filter(~F.col("word").isin(top)) if top else counts
    ends = [r["ending"] for r in others.groupBy("ending").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "ending").limit(ENDINGS).collect()]
    tokens = np.zeros(WORDS + ENDINGS + LENGTHS)
    tokens[:len(top)] = list(first.values())
    top_class, end_class = {w: k for k, w in enumerate(top)}, {e: WORDS + k for k, e in enumerate(ends)}
    by_ending = np.full(1 << 16, -1, np.int32)
    for e, k in end_class.items():
        by_ending[e] = k
    group = F.when(F.col("ending").isin(ends), F.col("ending")).otherwise(-F.col("length")) if ends else -F.col("length")
    for r in others.groupBy(group.alias("g")).agg(F.sum("n").alias("n")).collect():
        tokens[end_class[r["g"]] if r["g"] in end_class else WORDS + ENDINGS - r["g"] - 1] += r["n"]
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = counts.filter(F.col("n") * F.lit(frequent_share) >= F.lit(total)).select("word", "n").toArrow()
    ids, n = (np.asarray(frequent.column(c).to_numpy(), np.int64) for c in ("word", "n"))
    order = np.argsort(ids)
    ids, n = ids[order], n[order]
    return Vocabulary(top_class, by_ending, tokens, ids, n.astype(np.float64))


def _read(words: Broadcast):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = words.value.reader()

        def taken(kept: list[tuple]) -> pa.RecordBatch:
            """Texts of about `CHUNK` words together, or one longer text."""
            read = zip(kept, reader.read([tokens for _, _, tokens in kept]))
            return tx.to_batch([(row, doc_id, len(tokens), cls, within, rare) for (row, doc_id, tokens), (cls, within, rare) in read], _READ)

        for batch in batches:
            kept, held = [], 0
            for row, doc_id, body in tx.rows(batch, "row", "doc_id", "text"):
                kept.append((row, doc_id, tx.words(body)))
                held += len(kept[-1][2])
                if held >= CHUNK:
                    yield taken(kept)
                    kept, held = [], 0
            yield taken(kept)

    return read


def read(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """(row, doc_id, n_tokens, classes, within, rare) per row of docs, written."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    out = cut(rows.mapInArrow(_read(shared), "row long, doc_id long, n_tokens long, classes binary, within double, rare array<long>"))
    shared.destroy()
    return out


class Network:
    """Embeddings by side and distance, a tanh layer, a softmax; all parameters in one vector."""

    def __init__(self, classes: int, flat: np.ndarray | None = None) -> None:
        self.classes = classes
        self.shapes = [(classes + 1, WIDTH), (2 * SIDE * WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, classes), (classes,)]
        if flat is None:
            rng = np.random.default_rng(7)
            flat = np.concatenate([(rng.standard_normal(s) * (0.3 if k == 0 else s[0] ** -0.5 if len(s) == 2 else 0.0)).ravel() for k, s in enumerate(self.shapes)])
        self.flat = flat.astype(np.float32)

    def parts(self, flat: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for s in self.shapes:
            n = int(np.prod(s))
            out.append(flat[at:at + n].reshape(s))
            at += n
        return out

    @staticmethod
    def tame(w2: np.ndarray, b2: np.ndarray) -> bool:
        """Whether no exponential can overflow."""
        return float((np.abs(w2).sum(axis=0) + np.abs(b2)).max()) < 80

    def hidden(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        embed, w1, b1, _, _ = self.parts(self.flat)
        x = embed[around].reshape(len(around), -1)
        return x, np.tanh(x @ w1 + b1)

    def log_probs(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        _, _, _, w2, b2 = self.parts(self.flat)
        logits = self.hidden(around)[1] @ w2 + b2
        logits -= logits.max(axis=1, keepdims=True)
        chosen = logits[np.arange(len(target)), target]
        return chosen - np.log(np.exp(logits, out=logits).sum(axis=1))

    def sequence_log_probs(self, padded: np.ndarray) -> np.ndarray:
        """The same for every place of a run of classes but the `SIDE` at either end, which are seen and not predicted.

        What a neighbour adds to the hidden layer depends on its class and place alone: one small table for each place. Places of
        the edge class are worked out too and mean nothing.
        """
        embed, w1, b1, w2, b2 = self.parts(self.flat)
        n = len(padded) - 2 * SIDE
        tables = [embed @ w1[k * WIDTH:(k + 1) * WIDTH] for k in range(2 * SIDE)]
        steps = [j for j in range(2 * SIDE + 1) if j != SIDE]
        line = np.concatenate([padded, np.zeros(-n % ROWS, padded.dtype)]).astype(np.intp)
        tame, ones = self.tame(w2, b2), np.ones(self.classes, np.float32)
        weights = np.rint(np.vstack([w2, b2]).astype(np.float64) / WEIGHT_STEP) * (WEIGHT_STEP * UNIT_STEP)
        units = np.full((ROWS, HIDDEN + 1), 1 / UNIT_STEP)  # the last one is the bias
        h, seen, logits = np.empty((ROWS, HIDDEN), np.float32), np.empty((ROWS, HIDDEN), np.float32), np.empty((ROWS, self.classes), np.float32)
        exact = np.empty((ROWS, self.classes))
        out, firsts = np.empty(len(line) - 2 * SIDE, np.float32), np.arange(ROWS) * self.classes
        for start in range(0, n, ROWS):
            h[:] = b1
            for table, step in zip(tables, steps):
                h += np.take(table, line[start + step:start + step + ROWS], axis=0, out=seen, mode="clip")
            np.tanh(h, out=h)
            h *= np.float32(1 / UNIT_STEP)
            units[:, :HIDDEN] = np.rint(h, out=h)
            logits[:] = np.matmul(units, weights, out=exact)
            if not tame:
                logits -= logits.max(axis=1, keepdims=True)
            target = np.minimum(line[start + SIDE:start + SIDE + ROWS], self.classes - 1)
            chosen = logits.ravel().take(firsts + target)
            out[start:start + ROWS] = chosen - np.log(np.exp(logits, out=logits) @ ones)
        return out[:n]

    def gradient(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        embed, w1, b1, w2, b2 = self.parts(self.flat)
        n = len(target)
        x = embed.take(around.ravel(), axis=0).reshape(n, -1)
        h = np.empty((n, HIDDEN + 1), np.float32)
        h[:, HIDDEN] = 1  # the bias
        one, h = h, h[:, :HIDDEN]
        np.tanh(x @ w1 + b1, out=h)
        logits = h @ w2
        logits += b2
        if not self.tame(w2, b2):
            logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits, out=logits)
        p *= (1 / (n * (p @ np.ones(self.classes, np.float32))))[:, None].astype(np.float32)
        p.ravel()[np.arange(n) * self.classes + target] -= np.float32(1 / n)
        out = np.zeros_like(self.flat)
        g_embed, g_w1, g_b1, g_w2, g_b2 = self.parts(out)
        top = one.T @ p
        g_w2 += top[:HIDDEN]
        g_b2 += top[HIDDEN]
        back = p @ w2.T * (1 - h * h)
        g_w1 += x.T @ back
        g_b1 += back.sum(axis=0)
        cells = around.ravel()[:, None].astype(np.intp) * WIDTH + np.arange(WIDTH)
        g_embed += np.bincount(cells.ravel(), (back @ w1.T).ravel(), minlength=g_embed.size).reshape(g_embed.shape)
        return out


def _padded(ids: np.ndarray, edge: int) -> np.ndarray:
    return np.concatenate([np.full(SIDE, edge, ids.dtype), ids, np.full(SIDE, edge, ids.dtype)])


def windows(ids: np.ndarray, edge: int, at: np.ndarray) -> np.ndarray:
    """Classes of the tokens around each place, nearest on the left last; `edge` past the ends."""
    padded = _padded(ids, edge)
    steps = np.array([k for k in range(2 * SIDE + 1) if k != SIDE])
    return padded[at[:, None] + steps]


def _lines(batches: Iterable[pa.RecordBatch], edge: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Documents in padded lines of about `limit` tokens, and the places of the tokens; longer documents go in pieces that see across
    their joints."""
    kept, held = [], 0
    for batch in batches:
        for (body,) in tx.rows(batch, "classes"):
            padded = _padded(np.frombuffer(body, np.uint8), edge)
            for start in range(0, len(padded) - 2 * SIDE, limit):
                piece = padded[start:start + limit + 2 * SIDE]
                kept.append(piece)
                held += len(piece) - 2 * SIDE
                if held >= limit:
                    yield _line(kept)
                    kept, held = [], 0
    if kept:
        yield _line(kept)


def _line(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    inner = np.concatenate([np.r_[np.zeros(SIDE, bool), np.ones(len(p) - 2 * SIDE, bool), np.zeros(SIDE, bool)] for p in pieces])
    return np.concatenate(pieces), np.flatnonzero(inner)


def _train(edge: int, k: int, flat: Broadcast, rate: float):
    steps = np.array([j - SIDE for j in range(2 * SIDE + 1) if j != SIDE])

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(edge, flat.value.copy())
        m, v = np.zeros_like(net.flat), np.zeros_like(net.flat)
        order = np.random.default_rng(k)
        step = seen = 0
        for line, places in _lines(batches, edge, 8 * CHUNK):
            at = places[k::ROUNDS]
            at = at[order.permutation(len(at))]
            for start in range(0, len(at), BATCH):
                some = at[start:start + BATCH]
                step += 1
                g = net.gradient(line[some[:, None] + steps], line[some])
                m = np.float32(0.9) * m + np.float32(0.1) * g
                v = np.float32(0.999) * v + np.float32(0.001) * g * g
                scale = np.float32(rate / (1 + step / 400) / (1 - 0.9 ** step))
                net.flat -= scale * m / (np.sqrt(v / np.float32(1 - 0.999 ** step)) + np.float32(1e-8))
            seen += len(at)
        if seen:
            n = len(net.flat)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(net.flat.astype(np.float64) * seen), pa.array(np.full(n, float(seen)))], schema=_PART)

    return train


def fit(encoded: DataFrame, edge: int) -> Network:
    """Rounds of local training over the classes of all documents, and averaging."""
    context = encoded.sparkSession.sparkContext
    net = Network(edge)
    for k in range(ROUNDS):
        shared = context.broadcast(net.flat)
        parts = encoded.select("classes").mapInArrow(_train(edge, k, shared, RATE / (1 + 2 * k)), "cell int, value double, weight double")
        mean = parts.groupBy("cell").agg((F.sum("value") / F.sum("weight")).alias("value")).collect()  # one row per parameter
        shared.destroy()
        if mean:
            flat = np.zeros(len(net.flat))
            for r in mean:
                flat[r["cell"]] = r["value"]
            net = Network(edge, flat)
    return net


def document_score(net: Network, ids: np.ndarray) -> float:
    """Sum over a document's tokens of the log-probabilities of their classes, in pieces of bounded size that see across their joints."""
    padded = _padded(ids, net.classes)
    return sum(float(net.sequence_log_probs(padded[start:start + CHUNK + 2 * SIDE]).sum(dtype=np.float64)) for start in range(0, len(ids), CHUNK))


def _score(net: Broadcast):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = net.value
        for batch in batches:
            found, held, runs = [], 0, []

            def flush() -> None:
                """Short documents go through the network together."""
                if not runs:
                    return
                line = np.concatenate([_padded(r[3], network.classes) for r in runs])
                costs = network.sequence_log_probs(line)
                starts = np.cumsum([0] + [len(r[3]) + 2 * SIDE for r in runs[:-1]])
                bounds = np.stack([starts, starts + [len(r[3]) for r in runs]], axis=1).ravel()
                sums = np.add.reduceat(np.append(costs, 0.0), bounds, dtype=np.float64)[::2]
                found.extend((row, d, len(ids), float(x) + within) for (row, d, within, ids), x in zip(runs, sums))
                runs.clear()

            for row, doc_id, within, body in tx.rows(batch, "row", "doc_id", "within", "classes"):
                ids = np.frombuffer(body, np.uint8)
                if not len(ids):
                    found.append((row, doc_id, 0, 0.0))
                elif len(ids) >= CHUNK:
                    found.append((row, doc_id, len(ids), document_score(network, ids) + within))
                else:
                    runs.append((row, doc_id, within, ids))
                    held += len(ids)
                    if held >= 16 * ROWS:
                        flush()
                        held = 0
            flush()
            yield tx.to_batch(found, _SCORE)

    return score


def scores(docs: DataFrame, frequent_share: int = FREQUENT) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, log_prob (sum over tokens), mean_log_prob (null without tokens)."""
    bounded_batches(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    counts = word_counts(rows)
    words = vocabulary(counts, frequent_share)
    encoded = read(rows, words)
    net = docs.sparkSession.sparkContext.broadcast(fit(encoded, words.size))
    known = encoded.select("row", "doc_id", "within", "classes").mapInArrow(_score(net), "row long, doc_id long, n_tokens long, log_prob double")
    # A word that occurs once adds log 1. Whole numbers add up the same in any order.
    logs = counts.filter("n > 1").select("word", F.round(F.log("n") * UNIT).cast("long").alias("log_n"))
    rare = encoded.select("row", F.explode("rare").alias("word")).join(logs, "word").groupBy("row").agg((F.sum("log_n") / UNIT).alias("rare"))
    out = known.join(rare, "row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("rare", F.lit(0.0)))
    return out.select("doc_id", "n_tokens", "log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob"))
