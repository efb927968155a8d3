"""Toxic documents: a lexicon trie read through Levenshtein automata, with context windows that tell quotation from abuse.

The lexicon is a short fixed list of insults plus what labelled documents teach: words, and stems that many words begin with,
which stand in many different contexts of toxic documents and in hardly any of clean ones. Contexts (the two neighbours) are counted
instead of documents so that a hundred copies of a document teach no more than one. The trie of the terms is walked together with the
Levenshtein automaton of the word read; the pairs (node, edits) reached so far form one state of an automaton that is built as words
need it, so that most words end after two or three characters. A word that clean documents use is never a misspelling. A stem adds
whatever begins with it; the words and insults under it stay in the trie with their edits.

Each hit weighs less where it is quoted or reported (quotation marks around it, or a word of saying just before it). A logistic
regression on five features of a document's hits gives the score. It is fitted on a bounded sample of labelled rows
(`SAMPLE_PER_LABEL`); scoring reads every whole text.

Defined results: a null, empty or wordless text has no hits and scores what a text without hits scores. Without labelled rows
of both kinds the fixed list and fixed coefficients score. Rows that repeat count as they stand; labels that repeat a doc_id count
as toxic if one of them says so; null labels are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinora.llm import text as tx
from affinora.llm.cut import bounded_batches, cut

#: Labelled documents that the classifier learns from, for either label.
SAMPLE_PER_LABEL = 3000
STEMS = (4, 5, 6)
#: A term's contexts would all be toxic by chance with a probability under exp(-CHANCE); and the share of toxic ones that it needs.
CHANCE, LEAST_SHARE = 16.0, 0.93

# Insults of four languages.
INSULTS = (
    "idiot", "moron", "stupid", "trash", "scum", "loser", "worthless", "pathetic", "clown", "disgusting",
    "imbecile", "bastard", "asshole", "bitch", "fuck", "cunt", "retard",
    "arschloch", "wichser", "hurensohn", "schlampe", "connard", "salope", "enculé", "cabrón", "gilipollas", "pendejo",
)
# Words that report what someone said.
REPORTING = frozenset((
    "said", "says", "say", "wrote", "writes", "called", "calls", "quoted", "quote", "quotes", "term", "word", "words", "slur", "replied",
    "sagte", "sagt", "schrieb", "nannte", "zitat", "wort", "dit", "disait", "écrit", "appelé", "mot", "dijo", "dice", "escribió", "llamó", "palabra",
))
# Look-alikes of letters.
LOOKALIKES = str.maketrans("013457@$", "oieastas")
OPENING, CLOSING = "\"'“„«‘‚‹", "\"'”“»’‘›"
EDGES = ".,;:!?\"'()[]{}<>|/\\#%&*-_+=~^`…“”„«»‘’‚‹›¡¿"
#: Words before and after a hit that its context holds.
WINDOW = 6
#: Distinct words whose matches a task remembers, and pairs and moves of the automaton it keeps: beyond, it starts afresh.
REMEMBERED, KEPT = 100_000, 1_000_000


def edits_allowed(term: str, stem: bool) -> int:
    if stem or len(term) < 5:
        return 0
    return 1 if len(term) < 9 else 2


def plain(token: str) -> str:
    """A token of lower-case text without punctuation at its ends."""
    return token.strip(EDGES)


class Lexicon:
    """Terms in a trie, and the automaton of all (node, edits) pairs that a word's beginning can stand for."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float], known: frozenset[str] = frozenset()) -> None:
        self.weights, self.known = {**stems, **terms}, known
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[str, int] | None] = [None]
        self.stems: dict[int, str] = {}
        self.reach: list[int] = [0]
        for term, stem in [(t, False) for t in terms] + [(t, True) for t in stems]:
            node, k = 0, edits_allowed(term, stem)
            self.reach[0] = max(self.reach[0], k)
            for ch in term:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.reach.append(0)
                node = self.children[node][ch]
                self.reach[node] = max(self.reach[node], k)
            if stem:
                self.stems[node] = term
            if self.ends[node] is None:
                self.ends[node] = (term, k)
        self.found: dict[str, tuple[str, int] | None] = {}
        self._afresh()

    def _afresh(self) -> None:
        """The automaton with its first state only; it never holds more than `KEPT` and what one word adds."""
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.stem_at: list[str | None] = []
        self.final: list[tuple[str, int] | None] = []
        self.held = 0
        self.start = self._state(self._closure({0: 0}))

    def _closure(self, least: dict[int, int]) -> dict[int, int]:
        """Adds the nodes reached by leaving out letters of the term."""
        queue = list(least)
        while queue:
            node = queue.pop()
            for child in self.children[node].values():
                cost = least[node] + 1
                if cost <= self.reach[child] and cost < least.get(child, 99):
                    least[child] = cost
                    queue.append(child)
        return least

    def _state(self, least: dict[int, int]) -> int:
        key = frozenset(least.items())
        if key not in self.states:
            self.states[key] = len(self.members)
            self.members.append(key)
            self.held += len(key)
            self.moves.append({})
            stems = [self.stems[n] for n, e in key if e == 0 and n in self.stems]
            self.stem_at.append(stems[0] if stems else None)
            ends = [(e, self.ends[n][0]) for n, e in key if self.ends[n] and e <= self.ends[n][1]]
            self.final.append((min(ends)[1], min(ends)[0]) if ends else None)
        return self.states[key]

    def _move(self, state: int, ch: str) -> int:
        least: dict[int, int] = {}
        for node, e in self.members[state]:
            follow = self.children[node].get(ch)
            if follow is not None and e < least.get(follow, 99):
                least[follow] = e
            if e + 1 <= self.reach[node] and e + 1 < least.get(node, 99):  # a letter too many
                least[node] = e + 1
            for child in self.children[node].values():  # another letter
                if child != follow and e + 1 <= self.reach[child] and e + 1 < least.get(child, 99):
                    least[child] = e + 1
        return self._state(self._closure(least)) if least else -1

    def read(self, word: str) -> tuple[str, int] | None:
        """The term that the word is or begins with, or else the nearest one, with its edits."""
        if self.held > KEPT:
            self._afresh()
        state = self.start
        stem = None
        for ch in word:
            moves = self.moves[state]
            nxt = moves.get(ch)
            if nxt is None:
                nxt = moves[ch] = self._move(state, ch)
                self.held += 1
            if nxt < 0:
                return (stem, 0) if stem else None
            state = nxt
            stem = stem or self.stem_at[state]
        end = self.final[state]
        if stem and (end is None or end[1] > 0):
            return stem, 0
        return None if end and end[1] and word in self.known else end

    def match(self, token: str) -> tuple[str, int] | None:
        """For a lower-case token of a text; look-alikes are read as letters if the plain reading is no term."""
        if token in self.found:
            return self.found[token]
        word = plain(token)
        hit = self.read(word) if word else None
        if word and (hit is None or hit[1]) and not word.isdigit() and (other := token.translate(LOOKALIKES).strip(EDGES)) != word:
            second = self.read(other)
            hit = second if second and (hit is None or second[1] < hit[1]) else hit
        if len(self.found) >= REMEMBERED:
            self.found.clear()
        self.found[token] = hit
        return hit


def quoted(tokens: list[str], at: int) -> bool:
    """Whether the word stands between quotation marks or shortly after a word of saying."""
    before, after = tokens[max(0, at - WINDOW):at + 1], tokens[at:at + WINDOW + 1]
    opened = any(t[0] in OPENING for t in before) and any(t.rstrip(".,;:!?")[-1:] and t.rstrip(".,;:!?")[-1] in CLOSING for t in after)
    return opened or any(plain(t) in REPORTING for t in before[-4:-1])


def features(text: str | None, lexicon: Lexicon) -> tuple[list[float], list[str]]:
    """Strongest hit, all hits, hits per word, share quoted, share misspelled; and the terms found."""
    tokens = text.lower().split() if text else []
    hits = {t: h for t in set(tokens) if (h := lexicon.match(t))}
    if not hits:
        return [0.0] * 5, []
    strongest = total = 0.0
    n = quotes = misspelled = 0
    for at, token in enumerate(tokens):
        if hit := hits.get(token):
            n += 1
            weight = lexicon.weights[hit[0]] * 0.7 ** hit[1]
            if quoted(tokens, at):
                quotes += 1
                weight *= 0.2
            misspelled += hit[1] > 0
            strongest, total = max(strongest, weight), total + weight
    return [strongest, math.log1p(total), math.log1p(100.0 * total / len(tokens)), quotes / n, misspelled / n], sorted({h[0] for h in hits.values()})


@dataclass
class Model:
    lexicon: Lexicon
    #: Intercept and one coefficient for each feature.
    weights: np.ndarray = field(default_factory=lambda: np.array([-4.0, 6.0, 1.0, 0.5, -1.0, -0.5]))

    def score(self, text: str | None) -> tuple[float, list[str]]:
        values, terms = features(text, self.lexicon)
        z = float(self.weights[0] + np.dot(self.weights[1:], values))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z)))), terms


_TERM = pa.schema([("term", pa.string()), ("stem", pa.bool_()), ("toxic", pa.int32()), ("context", pa.int64())])


def _terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        for batch in batches:
            for body, toxic in tx.rows(batch, "text", "toxic"):
                tokens = [w for t in (body or "").lower().split() if (w := plain(t))]
                padded = ["", *tokens, ""]
                for k, w in enumerate(tokens):
                    context = hash_context(padded[k], padded[k + 2])
                    yield w, False, toxic, context
                    for n in STEMS:
                        if len(w) > n:
                            yield w[:n], True, toxic, context

    yield from tx.in_batches(found(), _TERM, 50_000)


def hash_context(before: str, after: str) -> int:
    return int(tx.word_hashes([f"{before} {after}".encode()])[0]) >> 1


def sample(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """(doc_id, text, toxic) of about `per_label` labelled training rows of either label, picked by a hash of the doc_id."""
    said = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    said = said.filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    said = said.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    counts = {r["toxic"]: r["count"] for r in said.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    share = lambda toxic: int((1 << 20) * min(1.0, per_label / counts.get(toxic, 1)))
    picked = said.filter(place < F.when(F.col("toxic") == 1, share(1)).otherwise(share(0)))
    # About 2 x per_label rows of 12 bytes: a proven bound.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")


def learn_terms(rows: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems with weights up to 1, from (text, toxic): all that pass, so the sample bounds them."""
    counted = rows.select("text", "toxic").mapInArrow(_terms, "term string, stem boolean, toxic int, context long")
    counted = counted.groupBy("term", "stem", "context").agg(F.max("toxic").alias("toxic"), F.min("toxic").alias("clean"))
    counted = counted.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("clean")).alias("clean"))
    share = (F.col("toxic") + 0.5) / (F.col("toxic") + F.col("clean") + 1.0)
    base = rows.agg(F.avg("toxic")).first()[0] or 0.0
    least = CHANCE / -math.log(min(max(base, 1e-3), 0.8))
    kept = counted.filter(F.col("toxic") >= least).filter(share >= LEAST_SHARE)
    top = kept.select("term", "stem", share.alias("share"), "toxic").orderBy(F.desc("toxic"), "term", "stem").collect()
    stems: dict[str, float] = {}
    for r in sorted((r for r in top if r["stem"]), key=lambda r: len(r["term"])):
        if not any(r["term"].startswith(s) for s in stems):
            stems[r["term"]] = float(r["share"])
    words = {r["term"]: float(r["share"]) for r in top if not r["stem"]}
    # A stem that only one word has is that word.
    endings = Counter(s for w in words for s in stems if w.startswith(s))
    stems = {s: v for s, v in stems.items() if endings[s] != 1}
    return {w: v for w, v in words.items() if len(w) >= 3}, stems


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; both labels weigh the same."""
    x = np.hstack([np.ones((len(x), 1)), x])
    case = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    damp = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (case * np.maximum(p * (1 - p), 1e-6))) @ x + damp, x.T @ (case * (y - p)) - damp @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Learn from labelled rows whose crc32(doc_id as text) mod 5 is not 0."""
    bounded_batches(docs)
    rows = cut(sample(docs, labels, per_label).select("text", "toxic"))
    terms, stems = learn_terms(rows)
    fixed = {t: 0.95 for t in INSULTS if t not in terms}
    first = Lexicon(terms | fixed, stems)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(first)
    near = rows.filter("toxic = 0").select(F.explode(_near_words(shared)(F.col("text"))).alias("word")).groupBy("word").count()
    # Words of clean sampled documents within the edits of a term: bounded by the sample.
    lexicon = Lexicon(terms | fixed, stems, frozenset(r["word"] for r in near.filter("count >= 2").collect()))
    shared = context.broadcast(lexicon)
    seen = rows.select(_features(shared)(F.col("text")).alias("x"), "toxic").collect()
    y = np.array([r["toxic"] for r in seen])
    if not len(y) or y.min() == y.max():
        return Model(lexicon)
    return Model(lexicon, _fit(np.array([r["x"] for r in seen]), y))


def _near_words(lexicon: Broadcast):
    def near(texts: pd.Series) -> pd.Series:
        read = lexicon.value
        return pd.Series([sorted({plain(t) for t in set((x or "").lower().split()) if (h := read.match(t)) and h[1]}) for x in texts], dtype=object)

    return F.pandas_udf(near, "array<string>")


def _features(lexicon: Broadcast):
    def values(texts: pd.Series) -> pd.Series:
        return pd.Series([features(x, lexicon.value)[0] for x in texts], dtype=object)

    return F.pandas_udf(values, "array<double>")


def scored(model: Model, docs: DataFrame, text: Column) -> Column:
    """Struct of score (0 to 1) and terms."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.score(x) for x in texts]
        return pd.DataFrame({"score": [s for s, _ in found], "terms": [",".join(t) for _, t in found]})

    return F.pandas_udf(score, "score double, terms string")(text)


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, held_out, score, predicted, terms (sorted, comma-joined)."""
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    rows = rows.select("doc_id", scored(model, rows, F.col("text")).alias("s"))
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), F.col("s.score").alias("score"),
                       (F.col("s.score") >= 0.5).cast("int").alias("predicted"), F.col("s.terms").alias("terms"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score below 0.5, with all their columns."""
    model = fit(docs, labels)
    return docs.filter(scored(model, docs, docs["text"])["score"] < 0.5)
