"""Toxicity: subword embeddings averaged into a linear softmax, trained in numpy.

A word is the bag of its character n-grams and itself, hashed to ``BUCKETS``
rows of an embedding table; its vector is their mean, so that a misspelling
never seen shares most of its vector with the word meant.  A passage is the mean
of its words, and a linear softmax tells the two classes.  Table and softmax
are trained together.

A few words make a long text toxic, and a mean over the whole would drown them.
So a document counts as its most toxic passage of ``SPAN`` words, every
passage of the text, half overlapping, being looked at.  Training starts with
whole documents and then goes on with the passages that the model finds most
toxic in each, again and again; a last logistic step turns the passage's margin
into a probability.

The model is fitted on ``SAMPLE`` labelled rows of each class at most, those
with the least hash of their id; a larger sample adds little, and the bound
keeps the fit's memory fixed.  Every row is scored, over its whole text, from
the text alone.

Words of fewer than ``LEAST_DOCS`` fitted texts have no say in the fit; they are
scored by the n-grams that they share with others.

Defined cases: null and empty texts have no passage and get the score of margin
0.  Without any labelled row all scores are 1 / (1 + e ** 30), next to 0; with one
class only, they are next to that class.  Labels of one document that conflict
count as toxic; of several texts with a labelled id the first in order is fitted.
A null id is held out never, and a row without a label is scored like any other.
Repeated rows get equal scores; an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import full_text, own_id, plain_id, table

BUCKETS = 1 << 16
DIMENSIONS = 8
GRAMS = (3, 4, 5)
SPAN = 2
SAMPLE = 1500
FOLDS = 5
LEAST_DOCS = 5
FIRST_ROUNDS, ROUNDS, TURNS = 30, 25, 6
RATE = 0.5
PUNCTUATION = ".,;:!?\"'()[]{}<>«»„“”‘’-–—…¡¿*_~#/\\|"
MOST_WORDS = 600_000


def words_of(text: str) -> list[str]:
    return text.lower().split()


def buckets(word: str) -> list[int]:
    """Rows of a word's n-grams and of itself."""
    bare = word.strip(PUNCTUATION) or word
    marked = f"<{bare}>"
    grams = {marked} | {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in sorted(grams)]


class Model:
    """embedding (BUCKETS, DIMENSIONS), softmax (DIMENSIONS, 2), and slope, shift of the margin."""

    def __init__(self, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.embedding = np.zeros((BUCKETS, DIMENSIONS))
        self.softmax = rng.normal(0, 1 / np.sqrt(DIMENSIONS), (DIMENSIONS, 2))
        self.slope, self.shift = 1.0, 0.0

    def margins(self) -> np.ndarray:
        """Of each n-gram: how much it speaks for toxic."""
        return self.embedding @ (self.softmax[:, 1] - self.softmax[:, 0])


class WordMargins(dict):
    """Margin of each word, found when first asked for."""

    def __init__(self, grams: np.ndarray) -> None:
        super().__init__()
        self.grams = grams

    def __missing__(self, word: str) -> float:
        x = self[word] = float(self.grams[buckets(word)].mean())
        return x


def passages(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 word of each passage of n words."""
    starts = np.arange(0, max(n - SPAN // 2, 1), SPAN // 2)
    return starts, np.minimum(starts + SPAN, n)


def most_toxic(margins: np.ndarray) -> tuple[float, int]:
    """(margin, number) of the passage with the greatest mean."""
    starts, ends = passages(len(margins))
    sums = np.concatenate(([0.0], np.cumsum(margins)))
    means = (sums[ends] - sums[starts]) / (ends - starts)
    k = int(means.argmax())
    return float(means[k]), k


def fit(texts: list[str], labels: list[int]) -> Model:
    model, y = Model(), np.array(labels)
    if len(set(labels)) < 2:
        model.slope, model.shift = 0.0, 30.0 if labels and labels[0] else -30.0
        return model
    docs = [words_of(t) for t in texts]
    spread = Counter(w for d in docs for w in set(d))
    known = {w: i for i, w in enumerate(sorted(w for w, n in spread.items() if n >= LEAST_DOCS))}
    numbers = [np.array([known.get(w, -1) for w in d], np.int64) for d in docs]
    own = [buckets(w) for w in known]
    sizes = np.array([len(b) for b in own])
    flat, of = np.concatenate([np.array(b) for b in own]), np.repeat(np.arange(len(own)), sizes)
    steps = [np.full((BUCKETS, DIMENSIONS), 1e-8), np.full((DIMENSIONS, 2), 1e-8)]

    def word_vectors() -> np.ndarray:
        return np.stack([np.bincount(of, model.embedding[flat, j], len(own)) for j in range(DIMENSIONS)], axis=1) / sizes[:, None]

    def train(parts: list[np.ndarray], labels: np.ndarray, rounds: int) -> None:
        lengths = np.array([max(len(p), 1) for p in parts])
        word = np.concatenate(parts)
        part = np.repeat(np.arange(len(parts)), [len(p) for p in parts])[word >= 0]
        word = word[word >= 0]
        share = 1 / lengths[part]
        weight = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
        for _ in range(rounds):
            vectors = word_vectors()
            scores = vectors @ model.softmax
            logits = np.stack([np.bincount(part, scores[word, c] * share, len(parts)) for c in (0, 1)], axis=1)
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - np.eye(2)[labels]) * weight[:, None]
            by_word = np.stack([np.bincount(word, g[part, c] * share, len(own)) for c in (0, 1)], axis=1)
            by_vector = by_word @ model.softmax.T / sizes[:, None]
            grads = [np.stack([np.bincount(flat, by_vector[of, j], BUCKETS) for j in range(DIMENSIONS)], axis=1), vectors.T @ by_word]
            for value, grad, step in zip((model.embedding, model.softmax), grads, steps, strict=True):
                step += grad**2
                value -= RATE * grad / np.sqrt(step)

    def margins() -> np.ndarray:
        return np.append(word_vectors() @ (model.softmax[:, 1] - model.softmax[:, 0]), 0.0)  # the last: unknown words

    train(numbers, y, FIRST_ROUNDS)
    for _ in range(TURNS):
        by_word, chosen, at = margins(), [], []
        for k, d in enumerate(numbers):
            if len(d):
                j = most_toxic(by_word[d])[1]
                a, b = passages(len(d))
                chosen.append(d[a[j] : b[j]])
                at.append(k)
        train(chosen, y[at], ROUNDS)
    words = WordMargins(model.margins())
    x = np.array([most_toxic(np.array([words[w] for w in d]))[0] if d else 0.0 for d in docs])
    scale = x.std() or 1.0
    slope, shift = 1.0, 0.0
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    for _ in range(2000):
        g = (1 / (1 + np.exp(-(slope * x / scale + shift))) - y) * weight
        slope, shift = slope - 2 * ((g * x / scale).sum() + 1e-3 * slope), shift - 2 * g.sum()
    model.slope, model.shift = slope / scale, shift
    return model


def fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[str, int]]:
    """(text, label) of at most ``sample`` rows of each class that aren't held out."""
    known = labels.filter(F.col("toxic").isin(0, 1) & (fold() != 0)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = []
    for c in (0, 1):
        own = known.filter(F.col("toxic") == c).select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h").limit(sample)
        texts = docs.select("doc_id", full_text().alias("text")).join(F.broadcast(own), "doc_id")  # ``sample`` rows at most
        rows += sorted((x["h"], x["text"], c) for x in texts.groupBy("h").agg(F.min("text").alias("text")).collect())  # ``sample`` rows at most
    return [(t, c) for _, t, c in rows]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for each row of ``docs``."""
    grams, slope, shift = model.margins(), model.slope, model.shift

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordMargins(grams)
        for b in batches:
            out = []
            for t in b["text"]:
                own = words_of(t)
                out.append(most_toxic(np.fromiter(map(words.__getitem__, own), np.float64, len(own)))[0] if own else 0.0)
                if len(words) > MOST_WORDS:
                    words.clear()
            z = np.clip(slope * np.array(out, np.float64) + shift, -500, 500)
            yield pd.DataFrame({"doc_id": b["doc_id"], "no_id": b["no_id"], "score": 1 / (1 + np.exp(-z))})

    scored = docs.select(*plain_id(), full_text().alias("text")).mapInPandas(run, "doc_id long, no_id boolean, score double")
    return scored.select(own_id(), "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = training_rows(docs, table(spark, sf_dir, "labels"))
    model = fit([t for t, _ in rows], [c for _, c in rows])
    scored = score(docs, model)
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))
