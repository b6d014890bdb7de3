"""Operator 9, quality classifier: a weak-label model over heuristic labellers trains a hashed linear scorer.

Overlapping heuristic labellers vote good, bad or abstain on each document; most look for one fault and abstain without it. All documents are grouped by their vote
pattern (at most 3**9 patterns, whatever the corpus size); expectation-maximisation over the weighted patterns estimates
how each labeller votes on good and on bad documents, and gives each pattern a posterior. A logistic scorer over hashed
word shapes and short words is fitted to the posteriors of a bounded sample (train_docs documents, the first in hash
order) and scores every document.

Defined results: null text is empty; a document without words has no evidence, so it gets the prior and is accepted;
repeated rows are scored each; an empty table gives an empty result; texts are read whole; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, hash_sample, materialize, prune, scratch_scope, tidy

HASHED = 2046
_STUTTER, _AGAIN, DIMS = HASHED, HASHED + 1, HASHED + 2
GOOD, BAD, ABSTAIN = 1, 0, 2
LABELLERS = ["decorated", "capitals", "shouting", "separators", "symbols", "repeated_lines", "function_words", "dominant_word", "stutter"]
# Frequent function words of the languages at hand.
FUNCTION_WORDS = frozenset(
    "the of and to in a is that it with for as was on be by this are or from at der die und den das von zu mit sich des auf ist im dem nicht ein eine als auch es an "
    "de la le et les des en un du une que est pour qui dans par sur au el los y se las por con no su para al lo como más o".split()
)
_DECORATED = re.compile(r"([^\w\s.,;:'\"-])\1{2}")
_CLASSES = re.compile(r"([a-zß-ÿ]+)|([A-ZÀ-Þ]+)|([0-9]+)")
_SHOUT = re.compile(r"[!?]{2}")
_CACHE_WORDS = 200_000  # about 40 MB
SHORT = 8  # words


def shape(word: str) -> str:
    """Letters and digits collapsed to a, A and 0; other characters stay; at most 12 characters."""
    return _CLASSES.sub(lambda m: "a" if m[1] else "A" if m[2] else "0", word[:64])[:12]


_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")
_PLAIN_SHAPE = zlib.crc32(b"sa") % HASHED
_WORD = ["shape", "short", "letters", "capitals", "symbols", "decorated", "shouting", "function", "chars", "separator"]


class _Words:
    """Numbers for words, with a row of what each word adds (_WORD), for words seen lately in this worker."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, len(_WORD)), np.int32)

    def _row(self, w: str) -> tuple:
        if len(w) > 4 and _PLAIN.fullmatch(w):  # most words
            return (_PLAIN_SHAPE, -1, len(w), 0, 0, 0, 0, w in FUNCTION_WORDS, len(w), 0)
        letters = sum(map(str.isalpha, w))
        short = zlib.crc32(b"w" + w.lower().encode()) % HASHED if len(w) <= 4 else -1
        return (
            zlib.crc32(b"s" + shape(w).encode()) % HASHED, short, letters, sum(map(str.isupper, w)), len(w) - letters - sum(map(str.isdigit, w)), bool(_DECORATED.search(w)),
            bool(_SHOUT.search(w)), w.strip(".,;:!?\"'()").lower() in FUNCTION_WORDS, len(w), not any(map(str.isalnum, w)),
        )

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self.known) > _CACHE_WORDS:
            self.__init__()
        known = self.known
        if new := list(set(words).difference(known)):
            at = len(known)
            while at + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[at : at + len(new)] = list(map(self._row, new))
            known.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def votes_and_features(texts: list[str | None], words: _Words) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """For each text its number of words, its votes, and its features as sorted indices and values."""
    runs = [(t or "").split() for t in texts]
    count = np.array([len(r) for r in runs], np.int64)
    n, docs = np.maximum(count, 1), np.repeat(np.arange(len(runs)), count)
    ids = words(list(chain.from_iterable(runs)))
    row = words.rows
    pairs, times = np.unique(docs * len(row) + ids, return_counts=True)  # distinct words of each text
    doc, word = pairs // len(row), pairs % len(row)
    total = {c: np.bincount(doc, times * row[word, j], len(runs)) for j, c in enumerate(_WORD) if j > 1}
    most = np.zeros(len(runs), np.int64)
    np.maximum.at(most, doc, times)
    stutter = np.bincount(docs[1:], (ids[1:] == ids[:-1]) & (docs[1:] == docs[:-1]), len(runs)) / n
    again, lines = np.zeros(len(runs)), np.zeros(len(runs), np.int64)
    for i, t in enumerate(texts):
        if t and "\n" in t:
            long = [x for x in t.split("\n") if len(x) > 20]
            lines[i], again[i] = len(long), 1 - len(set(long)) / len(long) if long else 0.0
    few, any_ = count < SHORT, count > 0

    def fault(value: np.ndarray, bad_from: float, sure_when_short: bool = False) -> np.ndarray:
        return np.where((value >= bad_from) & any_ & (~few | sure_when_short), BAD, ABSTAIN)

    function = total["function"] / n
    votes = np.stack([
        fault(total["decorated"] / n, 0.15, True), fault(total["capitals"] / np.maximum(total["letters"], 1), 0.4), fault(total["shouting"] / n, 0.15), fault(total["separator"] / n, 0.15),
        fault(total["symbols"] / np.maximum(total["chars"], 1), 0.3), np.where(lines > 4, fault(again, 0.6), ABSTAIN),
        np.where(count < 30, ABSTAIN, np.where((function >= 0.08) & (stutter < 0.05), GOOD, np.where(function < 0.005, BAD, ABSTAIN))), fault(most / n, 0.25), fault(stutter, 0.2),
    ], axis=1).astype(np.uint8)
    has = row[word, 1] >= 0
    keys, at = np.unique(np.concatenate([doc * DIMS + row[word, 0], doc[has] * DIMS + row[word[has], 1]]), return_inverse=True)
    value = np.bincount(at, np.concatenate([times, times[has]]), len(keys)) / n[keys // DIMS]
    own = np.flatnonzero(any_)
    keys = np.concatenate([keys, own * DIMS + _STUTTER, own * DIMS + _AGAIN])
    value = np.concatenate([value, stutter[own], again[own]]).astype(np.float32)
    order = np.argsort(keys, kind="stable")
    cut = np.searchsorted(keys[order], np.arange(1, len(runs)) * DIMS)
    return count, votes, np.split((keys[order] % DIMS).astype(np.int32), cut), np.split(value[order], cut)


def _slices(texts: pd.Series, size: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Runs of texts of about size characters."""
    at = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= size:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, votes and sparse hashed features of every document, in one pass over the texts."""

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for df in frames:
            for i, j in _slices(df["text"]):
                n, votes, idx, val = votes_and_features(df["text"].iloc[i:j].tolist(), words)
                yield pd.DataFrame({"doc_id": df["doc_id"].iloc[i:j].to_numpy(), "n_words": n, "votes": [v.tobytes() for v in votes], "idx": idx, "val": val})

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {ids}, n_words long, votes binary, idx array<int>, val array<float>")


class WeakLabels:
    """Labellers that vote independently given the class, each with its own vote probabilities for both classes."""

    def __init__(self, rounds: int = 100, prior: float = 0.8):
        self.rounds, self.prior = rounds, prior

    def fit(self, patterns: np.ndarray, counts: np.ndarray) -> WeakLabels:
        n, m = patterns.shape
        good, bad = (patterns == GOOD).sum(1), (patterns == BAD).sum(1)
        post = np.where(good + bad == 0, self.prior, (good + 0.1) / (good + 4 * bad + 0.2))  # each labeller looks for one fault: one bad vote outweighs a good one
        hot = np.stack([patterns == v for v in (BAD, GOOD, ABSTAIN)], axis=2).astype(float)
        for _ in range(self.rounds):
            w1, w0 = counts * post, counts * (1 - post)
            self.prior = float((w1.sum() + 4) / (counts.sum() + 5))
            self.given = np.stack([np.einsum("n,nmv->mv", w, hot) + 0.1 for w in (w0, w1)])
            self.given /= self.given.sum(2, keepdims=True)
            after = self.posterior(patterns)
            if np.abs(after - post).max() < 1e-9:
                break
            post = after
        return self

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Of good. Where all abstain, which is a matter of length, there is no evidence and the prior stands."""
        s = np.log(self.given[:, np.arange(patterns.shape[1]), patterns]).sum(2)
        odds = s[1] - s[0] + np.log(self.prior / (1 - self.prior))
        return np.where((patterns == ABSTAIN).all(1), self.prior, 1 / (1 + np.exp(-np.clip(odds, -40, 40))))

    def accuracies(self) -> dict[str, float]:
        """Share of right votes among the votes that a labeller casts."""
        p = np.array([1 - self.prior, self.prior])
        right = self.given[0, :, BAD] * p[0] + self.given[1, :, GOOD] * p[1]
        cast = (self.given[:, :, :2].sum(2) * p[:, None]).sum(0)
        return dict(zip(LABELLERS, np.round(right / cast, 4).tolist(), strict=True))


def fit_scorer(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 1.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full-batch gradient steps with momentum; classes weigh the same."""
    w, b, vw, vb = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    share = float(np.clip(y.mean(), 0.02, 0.98))
    weight = y / share + (1 - y) / (1 - share)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -40, 40)))
        g = weight * (p - y) / len(y)
        vw, vb = 0.9 * vw + x.T @ g + decay * w, 0.9 * vb + g.sum()
        w, b = w - rate * vw, b - rate * vb
    return w, b


class QualityModel:
    def __init__(self, labels: WeakLabels, w: np.ndarray, b: float):
        self.labels, self.w, self.b = labels, w, b


def fit(described: DataFrame, train_docs: int = 4000) -> QualityModel:
    """The vote patterns of all documents and the features of at most train_docs of them reach the driver."""
    patterns = described.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    if not patterns:
        return QualityModel(WeakLabels(), np.zeros(DIMS), 0.0)
    votes = np.array([list(r.votes) for r in patterns])
    labels = WeakLabels().fit(votes, np.array([r.n for r in patterns], float))
    rows = hash_sample(described.where(F.col("n_words") >= SHORT), ["doc_id", "votes"], train_docs).collect()
    if not rows:
        return QualityModel(labels, np.zeros(DIMS), 0.0)
    x = np.zeros((len(rows), DIMS))
    for i, r in enumerate(rows):
        x[i, r.idx] = r.val
    return QualityModel(labels, *fit_scorer(x, labels.posterior(np.array([list(r.votes) for r in rows]))))


def score(described: DataFrame, model: QualityModel, threshold: float = 0.5) -> DataFrame:
    labels, w, b = model.labels, model.w, model.b
    prior = float(np.log(labels.prior / (1 - labels.prior)))

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            if not len(df):
                continue
            votes = np.array([list(v) for v in df["votes"]])
            raw = np.array([float(w[np.asarray(i, int)] @ np.asarray(v, float)) + b for i, v in zip(df["idx"], df["val"], strict=True)])
            n = df["n_words"].to_numpy(float)
            trust = n / (n + SHORT)  # a few words say little: the rest comes from the prior
            p = 1 / (1 + np.exp(-np.clip(trust * raw + (1 - trust) * prior, -40, 40)))
            yield pd.DataFrame({"doc_id": df["doc_id"], "posterior": np.round(labels.posterior(votes), 6), "score": np.round(p, 6), "accepted": (p >= threshold) | (n == 0)})

    ids = described.schema["doc_id"].dataType.simpleString()
    return described.mapInPandas(run, f"doc_id {ids}, posterior double, score double, accepted boolean")


def classify(docs: DataFrame, train_docs: int = 4000, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, posterior of the weak-label model, score of the linear scorer, accepted."""
    described = materialize(describe(docs), "quality")
    return score(described, fit(described, train_docs), threshold)


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    with scratch_scope(docs.sparkSession):
        rejected = materialize(classify(docs).where("not accepted").select("doc_id"), "rejected", outlive=True)
    return prune(docs, rejected, rejected.count())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir))
