"""Operator 6, personal data: high-recall candidates, gradient-boosted trees, calibrated thresholds.

Base spans (email, ip, card, phone) are found by their fixed patterns and always stay. Generators with looser patterns
propose further, overlapping spans: spelled-out addresses, phone numbers without a plus sign, long numbers that fail the
check digit, labelled ids. Each belongs to a family with a validator of its own (the strict pattern, Luhn's check digit,
IBAN's remainder), and what a validator looks at is hidden from the trees: they see the words, the numbers and the other
personal data around a candidate and the coarse format that all of a family share. So labels (valid or not) and features
are separate views. Candidates that fail their validator are unlabelled rather than negative, so scores are corrected as
for learning from positive and unlabelled examples: isotonic steps on the held-out half give how often candidates with
such a score are valid, and that over the same figure among held-out valid ones of the family is the probability that
the candidate is of the kind. Loose candidates that reach the threshold and overlap no base span are redacted; of
overlapping ones the most probable stays. The sample for fitting is bounded (train_rows) and taken in hash order.

A family without valid candidates in the sample, or without others, adds nothing.

Defined results: null text is empty; empty texts have zero counts and the hash of the empty string; repeated rows are
reported each; an empty table gives an empty result; texts are scanned whole in near-linear time; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, hash_sample, materialize, tidy

KINDS = ["email", "ip", "card", "phone", "email_words", "phone_loose", "id_labelled", "card_loose"]
FAMILY = [0, 1, 2, 3, 0, 3, 4, 2]
BASE_KINDS = KINDS[:4]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}){1,8}", re.I)
_LOOSE = re.compile(r"(?<![0-9A-Za-z+.,-])\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}(?:[ .-][0-9]{2,5}){1,3}(?![0-9A-Za-z])")
_LABELLED = re.compile(r"\b(?:ssn|passport|iban|tax id|driver licence|licence no)\b[ :#]{1,3}[A-Z0-9][A-Z0-9 -]{5,30}[A-Z0-9]", re.I)
_CUES = re.compile(r"phone|tel|call|mobile|fax|mail|contact|address|card|visa|account|passport|ssn|iban", re.I)
_NUMBER = re.compile(r"[0-9]+")

FEATURES = ["family", "size", "cue", "label", "before_space", "after_space", "line_digits", "near_numbers", "words_around", "base_near", "base_in_text", "line_start", "bars", "repeats"]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of the email pattern; every @ is looked at once, so long runs stay linear."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        if at < free:
            at = text.find("@", free)
            continue
        s = at
        while s > free and text[s - 1] in _LOCAL_CHARS:
            s -= 1
        if s < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((s, m.end()))
            free = m.end()
        else:
            free = max(free, at)
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of the kind, end) of the base kinds, sorted."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if "." in text:
        for m in _IP.finditer(text):
            if all(int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    found = []
    low = text.lower()
    if "at" in low and ("[at" in low or "(at" in low):
        found += [(m.start(), 4, m.end()) for m in _SPELLED.finditer(text)]
    found += [(m.start(), 5, m.end()) for m in _LOOSE.finditer(text) if 7 <= sum(c.isdigit() for c in m[0]) <= 15]
    found += [(m.start(), 6, m.end()) for m in _LABELLED.finditer(text) if any(c.isdigit() for c in m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            at = m.start()
            for part in re.split(r"(?<=[0-9])[\x20-](?=[0-9]{12})", m[0]):  # whole numbers side by side are candidates each
                if 12 <= sum(map(str.isdigit, part)) <= 19:
                    found.append((at, 7, at + len(part)))
                at += len(part) + 1
    return found


def free_of(spans: list[tuple[int, int, int]], taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The (start, kind, end) spans that overlap none of taken (sorted by start)."""
    starts, ends, most = [s for s, _, _ in taken], [], 0
    for _, _, e in taken:
        most = max(most, e)
        ends.append(most)
    out = []
    for s, k, e in spans:
        i = bisect_left(starts, e)  # of those that start before e, does one end after s?
        if not i or ends[i - 1] <= s:
            out.append((s, k, e))
    return out


def valid_id(span: str) -> bool:
    """Whether a labelled id passes a check of its own: an IBAN's remainder, or the areas of a social security number."""
    value = re.sub(r"[^A-Z0-9]", "", re.split(r"[ :#]", span, maxsplit=1)[1].upper())
    if re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
        return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1
    return bool(re.fullmatch(r"(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}", value))


def features(text: str, s: int, e: int, kind: int, base: list[tuple[int, int, int]], starts: list[int], seen: dict[str, int]) -> list[float]:
    """What the trees see of a candidate: nothing of its validator. base: the text's base spans, starts: where they start."""
    before, after = text[max(0, s - 40) : s], text[e : e + 40]
    line_before, line_after = before.rpartition("\n")[2], after.partition("\n")[0]
    lo, hi = bisect_left(starts, s - 200), bisect_left(starts, e + 200)
    around = before + " " + after
    return [
        FAMILY[kind], min(e - s, 60) // 4, bool(_CUES.search(before[-24:])), ":" in before[-3:] or "=" in before[-3:], before[-1:] in ("", " ", "\n"), after[:1] in ("", " ", "\n", ".", ","),
        sum(c.isdigit() for c in line_before + line_after), len(_NUMBER.findall(around)), sum(w.isalpha() for w in around.split()),
        sum(not (x < e and s < y) for x, _, y in base[lo:hi][:50]), min(len(base) - (kind < len(BASE_KINDS)), 20), len(line_before) < 3, around.count("|") + around.count("\t"), min(seen.get(text[s:e], 1), 9),
    ]


def is_valid(kind: int, span: str) -> bool:
    """The label: whether the candidate passes the validator of its family."""
    return kind < len(BASE_KINDS) or (kind == 6 and valid_id(span))


# --- boosted trees -----------------------------------------------------------------------------------------------------


class BoostedTrees:
    """Logistic boosting of depth-limited trees over quantile bins, in NumPy."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, least: int = 5):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.trees: list[list[tuple]] = []
        self.bias = 0.0

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, tree: list) -> int:
        at = len(tree)
        tree.append((-1, 0, 0, 0, float(-g[rows].sum() / (h[rows].sum() + 1.0))))
        if depth == 0 or len(rows) < 2 * self.least:
            return at
        best = (1e-6, None, None)
        G, H = g[rows].sum(), h[rows].sum()
        for j in range(b.shape[1]):
            gs = np.cumsum(np.bincount(b[rows, j], g[rows], self.bins + 1))[:-1]
            hs = np.cumsum(np.bincount(b[rows, j], h[rows], self.bins + 1))[:-1]
            gain = gs**2 / (hs + 1) + (G - gs) ** 2 / (H - hs + 1) - G**2 / (H + 1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], j, k)
        if best[1] is None:
            return at
        left = b[rows, best[1]] <= best[2]
        if min(left.sum(), (~left).sum()) < self.least:
            return at
        l = self._grow(b, g, h, rows[left], depth - 1, tree)  # noqa: E741
        r = self._grow(b, g, h, rows[~left], depth - 1, tree)
        tree[at] = (best[1], best[2], l, r, tree[at][4])
        return at

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        b = self._binned(x)
        p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.bias = float(np.log(p / (1 - p)))
        score = np.full(len(y), self.bias)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            tree: list[tuple] = []
            self._grow(b, q - y, q * (1 - q), np.arange(len(y)), self.depth, tree)
            self.trees.append(tree)
            score += self.rate * self._tree(tree, b)
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1)

    @staticmethod
    def _tree(tree: list[tuple], b: np.ndarray) -> np.ndarray:
        at = np.zeros(len(b), int)
        t = np.array(tree)
        for _ in range(8):
            inner = t[at, 0] >= 0
            if not inner.any():
                break
            j = np.maximum(t[at, 0], 0).astype(int)
            goes = b[np.arange(len(b)), j] <= t[at, 1]
            at = np.where(inner, np.where(goes, t[at, 2], t[at, 3]).astype(int), at)
        return t[at, 4]

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        if len(x):
            b = self._binned(x)
            for tree in self.trees:
                out += self.rate * self._tree(tree, b)
        return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (score from, probability) by pooling adjacent violators."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(score[order], y[order], strict=True):
        blocks.append([s, v, 1.0])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            s2, v2, n2 = blocks.pop()
            s1, v1, n1 = blocks.pop()
            blocks.append([s1, (v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2])
    return np.array([x[0] for x in blocks]), np.array([x[1] for x in blocks])


class PiiModel:
    """Trees, the isotonic steps of their scores, and for each family how probable validity is among the valid (None: adds nothing)."""

    def __init__(self, trees: BoostedTrees | None, steps: tuple[np.ndarray, np.ndarray], families: dict[int, float]):
        self.trees, self.steps, self.families = trees, steps, families

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, least: int = 10) -> PiiModel:
        if len(y) < 40 or y.min() == y.max():
            return cls(None, (np.zeros(1), np.zeros(1)), {})  # nothing to learn from: no loose span is redacted
        half = np.arange(len(y)) % 2 == 0
        trees = BoostedTrees().fit(x[half], y[half])
        out = cls(trees, isotonic(trees.score(x[~half]), y[~half]), {})
        valid = out.valid(x)
        for f in range(max(FAMILY) + 1):
            own = x[:, 0] == f
            if (own & ~half & (y == 1)).sum() >= least and (own & (y == 0)).any():
                out.families[f] = float(valid[own & ~half & (y == 1)].mean())
        return out

    def valid(self, x: np.ndarray) -> np.ndarray:
        """How often candidates with such features pass their validator."""
        at = np.searchsorted(self.steps[0], self.trees.score(x), side="right") - 1
        return np.where(at >= 0, self.steps[1][np.maximum(at, 0)], 0.0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.zeros(len(x))
        among = np.array([self.families.get(f, np.inf) for f in range(max(FAMILY) + 1)])[x[:, 0].astype(int)]
        return np.minimum(1.0, self.valid(x) / among)


# --- the operator ------------------------------------------------------------------------------------------------------

_SPANS = "array<struct<s:int,k:int,e:int,y:boolean,x:array<float>>>"


def text_candidates(text: str | None) -> tuple[list[tuple], list[tuple]]:
    """Base spans and loose spans apart from them, each (start, kind, end, valid, features)."""
    text = text or ""
    base = base_spans(text)
    loose = free_of(loose_spans(text), base)
    starts, seen = [s for s, _, _ in base], Counter(text[s:e] for s, _, e in base + loose)
    make = lambda s, k, e: (s, k, e, is_valid(k, text[s:e]), features(text, s, e, k, base, starts, seen))
    return [make(*c) for c in base], [make(*c) for c in loose]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base (start, kind, end) and loose candidates, each with features. Texts do not leave the scan."""

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            both = [text_candidates(t) for t in df["text"]]
            yield pd.DataFrame({"doc_id": df["doc_id"], "base": [b for b, _ in both], "loose": [x for _, x in both]})

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {ids}, base {_SPANS}, loose {_SPANS}")


def fit(found: DataFrame, train_rows: int = 20000) -> PiiModel:
    """Fits on at most train_rows candidates, the first in hash order."""
    each = found.select("doc_id", F.explode(F.concat("base", "loose")).alias("c")).select("doc_id", "c.*")
    rows = hash_sample(each, ["doc_id", "s", "k", "e"], train_rows).select("y", "x").collect()
    return PiiModel.fit(np.array([r.x for r in rows], float).reshape(len(rows), len(FEATURES)), np.array([float(r.y) for r in rows]))


def most_probable(spans: list[tuple[int, int, int]], p: np.ndarray, threshold: float) -> list[tuple[int, int, int]]:
    """Of the (start, kind, end) spans that reach threshold, the most probable first, those that overlap none taken before."""
    starts: list[int] = []
    ends: list[int] = []
    out = []
    for i in sorted(np.flatnonzero(p >= threshold).tolist(), key=lambda i: (-p[i], spans[i][0], spans[i][2])):
        s, k, e = spans[i]
        at = bisect_left(starts, e)
        if not at or ends[at - 1] <= s:
            starts.insert(at, s)
            ends.insert(at, e)
            out.append((s, k, e))
    return out


def redactions(found: DataFrame, model: PiiModel, threshold: float) -> DataFrame:
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            xs = [c["x"] for loose in df["loose"] for c in loose]
            p, at, out = model.probability(np.array(xs, float).reshape(len(xs), len(FEATURES))), 0, []
            for doc, base, loose in zip(df["doc_id"], df["base"], df["loose"], strict=True):
                spans = [(c["s"], c["k"], c["e"]) for c in base]
                joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
                counts = [sum(k == i for _, k, _ in spans) for i in range(4)]
                added = most_probable([(c["s"], c["k"], c["e"]) for c in loose], p[at : at + len(loose)], threshold)
                at += len(loose)
                every = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans + added))
                out.append((doc, *counts, hashlib.sha256(joined.encode()).hexdigest(), every, len(added), len(spans) + len(added)))
            yield pd.DataFrame(out, columns=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_added", "n_spans"])

    ids = found.schema["doc_id"].dataType.simpleString()
    return found.mapInPandas(run, f"doc_id {ids}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long")


def find_pii(docs: DataFrame, threshold: float = 0.9, train_rows: int = 20000) -> DataFrame:
    """One row per document: doc_id, counts of the base kinds, base_sha256, spans, n_added, n_spans."""
    found = materialize(candidates(docs), "pii")
    return redactions(found, fit(found, train_rows), threshold)


def redact(text: str, spans: str) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, at = [], 0
    for kind, s, e in sorted((x.split(":") for x in spans.split(",") if x), key=lambda x: (int(x[1]), -int(x[2]))):
        if int(s) >= at:
            out += [text[at : int(s)], f"[{kind.upper()}]"]
            at = int(e)
    return "".join([*out, text[at:]])


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))
