"""Operator 4, best-fit packing by a configuration linear program.

Tokenised documents are cut into pieces of at most capacity tokens. The histogram of piece lengths, at most capacity
numbers whatever the corpus, is all that the driver sees. A configuration is a multiset of lengths that fits one sequence.
Multiplicative weights solve the covering program over configurations: each round prices the lengths by how little they
are covered so far and a knapsack dynamic program finds the best configuration. The solution is rounded down, never
taking more of a length than there is, and what remains is packed by best fit, again on counts. So the plan is a list of
configurations with multiplicities that uses every piece exactly once, and sequences have no gaps.

Pieces get their places without a global sort: a rank within (task, length) and prefix sums over tasks number the pieces
of each length, and the number decides configuration, sequence and offset.

Defined results: null text is empty, so the document is its end id alone; repeated rows are packed each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, materialize, tidy
from .tokens import CACHE_BYTES, encoder

END_ID = 0


# --- the plan ----------------------------------------------------------------------------------------------------------


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> list[int]:
    """Indices, with repeats, of the most valuable multiset of lengths (ascending) that fits."""
    best = np.zeros(capacity + 1)
    for c in range(int(lengths[0]), capacity + 1):
        k = int(np.searchsorted(lengths, c, side="right"))
        got = (values[:k] + best[c - lengths[:k]]).max()
        best[c] = got if got > best[c - 1] else best[c - 1]
    out, c = [], capacity
    while c >= lengths[0]:
        if best[c] == best[c - 1]:
            c -= 1
            continue
        k = int(np.searchsorted(lengths, c, side="right"))
        i = int((values[:k] + best[c - lengths[:k]]).argmax())
        out.append(i)
        c -= int(lengths[i])
    return out


def solve_configurations(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int, step: float) -> list[tuple[dict[int, int], float]]:
    """Fractional covering by multiplicative weights: configurations (index -> times) with how often each is used."""
    covered = np.zeros(len(lengths))
    used: dict[tuple, float] = {}
    eta = np.log(len(lengths) + 1) + 1
    for _ in range(rounds):
        short = covered < 1
        if not short.any():
            break
        price = np.where(short, np.exp(-eta * covered) / counts, 0.0)
        chosen = knapsack(lengths, price + 1e-12 * lengths * price.max(), capacity)
        idx, times = np.unique(chosen, return_counts=True)
        amount = step * float((counts[idx] / times).min())
        covered[idx] += times * amount / counts[idx]
        key = tuple(zip(idx.tolist(), times.tolist(), strict=True))
        used[key] = used.get(key, 0.0) + amount
    return [(dict(k), x) for k, x in sorted(used.items(), key=lambda kx: -kx[1])]


def plan_sequences(histogram: dict[int, int], capacity: int, rounds: int = 600, step: float = 0.5) -> list[tuple[list[int], int]]:
    """Configurations (lengths, descending) with multiplicities; together they use each length exactly as often as it occurs."""
    left = {n: c for n, c in histogram.items() if c}
    plan = []
    if left.get(capacity):
        plan.append(([capacity], left.pop(capacity)))
    lengths = np.array(sorted(left), int)
    if len(lengths):
        counts = np.array([left[n] for n in lengths], float)
        for config, x in solve_configurations(lengths, counts, capacity, rounds, step):
            times = min(int(x), *(left[int(lengths[i])] // t for i, t in config.items()))
            room = capacity - sum(int(lengths[i]) * t for i, t in config.items())
            if times <= 0 or room > capacity // 64:  # wasteful ones are left to best fit
                continue
            plan.append((sorted((int(lengths[i]) for i, t in config.items() for _ in range(t)), reverse=True), times))
            for i, t in config.items():
                left[int(lengths[i])] -= t * times
    return plan + best_fit(left, capacity)


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Each sequence takes the longest length that still fits, until none does; equal sequences are made at once."""
    have = np.array(sorted(n for n, c in left.items() if c), int)
    counts = np.array([left[int(n)] for n in have], np.int64)
    plan: list[tuple[list[int], int]] = []
    while len(have):
        room, took = capacity, np.zeros(len(have), np.int64)
        while room > 0:
            k = int(np.searchsorted(have, room, side="right")) - 1
            while k >= 0 and took[k] >= counts[k]:
                k -= 1
            if k < 0:
                break
            t = min(room // int(have[k]), int(counts[k] - took[k]))
            took[k] += t
            room -= t * int(have[k])
        some = np.flatnonzero(took)
        times = int((counts[some] // took[some]).min())
        plan.append((sorted((int(have[i]) for i in some for _ in range(took[i])), reverse=True), times))
        counts[some] -= times * took[some]
        keep = counts > 0
        have, counts = have[keep], counts[keep]
    return plan


class Placement:
    """From (length, number among the pieces of that length) to (sequence, offset)."""

    def __init__(self, plan: list[tuple[list[int], int]]):
        slots: dict[int, list[tuple[int, int, list[int]]]] = {}
        base = 0
        for config, times in plan:
            at: dict[int, list[int]] = {}
            place = 0
            for n in config:
                at.setdefault(n, []).append(place)
                place += n
            for n, offsets in at.items():
                slots.setdefault(n, []).append((base, times, offsets))
            base += times
        self.sequences = base
        self.table = {}
        for n, rows in slots.items():
            ends = np.cumsum([times * len(o) for _, times, o in rows])
            first = np.cumsum([0, *(len(o) for _, _, o in rows)])
            self.table[n] = (ends, np.array([b for b, _, _ in rows]), np.array([len(o) for _, _, o in rows]), first, np.concatenate([o for _, _, o in rows]))

    def __call__(self, length: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends, base, each, first, offsets = self.table[length]
        k = np.searchsorted(ends, numbers, side="right")
        within = numbers - np.where(k > 0, ends[np.maximum(k - 1, 0)], 0)
        return base[k] + within // each[k], offsets[first[k] + within % each[k]]


# --- the operator ------------------------------------------------------------------------------------------------------


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Pieces with the task that cut them and their number among that task's pieces of the same length."""

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, task, end = encoder(vocabulary, cache_bytes), TaskContext.get().partitionId(), struct.pack("<I", END_ID)
        seen = np.zeros(capacity + 1, np.int64)
        for df in frames:
            rows = []
            for doc_id, text in zip(df["doc_id"], df["text"], strict=True):
                ids = enc.encode(text) + end
                for i in range(0, len(ids), 4 * capacity):
                    part = ids[i : i + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc_id, i // (4 * capacity), i // 4, n, zlib.crc32(part), task, int(seen[n])))
                    seen[n] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"]).astype({"doc_id": df["doc_id"].dtype})

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {ids}, piece int, start long, length long, ids_crc32 long, task int, number long")


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """pieces with sequence_id and offset in place of task and number."""
    counts = materialize(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {int(r.length): int(r.n) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    place = Placement(plan_sequences(histogram, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    numbered = pieces.join(counts.select("task", "length", F.coalesce(before, F.lit(0)).alias("before")), ["task", "length"])
    keep = [c for c in pieces.columns if c not in ("task", "number")]

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            n, number = df["length"].to_numpy(), (df["before"] + df["number"]).to_numpy()
            seq, off = np.zeros(len(df), np.int64), np.zeros(len(df), np.int64)
            for length in np.unique(n):
                rows = np.flatnonzero(n == length)
                seq[rows], off[rows] = place(int(length), number[rows])
            yield df[keep].assign(sequence_id=seq, offset=off)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in keep)
    return numbered.select(*keep, "number", "before").mapInPandas(run, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. cache_bytes: what a worker may hold of known pre-tokens, twice."""
    return pack_pieces(materialize(cut_pieces(docs, vocabulary, capacity, cache_bytes), "pieces"), capacity)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), "word_bpe_49k.json")
