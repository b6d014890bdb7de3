"""Operator 2, n-gram Jaccard join with set-relation skipping.

Sets are the distinct word shingles of each text, as 64-bit hashes; equal sets are one, told apart by 128-bit digests.
The join is exact: sets ordered by (frequency class, hash) can only be similar if they share a token of their prefixes,
and index lists hold (set, size, position) for prefix tokens. Two kinds of skipping keep the work near linear:

* Index level: a list falls into blocks of equal size and position. Pairs of blocks that fail the size test or cannot
  reach the needed overlap from their positions are skipped whole.
* Answer level. Star rounds compare each set of a list with one pivot. A set that is highly similar to its pivot follows
  it: the tokens by which the two differ are kept, and from then on its answers are derived from the pivot's. Where a
  leader's overlap with another set or leader is known, the differences bound the overlaps of all followers: either no
  follower can be similar, or it is derived from the leader's overlap by counting its few differing tokens alone.

Links matter up to connected sets: pairs within a component are never made, and sets that differ too much by their
parity signs (about a bit a token) are ruled out in slices before a pair is made. What is left is verified on whole sets,
which are fetched for these sets alone and met in units of one pivot and at most about 256 partners.

Frequent tokens come last in the order. At most max_heavy of them are broadcast. The order changes cost, not results.
Lists of more than tile_rows sets are cut into tiles of hashed halves, so no task holds one whole; as tiles are never
smaller than the share of 1 / max_heavy of all tokens, every token with a longer list is among the frequent ones.

Defined results: null or empty text has no shingles and is linked with nothing, itself as component; with fewer words
than width, all words form one shingle; rows without doc_id have a null component and link nothing; repeated rows are
returned each; an empty table gives an empty result; other columns are ignored. doc_id is an integer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from .common import bit_filter, component_labels, documents, filter_log2, give_back, join_counted, materialize, maybe_in, prune, release, scratch_scope, tidy

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PRIME, _STEP = U(0x100000001B3), U(0x9E3779B97F4A7C15)
LONG_WORD = 64
POSTING = np.dtype([("t", "<i8"), ("s", "<i8"), ("n", "<i4"), ("p", "<i4")])
SINGLES = 256  # one in so many tokens that a batch holds once is counted, with that weight
SLICE = 1 << 18  # pairs that are tested at once


# --- sets --------------------------------------------------------------------------------------------------------------


def mix64(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (int64) of each text."""
    raw = [(t or "").encode().lower() for t in texts]  # bytes.lower() changes A-Z only
    buf = b" ".join(raw) + b" "
    a = np.frombuffer(buf, np.uint8)
    space = _SPACE[a]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)
    length = ends - starts
    h = np.full(len(starts), 0xCBF29CE484222325, U) + length.astype(U)
    live = np.arange(len(starts))
    for k in range(min(LONG_WORD, int(length.max(initial=0)))):
        live = live[length[live] > k]
        h[live] = (h[live] ^ a[starts[live] + k].astype(U)) * _PRIME
    for i in np.flatnonzero(length > LONG_WORD):
        h[i] = int.from_bytes(hashlib.blake2b(buf[starts[i] : ends[i]], digest_size=8).digest(), "little")
    h = mix64(h)
    bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
    first = np.searchsorted(starts, bounds)
    s = h[: max(0, len(h) - width + 1)].copy()
    for k in range(1, width):
        s = s * _STEP + h[k : k + len(s)]
    s = mix64(s).view(np.int64)
    out = []
    for i in range(len(raw)):
        lo, hi = int(first[i]), int(first[i + 1])
        if hi - lo >= width:
            out.append(np.unique(s[lo : hi - width + 1]))
        elif hi > lo:
            x = U(hi - lo)
            with np.errstate(over="ignore"):
                for w in h[lo:hi]:
                    x = x * _STEP + w
            out.append(mix64(np.array([x ^ U(0x5851F42D4C957F2D)])).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _wide(tokens: np.ndarray) -> bytes:
    """The digest that names a set."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _short(wide: bytes, clash: frozenset[int] = frozenset()) -> int:
    """64 bits of a digest, from its other half where different sets share the first."""
    s = int.from_bytes(wide[:8], "big", signed=True)
    return int.from_bytes(wide[8:], "big", signed=True) if s in clash else s


def sign_bits(n: int) -> int:
    return max(256, 1 << (n - 1).bit_length()) if n else 256


def parity_sign(tokens: np.ndarray) -> bytes:
    """Parities of how many tokens fall into each cell. Two sets differ in at least as many tokens as their signs differ in bits."""
    bits = sign_bits(len(tokens))
    cells = np.bincount(tokens.view(U).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((cells & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(x: np.ndarray, words: int) -> np.ndarray:
    """Signs (rows of uint64) as they would be with fewer cells."""
    return x if x.shape[1] == words else np.bitwise_xor.reduce(x.reshape(len(x), -1, words), axis=1)


def least_apart(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """For pairs of signs, a number of tokens in which the two sets differ at least."""
    lx, ly = np.fromiter(map(len, x), np.int64, len(x)), np.fromiter(map(len, y), np.int64, len(y))
    out = np.zeros(len(x), np.int64)
    for a, b in {*zip(lx.tolist(), ly.tolist(), strict=True)}:
        rows = np.flatnonzero((lx == a) & (ly == b))
        for at in range(0, len(rows), SLICE * 32 // max(a, b)):
            r = rows[at : at + SLICE * 32 // max(a, b)]
            u = np.frombuffer(b"".join([x[i] for i in r]), U).reshape(len(r), -1)
            v = np.frombuffer(b"".join([y[i] for i in r]), U).reshape(len(r), -1)
            words = min(a, b) // 8
            out[r] = np.bitwise_count(_folded(u, words) ^ _folded(v, words)).sum(axis=1)
    return out


def allowed_apart(n: np.ndarray, percent: int) -> np.ndarray:
    """In how many tokens two sets with n tokens in all may differ and still be similar."""
    return (100 - percent) * n // (100 + percent)


def _batches(frames: Iterator[pd.DataFrame], size: int = 1 << 20) -> Iterator[tuple[list, list]]:
    """(doc_ids, texts) of about size characters at a time."""
    for df in frames:
        ids, texts, n = [], [], 0
        for d, t in zip(df["doc_id"], df["text"], strict=True):
            ids.append(d)
            texts.append(t)
            n += len(t or "") + 1
            if n >= size:
                yield ids, texts
                ids, texts, n = [], [], 0
        if ids:
            yield ids, texts


def describe(docs: DataFrame, width: int) -> DataFrame:
    """Rows of three kinds: 0, a document (doc_id, n, s, wide, sign); 1, a token (s) that n sets of one batch share; 2, some of the tokens that a batch holds once, with weight n."""

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        done: set[bytes] = set()
        size = 0

        def flush() -> pd.DataFrame:
            t, c = np.unique(np.concatenate(held), return_counts=True)
            some = (mix64(t.view(U) + U(len(t))) & U(SINGLES - 1)) == 0  # other tokens in other batches
            keep = (c > 1) | some
            t, c = t[keep], c[keep]
            return pd.DataFrame({"kind": np.where(c > 1, 1, 2), "doc_id": pd.array([None] * len(t), "Int64"), "n": np.where(c > 1, c, SINGLES), "s": t, "wide": None, "sign": None})

        for ids, texts in _batches(frames):
            sets = shingle_sets(texts, width)
            wide = [_wide(x) for x in sets]
            yield pd.DataFrame({"kind": 0, "doc_id": pd.array([None if pd.isna(d) else int(d) for d in ids], "Int64"), "n": [len(x) for x in sets], "s": [_short(w) for w in wide], "wide": wide, "sign": [parity_sign(x) for x in sets]})
            for w, x in zip(wide, sets, strict=True):
                if len(x) and w not in done:
                    done.add(w)
                    held.append(x)
                    size += len(x)
            if len(done) > 500_000:
                done.clear()
            if size > 2_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "kind int, doc_id long, n long, s long, wide binary, sign binary")


def heavy_tokens(described: DataFrame, max_heavy: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens (ascending by count) and their counts; at most max_heavy, by a threshold on the count."""
    each = described.where("kind > 0").groupBy("s").agg(F.sum(F.when(F.col("kind") == 1, F.col("n"))).alias("sure"), F.sum(F.when(F.col("kind") == 2, F.col("n"))).alias("rough"))
    each = each.na.fill(0).where((F.col("sure") >= 8) | (F.col("rough") >= 4 * SINGLES)).select("s", (F.col("sure") + F.col("rough")).alias("n"))
    counts = materialize(each.withColumn("level", F.floor(8 * F.log2("n"))), "token-counts")
    total, cut = 0, None
    for level, k in sorted(((r.level, r.k) for r in counts.groupBy("level").agg(F.count("*").alias("k")).collect()), reverse=True):
        if total + k > max_heavy:
            break
        total, cut = total + k, level
    if cut is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = counts.where(F.col("level") >= cut).orderBy("n", "s").select("n", "s").toPandas()
    return rows["s"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


# --- index lists -------------------------------------------------------------------------------------------------------


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def may_link(n1, p1, n2, p2, percent: int):
    """Size and position test for n1 <= n2: can two sets that share a token at these positions reach the overlap?"""
    overlap = np.minimum(n1 - p1, n2 - p2)
    return (100 * n1 >= percent * n2) & ((100 + percent) * overlap >= percent * (n1 + n2))


def pack_postings(a: np.ndarray) -> bytes:
    """Column by column, which leaves the compression of shuffles and files long runs."""
    return b"".join(np.ascontiguousarray(a[c]).tobytes() for c in POSTING.names)


def unpack_postings(blobs: list[bytes]) -> np.ndarray:
    out = np.empty(sum(map(len, blobs)) // POSTING.itemsize, POSTING)
    at = 0
    for b in blobs:
        k, place = len(b) // POSTING.itemsize, 0
        for c in POSTING.names:
            out[c][at : at + k] = np.frombuffer(b, POSTING[c], k, place)
            place += k * POSTING[c].itemsize
        at += k
    return out


def index_blobs(docs: DataFrame, width: int, percent: int, heavy: tuple[np.ndarray, np.ndarray], clash: frozenset[int], buckets: int, tile_rows: int) -> DataFrame:
    """(bucket, blob): postings of prefix tokens, packed; a set is written once per task."""
    sc = docs.sparkSession.sparkContext
    order = np.argsort(heavy[0])
    shared = sc.broadcast((heavy[0][order], order, heavy[1][order]))

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, rank, count = shared.value
        done: set[int] = set()
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pd.DataFrame:
            a = np.concatenate(held)
            if len(tokens):  # cut long lists into tiles of two hashed parts
                at = np.minimum(np.searchsorted(tokens, a["t"]), len(tokens) - 1)
                parts = np.where(tokens[at] == a["t"], -(-count[at] // tile_rows), 1)
                long = parts > 1
                extra = []
                for i in np.flatnonzero(long):
                    k = int(parts[i])
                    own = int(a["s"][i]) % k
                    j = np.arange(k)
                    lo, hi = np.minimum(own, j), np.maximum(own, j)
                    tile = np.repeat(a[i : i + 1], k)
                    tile["t"] = mix64(mix64(np.full(k, a["t"][i]).view(U) + lo.astype(U)) + hi.astype(U)).view(np.int64)
                    extra.append(tile)
                if extra:
                    a = np.concatenate([a[~long], *extra])
            b = (mix64(a["t"].view(U)) % U(buckets)).astype(np.int64)
            o = np.argsort(b, kind="stable")
            a, b = a[o], b[o]
            keys, first = np.unique(b, return_index=True)
            ends = np.append(first[1:], len(a))
            return pd.DataFrame({"bucket": keys, "blob": [pack_postings(a[i:j]) for i, j in zip(first, ends, strict=True)]})

        for ids, texts in _batches(frames):
            for d, x in zip(ids, shingle_sets(texts, width), strict=True):
                if not len(x) or pd.isna(d):
                    continue
                s = _short(_wide(x), clash)
                if s in done:
                    continue
                if len(done) > 500_000:
                    done.clear()
                done.add(s)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, x), len(tokens) - 1)
                    known = tokens[at] == x
                    last = np.flatnonzero(known)
                    x = np.concatenate([x[~known], x[last[np.argsort(rank[at[last]])]]])
                k = prefix_size(len(x), percent)
                part = np.empty(k, POSTING)
                part["t"], part["s"], part["n"], part["p"] = x[:k], s, len(x), np.arange(k)
                held.append(part)
                size += k
            if size > 500_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return docs.select("doc_id", "text").mapInPandas(run, "bucket long, blob binary")


def _ends(a: np.ndarray) -> np.ndarray:
    """First rows of the lists in postings sorted by token, and the end."""
    return np.append(np.flatnonzero(np.append(True, a["t"][1:] != a["t"][:-1])), len(a)) if len(a) else np.zeros(1, np.int64)


def shared_lists(blobs: DataFrame, percent: int) -> DataFrame:
    """(bucket, blob) with the lists of tokens that two sets or more share and that pass the tests, sorted by token, size, position."""

    def run(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        a = unpack_postings(df["blob"].tolist())
        a = a[np.lexsort((a["s"], a["p"], a["n"], a["t"]))]
        a = a[np.append(True, (a["t"][1:] != a["t"][:-1]) | (a["s"][1:] != a["s"][:-1]))]
        cut = _ends(a)
        count = np.diff(cut)
        keep = count > 1
        two = np.flatnonzero(count == 2)
        x, y = a[cut[two]], a[cut[two] + 1]
        keep[two[~may_link(x["n"].astype(int), x["p"].astype(int), y["n"].astype(int), y["p"].astype(int), percent)]] = False
        a = a[np.repeat(keep, count)]
        out = pd.DataFrame({"bucket": [key[0]], "blob": [pack_postings(a)]}) if len(a) else pd.DataFrame({"bucket": [], "blob": []}).astype({"bucket": np.int64})
        give_back()
        return out

    return blobs.groupBy("bucket").applyInPandas(run, "bucket long, blob binary")


def _pairs(x: np.ndarray, y: np.ndarray) -> pd.DataFrame:
    both = np.unique(np.stack([x, y], axis=1), axis=0) if len(x) else np.zeros((0, 2), np.int64)
    return pd.DataFrame({"s1": both[:, 0], "s2": both[:, 1]})


def _looked_up(s: np.ndarray, df: pd.DataFrame, column: str) -> np.ndarray:
    """For each set its value in df(s, column), itself where there is none."""
    if not len(df):
        return s.copy()
    keys, values = df["s"].to_numpy(np.int64), df[column].to_numpy(np.int64)
    o = np.argsort(keys)
    keys, values = keys[o], values[o]
    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
    return np.where(keys[at] == s, values[at], s)


def stars(a: np.ndarray, label: np.ndarray, percent: int, turn: int) -> pd.DataFrame:
    """(s1: pivot, s2) in each list and size class: one pivot of the most common component against each set of another component."""
    size = np.floor(np.log(a["n"]) / np.log(1.25)).astype(np.int64)
    o = np.lexsort((mix64(a["s"].view(U) + U(turn)), label, size, a["t"]))  # the same sets are pivots of many lists
    a, label, size = a[o], label[o], size[o]
    new_class = np.append(True, (a["t"][1:] != a["t"][:-1]) | (size[1:] != size[:-1]))
    new_label = new_class | np.append(True, label[1:] != label[:-1])
    starts = np.flatnonzero(new_label)
    n_in = np.diff(np.append(starts, len(a)))
    klass = np.cumsum(new_class)[starts]
    best = np.lexsort((mix64(a["s"][starts].view(U) + U(turn)), -n_in, klass))
    best = best[np.append(True, klass[best][1:] != klass[best][:-1])]
    pivot = np.repeat(starts[best], np.diff(np.append(np.flatnonzero(new_class), len(a))))
    rows = np.flatnonzero(label != label[pivot])
    p, q = a[pivot[rows]], a[rows]
    small = p["n"] <= q["n"]
    lo, hi = np.where(small, p, q), np.where(small, q, p)
    ok = may_link(lo["n"].astype(int), lo["p"].astype(int), hi["n"].astype(int), hi["p"].astype(int), percent)
    return _pairs(p["s"][ok], q["s"][ok])


def star_pairs(lists: DataFrame, labels: DataFrame | None, percent: int, turn: int) -> DataFrame:
    """Pairs of star round turn. labels: (bucket, s, label) of sets that have links so far."""
    if labels is None:

        @tidy
        def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for df in frames:
                for blob in df["blob"]:
                    a = unpack_postings([blob])
                    yield stars(a, a["s"].copy(), percent, turn)

        return lists.select("blob").mapInPandas(first, "s1 long, s2 long").distinct()

    def run(_: tuple, df: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        a = unpack_postings(df["blob"].tolist())
        return stars(a, _looked_up(a["s"], known, "label"), percent, turn) if len(a) else _pairs(a["s"], a["s"])

    return lists.groupBy("bucket").cogroup(labels.groupBy("bucket")).applyInPandas(run, "s1 long, s2 long").distinct()


def sets_of(lists: DataFrame) -> DataFrame:
    """(bucket, s), each once."""

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for bucket, blob in zip(df["bucket"], df["blob"], strict=True):
                yield pd.DataFrame({"bucket": bucket, "s": np.unique(unpack_postings([blob])["s"])})

    return lists.mapInPandas(run, "bucket long, s long")


def _blocks(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rows (and the end), sizes and positions of a list's blocks."""
    first = np.append(np.flatnonzero(np.append(True, (part["n"][1:] != part["n"][:-1]) | (part["p"][1:] != part["p"][:-1]))), len(part))
    return first, part["n"][first[:-1]].astype(int), part["p"][first[:-1]].astype(int)


def block_pairs(n: np.ndarray, p: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each block with the later blocks (itself included) that hold sets it may link with."""
    for i in range(len(n)):
        upto = int(np.searchsorted(n, 100 * n[i] // percent, side="right"))
        yield i, i + np.flatnonzero(may_link(n[i], p[i], n[i:upto], p[i:upto], percent))


def active_sets(lists: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(bucket, s) of the sets that some block pair lets meet a set of another component."""

    def run(key: tuple, df: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        a = unpack_postings(df["blob"].tolist())
        label, found, cut = _looked_up(a["s"], known, "label"), [], _ends(a)
        count = np.diff(cut)
        pair = cut[:-1][count == 2]  # the tests of these were made when the lists were
        pair = pair[label[pair] != label[pair + 1]]
        found += [a["s"][pair], a["s"][pair + 1]]
        for lo, hi in zip(cut[:-1][count > 2], cut[1:][count > 2], strict=True):
            lab = label[lo:hi]
            if (lab == lab[0]).all():
                continue
            first, n, p = _blocks(a[lo:hi])
            least, most = np.minimum.reduceat(lab, first[:-1]), np.maximum.reduceat(lab, first[:-1])
            use = np.zeros(len(n), bool)
            for i, js in block_pairs(n, p, percent):
                differ = js[(least[js] != least[i]) | (most[js] != most[i]) | (least[i] != most[i])]
                use[differ] = True
                use[i] |= len(differ) > 0
            found.append(a["s"][lo:hi][np.repeat(use, np.diff(first))])
        return pd.DataFrame({"bucket": key[0], "s": np.unique(np.concatenate(found))})

    return lists.groupBy("bucket").cogroup(labels.groupBy("bucket")).applyInPandas(run, "bucket long, s long")


def cross_pairs(lists: DataFrame, active: DataFrame, percent: int) -> DataFrame:
    """(s1, s2), s1 < s2: the leaders of sets of different components that the lists' blocks and the sets' signs allow.

    active: bucket, s, label, leader, sign. Block pairs are tested in slices; only what passes is kept.
    """

    def run(_: tuple, df: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        none = _pairs(np.zeros(0, np.int64), np.zeros(0, np.int64))
        if not len(known) or not len(df):
            return none
        known = known.sort_values("s", ignore_index=True)
        keys, labels, leaders, signs = known["s"].to_numpy(), known["label"].to_numpy(), known["leader"].to_numpy(), known["sign"].tolist()
        a = unpack_postings(df["blob"].tolist())
        at = np.minimum(np.searchsorted(keys, a["s"]), len(keys) - 1)
        a, at = a[keys[at] == a["s"]], at[keys[at] == a["s"]]
        cut, found = _ends(a), []
        count = np.diff(cut)
        x = cut[:-1][count == 2]
        x = x[labels[at[x]] != labels[at[x + 1]]]
        ok = least_apart([signs[i] for i in at[x]], [signs[i] for i in at[x + 1]]) <= allowed_apart(a["n"][x].astype(int) + a["n"][x + 1], percent)
        b, c = leaders[at[x[ok]]], leaders[at[x[ok] + 1]]
        found.append(np.stack([np.minimum(b, c), np.maximum(b, c)], axis=1))
        for lo, hi in zip(cut[:-1][count > 2], cut[1:][count > 2], strict=True):
            own = at[lo:hi]
            if (labels[own] == labels[own[0]]).all():
                continue
            first, n, p = _blocks(a[lo:hi])
            rows = [own[i:j] for i, j in zip(first[:-1], first[1:], strict=True)]
            matrix: dict[int, np.ndarray] = {}

            def sign_of(i: int) -> np.ndarray:
                if i not in matrix:
                    matrix[i] = np.frombuffer(b"".join([signs[r] for r in rows[i]]), U).reshape(len(rows[i]), -1)
                return matrix[i]

            for i, js in block_pairs(n, p, percent):
                for j in js:
                    x, y = sign_of(i), sign_of(j)
                    words = min(x.shape[1], y.shape[1])
                    x, y, far = _folded(x, words), _folded(y, words), int(allowed_apart(n[i] + n[j], percent))
                    step = max(1, SLICE // (len(y) * words) + 1)
                    for k in range(0, len(x), step):
                        ok = labels[rows[i][k : k + step]][:, None] != labels[rows[j]][None, :]
                        ok &= np.bitwise_count(x[k : k + step, None, :] ^ y[None, :, :]).sum(axis=2) <= far
                        u, v = np.nonzero(ok)
                        if len(u):
                            b, c = leaders[rows[i][k + u]], leaders[rows[j][v]]
                            found.append(np.unique(np.stack([np.minimum(b, c), np.maximum(b, c)], axis=1), axis=0))
        both = np.unique(np.concatenate(found), axis=0)
        both = both[both[:, 0] != both[:, 1]]
        return _pairs(both[:, 0], both[:, 1])

    return lists.groupBy("bucket").cogroup(active.groupBy("bucket")).applyInPandas(run, "s1 long, s2 long").distinct()


# --- verification --------------------------------------------------------------------------------------------------------


def described_pairs(pairs: DataFrame, owned: DataFrame, percent: int | None) -> DataFrame:
    """pairs(s1, s2) with both sizes (n1, n2) and documents (d1, d2), without those that the signs rule out at percent."""

    def near(x: pd.Series, y: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        return pd.Series(least_apart(x.tolist(), y.tolist()) <= allowed_apart((n1 + n2).to_numpy(), percent))

    near.__annotations__ = {"x": pd.Series, "y": pd.Series, "n1": pd.Series, "n2": pd.Series, "return": pd.Series}
    a, b = (owned.select(F.col("s").alias(f"s{i}"), F.col("n").alias(f"n{i}"), F.col("low").alias(f"d{i}"), F.col("sign").alias(f"g{i}")) for i in (1, 2))
    out = pairs.join(a, "s1").join(b, "s2")
    if percent is not None:
        out = out.where(F.pandas_udf(near, BooleanType())("g1", "g2", "n1", "n2"))
    return out.select("s1", "s2", "n1", "n2", "d1", "d2")


def fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted(s, low, ...) with the text of document low. Only texts that a bit filter lets through are shuffled."""
    wanted = materialize(wanted, "wanted")
    ids = wanted.select(F.col("low").alias("doc_id")).distinct()
    log2 = filter_log2(wanted.count())
    rows = docs.select(F.col("doc_id").cast("long").alias("low"), "text")
    rows = maybe_in(rows, F.col("low"), bit_filter(ids, "doc_id", log2), log2, "bf_flag").where("bf_flag").drop("bf_flag")
    return wanted.join(rows, "low").drop("low")


def _sets(df: pd.DataFrame, width: int, clash: frozenset[int]) -> dict[int, np.ndarray]:
    """The sets of df(s, text); other documents with the same doc_id are passed over."""
    df, out = df.drop_duplicates(["s", "text"]), {}
    for _, texts in _batches(iter([df.rename(columns={"s": "doc_id"})])):
        for x in shingle_sets(texts, width):
            out[_short(_wide(x), clash)] = x
    return out


def overlaps(docs: DataFrame, width: int, pairs: DataFrame, clash: frozenset[int], long: int = 100_000) -> DataFrame:
    """described_pairs with their overlap (both) and, of highly similar ones, the tokens that s2 has more (plus) and less (minus) than s1.

    A unit is one s1 with about 256 of its partners; a group holds units of about 500,000 tokens, or one very long pair.
    """
    most = pairs.groupBy("s1").agg(F.count("*").alias("k"), F.sum("n2").alias("n")).agg(F.max("k"), F.sum("n")).head()
    unit = F.xxhash64("s1", F.pmod(F.xxhash64("s2"), F.lit(-(-(most[0] or 1) // 256))))
    groups = max(1, -(-int(most[1] or 0) // 500_000))
    pairs = pairs.withColumn("g", F.when(F.col("n2") > long, F.xxhash64("s1", "s2")).otherwise(F.pmod(unit, F.lit(groups))))
    wanted = pairs.select("g", "s1", F.col("s2").alias("s"), F.col("d2").alias("low")).unionByName(pairs.select("g", "s1", F.col("s1").alias("s"), F.col("d1").alias("low")).distinct())

    def run(_: tuple, df: pd.DataFrame) -> pd.DataFrame:
        sets, rows = _sets(df, width, clash), []
        for p, q in df[["s1", "s"]].drop_duplicates().itertuples(index=False):
            if p == q:
                continue
            x, y = sets[p], sets[q]
            both = len(np.intersect1d(x, y, assume_unique=True))
            close = 20 * (len(x) + len(y) - 2 * both) <= len(x) + len(y)
            more = np.setdiff1d(y, x, assume_unique=True).tobytes() if close else None
            less = np.setdiff1d(x, y, assume_unique=True).tobytes() if close else None
            rows.append((p, q, len(x), len(y), both, more, less))
        del sets
        give_back()
        return pd.DataFrame(rows, columns=["s1", "s2", "n1", "n2", "both", "plus", "minus"])

    return fetch(docs, wanted).groupBy("g").applyInPandas(run, "s1 long, s2 long, n1 long, n2 long, both long, plus binary, minus binary")


def leaders_of(near: DataFrame) -> DataFrame:
    """(s, leader, n, apart, plus, minus): sets that follow the closest set they are highly similar to. Leaders follow none."""
    close = near.where("plus is not null").withColumn("apart", F.col("n1") + F.col("n2") - 2 * F.col("both"))
    best = close.groupBy("s2").agg(F.min_by(F.struct("s1", "n2", "apart", "plus", "minus"), F.struct("apart", "s1")).alias("x")).select(F.col("s2").alias("s"), F.col("x.s1").alias("leader"), F.col("x.n2").alias("n"), "x.apart", "x.plus", "x.minus")
    best = materialize(best, "followers")
    return materialize(best.join(best.select(F.col("s").alias("leader")), "leader", "left_anti"), "leaders")


def derived_overlaps(both: int, z: np.ndarray, y: np.ndarray, plus: np.ndarray, minus: np.ndarray) -> int:
    """The overlap of z with the set that has plus more and minus less than y, from y's overlap with z."""
    return both + len(np.intersect1d(plus, z, assume_unique=True)) - len(np.intersect1d(minus, z, assume_unique=True))


def follower_links(docs: DataFrame, width: int, open_pairs: DataFrame, followers: DataFrame, owned: DataFrame, clash: frozenset[int], percent: int, part: int = 2000) -> DataFrame:
    """One link (s1, s2) for each unit of open_pairs(s1, s2, k1, k2: numbers of followers) in which some sets of the two leaders' are similar.

    A unit holds two leaders, about part followers of each and their differences; all overlaps are derived from the leaders'.
    """
    k = lambda c: F.floor(F.col(c) / part).cast("int")
    units = open_pairs.withColumn("u1", F.explode(F.sequence(F.lit(0), k("k1")))).withColumn("u2", F.explode(F.sequence(F.lit(0), k("k2"))))
    units = materialize(units.select("s1", "s2", "u1", "u2", "k1", "k2"), "units")
    texts = units.select("s1", "s2", "u1", "u2", F.col("s1").alias("s")).unionByName(units.select("s1", "s2", "u1", "u2", F.col("s2").alias("s"))).join(owned.select("s", "low"), "s")
    empty = F.lit(None).cast("binary")
    rows = fetch(docs, texts).select("s1", "s2", "u1", "u2", F.lit(0).alias("side"), "s", "text", empty.alias("plus"), empty.alias("minus"))
    for side, k_, u in (("s1", "k1", "u1"), ("s2", "k2", "u2")):
        own = units.join(followers.select(F.col("leader").alias(side), "s", "plus", "minus"), side).where(F.pmod(F.xxhash64("s"), k(k_) + 1) == F.col(u))
        rows = rows.unionByName(own.select("s1", "s2", "u1", "u2", F.lit(int(side[1])).alias("side"), "s", F.lit(None).cast("string").alias("text"), "plus", "minus"))

    def run(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        sets, none = _sets(df[df["side"] == 0], width, clash), np.zeros(0, np.int64)
        x, z = sets[key[0]], sets[key[1]]
        groups = []
        for side, leader in ((1, key[0]), (2, key[1])):
            f = df[df["side"] == side]
            groups.append([(leader, none, none), *((s, np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)) for s, a, b in zip(f["s"], f["plus"], f["minus"], strict=True))])
        both = len(np.intersect1d(x, z, assume_unique=True))
        away = len(x) + len(z) - 2 * both
        size2 = np.array([len(z) + len(a) - len(b) for _, a, b in groups[1]])
        apart2 = np.array([len(a) + len(b) for _, a, b in groups[1]])
        found = []
        for s, more, less in groups[0]:
            n, apart = len(x) + len(more) - len(less), len(more) + len(less)
            far = allowed_apart(n + size2, percent)
            sure = np.flatnonzero(away + apart + apart2 <= far)
            if len(sure):  # by the triangle inequality alone
                found.append((s, groups[1][sure[0]][0]))
                break
            maybe = np.flatnonzero(away - apart - apart2 <= far)
            if not len(maybe):
                continue
            with_z = derived_overlaps(both, z, x, more, less)
            y = np.union1d(np.setdiff1d(x, less, assume_unique=True), more)
            for i in maybe:
                w, plus, minus = groups[1][i]
                if (100 + percent) * derived_overlaps(with_z, y, z, plus, minus) >= percent * (n + size2[i]):
                    found.append((s, w))
                    break
            if found:
                break
        return pd.DataFrame(found, columns=["s1", "s2"]).astype(np.int64)

    return rows.groupBy("s1", "s2", "u1", "u2").applyInPandas(run, "s1 long, s2 long")


def leader_links(docs: DataFrame, width: int, pairs: DataFrame, followers: DataFrame, owned: DataFrame, clash: frozenset[int], percent: int) -> DataFrame:
    """Links for pairs(s1, s2) of leaders, at least one for each two whose sets (they and their followers) have any."""
    known = materialize(overlaps(docs, width, materialize(described_pairs(pairs, owned, None), "likely"), clash).drop("plus", "minus"), "overlaps")
    direct = (100 + percent) * F.col("both") >= percent * (F.col("n1") + F.col("n2"))
    reach = materialize(followers.groupBy("leader").agg(F.count("*").alias("k"), F.max("apart").alias("r"), F.max("n").alias("n_max")), "reach")
    rest = known.where(~direct)
    for i in (1, 2):
        rest = rest.join(reach.select(F.col("leader").alias(f"s{i}"), F.col("k").alias(f"k{i}"), F.col("r").alias(f"r{i}"), F.greatest(F.col("n_max"), F.lit(0)).alias(f"m{i}")), f"s{i}", "left")
    rest = rest.na.fill(0, ["k1", "k2", "r1", "r2", "m1", "m2"]).where("k1 + k2 > 0")
    away = F.col("n1") + F.col("n2") - 2 * F.col("both")
    largest = F.greatest("n1", "m1") + F.greatest("n2", "m2")
    open_pairs = rest.where((100 + percent) * (away - F.col("r1") - F.col("r2")) <= (100 - percent) * largest).select("s1", "s2", "k1", "k2")
    return known.where(direct).select("s1", "s2").unionByName(follower_links(docs, width, materialize(open_pairs, "open"), followers, owned, clash, percent))


# --- the operator ------------------------------------------------------------------------------------------------------


def distinct_sets(described: DataFrame) -> tuple[DataFrame, DataFrame, frozenset[int]]:
    """rows(doc_id, n, s), owned(s, low, n, sign, copies) and the 64-bit ids that different sets share: none, or a handful even among 10**11 sets."""
    rows = described.where("kind = 0")

    def owners(rows: DataFrame) -> DataFrame:
        some = rows.where("n > 0").groupBy("s").agg(F.min("wide").alias("wide"), F.max("wide").alias("other"), F.min("doc_id").alias("low"), F.max("n").alias("n"), F.min("sign").alias("sign"), F.count("*").alias("copies"))
        return materialize(some, "owned")

    owned = owners(rows)
    clash = frozenset(r.s for r in owned.where("wide <> other").select("s").limit(10_001).collect())
    if len(clash) > 10_000:
        raise RuntimeError("too many set ids clash")
    if clash:
        second = F.conv(F.hex(F.substring("wide", 9, 8)), 16, -10).cast("long")
        rows = rows.withColumn("s", F.when(F.col("s").isin(*clash), second).otherwise(F.col("s")))
        owned = owners(rows)
        if not owned.where("wide <> other").isEmpty():
            raise RuntimeError("set ids clash in both halves")
    return rows.select("doc_id", "n", "s"), owned.drop("wide", "other"), clash


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, max_heavy: int = 200_000, bucket_rows: int = 400_000, tile_rows: int = 200_000, star_rounds: int = 2) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id that links reach)."""
    with scratch_scope(docs.sparkSession):
        return materialize(_components(docs, width, percent, max_heavy, bucket_rows, tile_rows, star_rounds), "components", outlive=True)


def _components(docs: DataFrame, width: int, percent: int, max_heavy: int, bucket_rows: int, tile_rows: int, star_rounds: int) -> DataFrame:
    spark = docs.sparkSession
    described = materialize(describe(docs, width), "shingles")
    rows, owned, clash = distinct_sets(described)
    heavy = heavy_tokens(described, max_heavy)
    size = owned.where("low is not null").agg(F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 1), F.sum("n")).head()
    tile_rows = max(tile_rows, -(-5 * int(size[1] or 0) // (4 * max_heavy)))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size[0] or 0) // bucket_rows))
    lists = materialize(shared_lists(index_blobs(docs, width, percent, heavy, clash, buckets, tile_rows), percent), "lists")
    similar = (100 + percent) * F.col("both") >= percent * (F.col("n1") + F.col("n2"))
    known, tried, near = spark.createDataFrame([], "bucket long, s long, label long"), None, None
    nothing = "s long, leader long, n long, apart long, plus binary, minus binary"
    followers, labels = spark.createDataFrame([], nothing), spark.createDataFrame([], "node long, label long")
    if star_rounds:
        sets = materialize(sets_of(lists), "sets")
    for turn in range(star_rounds):
        pairs = star_pairs(lists, known if turn else None, percent, turn)
        if tried is not None:
            pairs = pairs.join(tried, ["s1", "s2"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = materialize(overlaps(docs, width, materialize(described_pairs(pairs, owned, percent), "likely"), clash).where(similar), "near")
        near = found if near is None else near.unionByName(found)
        if turn + 1 < star_rounds:  # sets with the same pivot are connected: enough for the next round
            labels = near.groupBy(F.col("s2").alias("node")).agg(F.min("s1").alias("label"))
        else:
            labels, followers = component_labels(near.select(F.col("s1").alias("a"), F.col("s2").alias("b"))), leaders_of(near)
        known = materialize(sets.join(labels.withColumnRenamed("node", "s"), "s").select("bucket", "s", "label"), "known")
        release(spark)
    active = materialize(active_sets(lists, known, percent), "active")
    active = active.join(owned.select("s", "sign"), "s").join(followers.select("s", "leader"), "s", "left")
    active = active.join(labels.withColumnRenamed("node", "s"), "s", "left").select("bucket", "s", F.coalesce("label", "s").alias("label"), F.coalesce("leader", "s").alias("leader"), "sign")
    pairs = materialize(cross_pairs(lists, active, percent), "pairs")
    release(spark)
    links = leader_links(docs, width, pairs, followers, owned, clash, percent)
    if near is not None:
        links = links.unionByName(near.select("s1", "s2"))
    labels = component_labels(materialize(links, "links").select(F.col("s1").alias("a"), F.col("s2").alias("b")))
    joined = materialize(owned.where("low is not null").select("s", "low", "copies").join(labels.select(F.col("node").alias("s"), "label"), "s", "left").withColumn("label", F.coalesce("label", "s")), "labelled-sets")
    lowest = joined.groupBy("label").agg(F.min("low").alias("component_id"))
    classes = materialize(joined.join(lowest, "label").select("s", "component_id", "copies"), "classes")
    total = rows.count()
    own = rows.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    out = join_counted(rows.where("n > 0 and doc_id is not null"), classes, "s", total)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(own)


def keep_one_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the smallest id of their component, with all their columns."""
    with scratch_scope(docs.sparkSession):
        dropped = materialize(jaccard_components(docs, width, percent).where("component_id <> doc_id").select("doc_id"), "near-dropped", outlive=True)
    return prune(docs, dropped, dropped.count())


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM w),
x AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM g WHERE doc_id IS NOT NULL),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS m FROM reached GROUP BY a)
SELECT g.doc_id, CAST(len(g.g) AS BIGINT) AS n_shingles, least(g.doc_id, coalesce(low.m, g.doc_id)) AS component_id
FROM g LEFT JOIN low ON low.a = g.doc_id
"""
