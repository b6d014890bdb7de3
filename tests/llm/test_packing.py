import itertools
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tilelake.llm.packing import Placement, knapsack, pack, plan_sequences


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.floats(0.01, 5), min_size=1, max_size=5))
def test_knapsack_against_enumeration(items):
    lengths = np.array(sorted(items))
    values = np.array([items[int(n)] for n in lengths])
    got = knapsack(lengths, values, 30)
    assert sum(lengths[i] for i in got) <= 30
    best = 0.0
    for times in itertools.product(*(range(30 // n + 1) for n in lengths)) if len(lengths) < 3 or lengths[0] > 5 else []:
        if np.dot(times, lengths) <= 30:
            best = max(best, float(np.dot(times, values)))
    assert sum(values[i] for i in got) >= best - 1e-9


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
def test_plans_use_every_piece_once(histogram):
    plan = plan_sequences(histogram, 64, rounds=60)
    used = Counter()
    for config, times in plan:
        assert sum(config) <= 64 and times > 0
        for n in config:
            used[n] += times
    assert used == Counter(histogram)
    place, seen = Placement(plan), defaultdict(list)
    for n, c in histogram.items():
        seq, off = place(n, np.arange(c))
        for s, o in zip(seq, off, strict=True):
            seen[int(s)].append((int(o), n))
    assert len(seen) == place.sequences
    for parts in seen.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n


def test_close_to_the_bound():
    rng = np.random.default_rng(1)
    h = Counter(np.clip(rng.lognormal(6, 1, 50000).astype(int) + 1, 1, 2048).tolist())
    h[1500] += 3000
    h[600] += 2000
    total = sum(n * c for n, c in h.items())
    got = sum(t for _, t in plan_sequences(h, 2048))
    assert got <= 1.01 * -(-total // 2048) + 2
    hard = {700: 3000, 674: 3000, 673: 3000, 1: 3000}  # three lengths fill a sequence exactly
    assert sum(t for _, t in plan_sequences(hard, 2048)) <= 3000 * 1.03


@pytest.mark.parametrize("capacity", [2048, 7])
def test_operator(spark, odd_docs, capacity):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in odd_docs.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k, i in enumerate(range(0, len(ids), capacity)):
            part = ids[i : i + capacity]
            want.append((r.doc_id, k, i, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    got = pack(odd_docs, "word_bpe_49k.json", capacity).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    assert pack(odd_docs.limit(0), "word_bpe_49k.json").count() == 0
