import hashlib
import itertools
import random
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tilelake.llm.pii import BoostedTrees, base_spans, find_pii, free_of, isotonic, loose_spans, luhn, most_probable, redact, text_candidates

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    found = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = [True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 12 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15][k]
            if ok:
                found.append((m.start(), k, m.end()))
    return sorted(found)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a.@-+_ 0123456789()\néZ", max_size=60))
def test_base_spans(text):
    assert base_spans(text) == brute(text)


def test_card_and_long_texts():
    assert base_spans("4111 1111 1111 1111 x") == [(0, 2, 19)]
    text = "a" * 200000 + "@" * 1000 + "1" * 100000 + "+1" * 1000
    assert base_spans(text[:2000]) == brute(text[:2000])
    base_spans(text), loose_spans(text)


def test_operator(spark, odd_docs):
    rows = [(i, f"mail a{i}@b.example.com call +1 (523) 555-{1000 + i} or phone 523 555 {2000 + i}, id {i}-77-1234 x" if i % 2 else f"no data {i}", "q") for i in range(200)]
    got = {r.doc_id: r for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()}
    for i, t, _ in rows:
        b = brute(t)
        joined = ",".join(f"{'email ip card phone'.split()[k]}:{s}:{e}" for s, k, e in b)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(got[i].spans.split(","))
    assert got[2].spans == "" and got[1].n_email == 1 and got[1].n_phone == 1
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    odd = find_pii(odd_docs).collect()
    assert sorted(r.doc_id for r in odd) == sorted(r.doc_id for r in odd_docs.collect())
    assert all(r.n_card == sum(k == 2 for _, k, _ in brute(texts[r.doc_id])) for r in odd)
    assert find_pii(odd_docs.limit(0)).count() == 0


def planted(seed, n):
    """Texts with strict and loose personal data among decoys; the loose spans that are personal, and the decoys."""
    rng, rows, true, decoys = random.Random(seed), [], set(), set()
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 8)))
    number = lambda k: "".join(rng.choices("0123456789", k=k))
    for i in range(n):
        text, kind = " ".join(word() for _ in range(rng.randint(5, 30))), rng.choice(["strict", "strict", "loose", "table", "none"])
        phone = f"{number(3)} {number(3)} {number(4)}"
        if kind in ("strict", "loose"):
            text += f". Please {rng.choice(['call', 'phone', 'contact'])} " + ("+1 " if kind == "strict" else "")
            if kind == "loose":
                true.add((i, len(text), len(text) + len(phone)))
            text += phone + " " + " ".join(word() for _ in range(10))
        elif kind == "table":
            for _ in range(4):
                text += f" | {number(2)} | "
                decoys.add((i, len(text), len(text) + len(phone)))
                text += phone
        rows.append((i, text))
    return rows, true, decoys


def test_added_spans_have_recall_and_precision(spark):
    rows, true, decoys = planted(3, 1500)
    got = find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = {(r.doc_id, int(s), int(e)) for r in got for k, s, e in (x.split(":") for x in r.spans.split(",") if x) if k == "phone_loose"}
    assert sum(r.n_added for r in got) == len(added) > 0
    assert len(added & true) >= 0.8 * len(true) and len(added & true) >= 0.9 * len(added)
    assert len(added & decoys) <= 0.02 * len(decoys)


def test_many_spans_in_one_text():
    text = " ".join(f"a{i}@b.example {i % 256}.1.2.3 523 555 {i:04d} " for i in range(8000))
    began = time.time()
    base, loose = text_candidates(text)
    kept = most_probable([c[:3] for c in loose], np.ones(len(loose)), 0.5)
    assert len(base) >= 16000 and len(loose) > 4000 and time.time() - began < 20
    assert all(x[2] <= y[0] for x, y in itertools.pairwise(sorted(kept)))
    for a, b in ((loose, base),):
        few = [c[:3] for c in a[:50]], [c[:3] for c in b[:200]]
        assert free_of(few[0], few[1]) == [x for x in few[0] if not any(x[0] < e and s < x[2] for s, _, e in few[1])]


def test_trees_learn_and_calibrate():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    m = BoostedTrees().fit(x[:1000], y[:1000])
    assert ((m.score(x[1000:]) > 0) == y[1000:]).mean() > 0.95
    s, p = isotonic(m.score(x[1000:]), y[1000:])
    assert (np.diff(p) >= 0).all() and (np.diff(s) >= 0).all()


def test_redact():
    assert redact("call a@b.co now", "email:5:11") == "call [EMAIL] now"
