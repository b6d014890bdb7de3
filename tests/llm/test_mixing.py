from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilelake.llm.mixing import MARGINS, margins, mix, rake, sample_documents, topic_of

TARGETS = {"lang": {"en": 0.3, "de": 0.7}, "topic": {"prose": 0.5, "contact": 0.5}}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, ("word " * (1 + i % 17)) + ("a@b.c" if i % 3 else ""), "en" if i % 4 else "de", f"s{min(i % 7, 4)}", "x") for i in range(6000)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mix_p string")


def test_margins_are_met(docs):
    rows = mix(docs, topic_of(F.col("text")), TARGETS, alpha=1.0, budget=0.2).collect()
    total = sum(r.n_tokens for r in rows)
    got = defaultdict(float)
    drawn = defaultdict(float)
    for r in rows:
        for m in MARGINS:
            got[m, r[m]] += r.n_tokens * r.probability / (0.2 * total)
            drawn[m, r[m]] += r.n_tokens * r.selected / (0.2 * total)
    assert abs(got["lang", "de"] - 0.7) < 1e-3 and abs(got["topic", "contact"] - 0.5) < 1e-3
    assert all(abs(drawn[k] - got[k]) < 0.06 for k in got)
    error = sum(r.n_tokens**2 * (1 - r.probability) / r.probability for r in rows) ** 0.5
    assert abs(sum(r.weight * r.n_tokens for r in rows if r.selected) - total) < 3.5 * error


@pytest.mark.parametrize("rounds", [3, 12])
def test_distributed_steps_agree(docs, rounds):
    a, b = (sorted(map(repr, mix(docs, topic_of(F.col("text")), TARGETS, rounds=rounds, max_cells=k).collect())) for k in (100000, 1))
    assert a == b


def test_sample_keeps_rows_and_columns(docs, odd_docs):
    want = {r.doc_id for r in mix(docs, topic_of(F.col("text")), TARGETS).where("selected").collect()}
    got = sample_documents(docs, topic_of(F.col("text")), TARGETS)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == want
    assert mix(odd_docs, F.lit("t"), {}).count() == odd_docs.count()
    assert mix(odd_docs.limit(0), F.lit("t"), {}).count() == 0
    assert sample_documents(odd_docs, F.lit("t"), {}, budget=1.0).count() == odd_docs.count()


def test_missed_targets_are_told(docs):
    met = margins(mix(docs, topic_of(F.col("text")), TARGETS, alpha=1.0, budget=0.2), TARGETS, 1.0).collect()
    assert all(abs(r.gap) < 1e-3 for r in met) and {r.margin for r in met} == set(MARGINS)
    with pytest.warns(UserWarning, match="from its target"):  # there are not enough German tokens for this
        rows = margins(mix(docs, topic_of(F.col("text")), {"lang": {"en": 0.05, "de": 0.95}}, alpha=1.0, budget=0.9), {"lang": {"en": 0.05, "de": 0.95}}, 1.0).collect()
    assert max(abs(r.gap) for r in rows) > 0.02


def test_raking_settles_before_its_rounds_end():
    keys, tokens = [("a", "x", "t"), ("a", "y", "t"), ("b", "x", "t"), ("b", "y", "t")], np.array([5.0, 1.0, 2.0, 8.0])
    few, many = (rake(keys, tokens, {"lang": {"x": 0.5, "y": 0.5}}, 1.0, 0.1, n) for n in (60, 5000))
    assert np.abs(few - many).max() < 1e-9
